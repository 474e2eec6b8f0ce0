"""Quality checks from statistics that merge, so that only changed parts of a table are read.

Of each part of a table its failing rows by check and its rows by key are kept. Sums of them over parts are what a scan of
the whole table would count, so checks of a table follow from the statistics of its parts, old and new alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import AcceptedValues, Check, MaxLength, NotNull, Relationship, Unique

# What a part holds: failing rows of a row check (coluna names it), or rows of a key (chave) of the columns.
STATISTICS_SCHEMA = "tabela string, ano int, carga string, medida string, coluna string, chave string, n bigint"


def _key(columns: Sequence[str]) -> Column:
    """Values of the columns as one text, different for different values; null if one of them is null."""
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    return F.when(present, F.to_json(F.array(*[F.col(c).cast("string") for c in columns])))


def _row_measure(check: NotNull | MaxLength) -> str:
    return check.name if isinstance(check, NotNull) else f"{check.name} {check.length}"


def _key_columns(checks: Sequence[Check], table: str) -> list[tuple[str, ...]]:
    """Columns of the table whose keys are counted: of its own checks, and those that other tables refer to."""
    wanted: dict[tuple[str, ...], None] = {}
    for check in checks:
        if isinstance(check, Unique) and check.table == table:
            wanted[check.columns] = None
        elif isinstance(check, (AcceptedValues, Relationship)) and check.table == table:
            wanted[(check.column,)] = None
        if isinstance(check, Relationship) and check.parent == table:
            wanted[(check.field,)] = None
    return list(wanted)


def part_statistics(df: DataFrame, table: str, checks: Sequence[Check], year: Column, load: Column) -> DataFrame:
    """STATISTICS_SCHEMA of the parts (year, load) that df holds of the table: one pass for all row checks, one for all keys.

    Keys are counted within the tasks before they are shuffled. Parts without rows have no statistics.
    """
    parts = df.withColumn("_ano", year.cast("int")).withColumn("_carga", load)
    row_checks = [c for c in checks if c.table == table and isinstance(c, (NotNull, MaxLength))]
    counted = parts.groupBy("_ano", "_carga").agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(c.failing()).alias(f"_f{i}") for i, c in enumerate(row_checks)]
    )
    measures = F.array(
        F.struct(F.lit("linhas").alias("medida"), F.lit("").alias("coluna"), F.col("_n").alias("n")),
        *[F.struct(F.lit(_row_measure(c)).alias("medida"), F.lit(c.column).alias("coluna"), F.col(f"_f{i}").alias("n"))
          for i, c in enumerate(row_checks)],
    )
    none = F.lit(None).cast("string")
    found = counted.select(
        F.lit(table).alias("tabela"), F.col("_ano").alias("ano"), F.col("_carga").alias("carga"), F.inline(measures)
    ).select("tabela", "ano", "carga", "medida", "coluna", none.alias("chave"), "n")
    keys = _key_columns(checks, table)
    if not keys:
        return found
    listed = F.array(*[F.struct(F.lit(",".join(k)).alias("coluna"), _key(k).alias("chave")) for k in keys])
    by_key = parts.select("_ano", "_carga", F.inline(listed)).filter("chave IS NOT NULL").groupBy("_ano", "_carga", "coluna", "chave").agg(
        F.count(F.lit(1)).alias("n"))
    return found.unionByName(by_key.select(
        F.lit(table).alias("tabela"), F.col("_ano").alias("ano"), F.col("_carga").alias("carga"), F.lit("chave").alias("medida"),
        "coluna", "chave", "n"))


def merged(statistics: DataFrame) -> DataFrame:
    """Statistics of whole tables: (tabela, medida, coluna, chave, n). Merging merged ones gives the same."""
    return statistics.groupBy("tabela", "medida", "coluna", "chave").agg(F.sum("n").alias("n"))


def checks_from_statistics(statistics: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """What run_checks gives for the tables, from the statistics of their parts. No table is read.

    The statistics must have been taken with these checks among theirs; a table without any counts as empty.
    """
    spark, whole = statistics.sparkSession, merged(statistics)
    listed = spark.createDataFrame([
        (i, c.name, c.table, c.column, _row_measure(c) if isinstance(c, (NotNull, MaxLength)) else "chave",
         c.parent if isinstance(c, Relationship) else None, c.field if isinstance(c, Relationship) else None)
        for i, c in enumerate(checks)
    ], "i int, checagem string, tabela string, coluna string, medida string, pai string, campo string")
    accepted = spark.createDataFrame(
        [(i, str(v)) for i, c in enumerate(checks) if isinstance(c, AcceptedValues) for v in c.values], "i int, valor string")
    # A row for each check and key, or measure, of its columns; the list of checks is a few rows.
    own = whole.join(F.broadcast(listed), ["tabela", "coluna", "medida"])
    rows = own.filter("medida != 'chave'").select("i", F.col("n").alias("failures"))
    twice = own.filter("checagem = 'unique' AND n > 1").select("i", F.lit(1).cast("bigint").alias("failures"))
    # Keys that a check refers to may appear; so may accepted values. All others fail, by rows or by values.
    parents = whole.filter("medida = 'chave'").select(F.col("tabela").alias("pai"), F.col("coluna").alias("campo"), "chave").join(
        F.broadcast(listed.select("i", "pai", "campo")), ["pai", "campo"]).select("i", "chave")
    allowed = parents.unionByName(accepted.select("i", F.to_json(F.array("valor")).alias("chave")))
    strange = own.filter(F.col("checagem").isin(Relationship.name, AcceptedValues.name)).join(allowed, ["i", "chave"], "left_anti").select(
        "i", F.when(F.col("checagem") == Relationship.name, F.col("n")).otherwise(1).alias("failures"))
    failing = rows.unionByName(twice).unionByName(strange).groupBy("i").agg(F.sum("failures").alias("failures"))
    count = F.coalesce("failures", F.lit(0).cast("bigint"))
    return listed.join(failing, "i", "left").select(
        "checagem", "tabela", "coluna", count.alias("failures"), (count != 0).alias("should_warn"), (count != 0).alias("should_error")
    )
