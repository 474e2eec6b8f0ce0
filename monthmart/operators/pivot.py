"""Reports with one column per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import MARKET_COLUMN
from ..functions import quoted, rounded

MAX_VALUES_CONF = "spark.sql.pivotMaxValues"


def pivot_values(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values that become columns, bounded as Spark bounds its own pivots."""
    bound = int(df.sparkSession.conf.get(MAX_VALUES_CONF))
    found = (
        df.filter(F.col(column).isNotNull())
        .select(F.upper(F.trim(F.col(column))).alias("v")).distinct()
        .limit(bound + 1).collect()
    )
    if len(found) > bound:
        raise ValueError(f"more than {bound} values of {column} (see {MAX_VALUES_CONF})")
    return sorted(r["v"] for r in found)


def pivot_report(
    delta: DataFrame,
    groups: Sequence[str],
    market: str = "max",
    digits: int = 1,
    fill: float | None = 0,
    market_column: str = MARKET_COLUMN,
) -> DataFrame:
    """One row per month: the market's variation and each group's difference.

    Market and groups come from one pass over the variation rows: each row counts
    once for its group and once for the market, which is a column like the groups. A
    group without a value in a month shows ``fill``; None leaves it null. Differences
    are rounded before their maximum is taken, which gives the same.
    """
    combine = {"max": F.max, "avg": F.avg}[market]
    change = rounded(F.col("diferenca"), digits)
    level = F.col("var_mercado").cast("double")
    columns = F.array(
        F.struct(F.col("nome_grupo").alias("coluna"), change.alias("d"), F.lit(None).cast("double").alias("m")),
        F.struct(F.lit(market_column).alias("coluna"), F.lit(None).cast(f"decimal(18,{digits})").alias("d"), level.alias("m")),
    )
    names = [market_column, *groups]
    wide = (
        delta.select(F.col("ano_mes").alias("Mes"), F.inline(columns))
        .groupBy("Mes").pivot("coluna", names).agg(F.max("d").alias("d"), combine("m").alias("m"))
    )
    report = wide.select(
        "Mes", rounded(quoted(f"{market_column}_m"), digits), *[quoted(f"{g}_d") for g in groups]
    ).toDF("Mes", *names)
    return report if fill is None else report.na.fill(fill)


def ordered(report: DataFrame) -> DataFrame:
    """Sorted by month."""
    return report.orderBy("Mes")


def to_long(report: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(Mes, Operadora, Delta) of the groups, missing values kept."""
    pairs = F.array(*[
        F.struct(F.lit(g).alias("Operadora"), quoted(g).cast("double").alias("Delta")) for g in groups
    ])
    return report.select("Mes", F.inline(pairs))


def heat_matrix(long: DataFrame, months: Sequence[str]) -> DataFrame:
    """Groups down, months across."""
    return long.groupBy("Operadora").pivot("Mes", list(months)).agg(F.max("Delta"))
