"""Month, group and service dimensions, surrogate keys and upserts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import GROUP_ALIASES, OTHER_SERVICE_DESCRIPTION, SERVICES
from ..functions import alias_name, clean_name
from ..sources import materialize

KEY_BUCKETS = 256


def number_months(months: DataFrame, key: str = "id_tempo", start: int = 0) -> DataFrame:
    """Chronological key. One unpartitioned window, over one row per month only."""
    order = Window.orderBy("ano", "mes", "ano_mes")
    return months.withColumn(key, F.row_number().over(order) + F.lit(start))


def number_rows(
    rows: DataFrame, natural_key: str, key: str, start: int = 0, buckets: int = KEY_BUCKETS
) -> DataFrame:
    """Dense integer key, start + 1 upwards, the same for the same set of natural keys.

    The rows, unique by the natural key, are numbered within hash buckets; each
    bucket starts where the counts of the buckets before it end. Only the bucket
    counts, one row each, meet in one task.
    """
    bucketed = rows.withColumn("_bucket", F.pmod(F.xxhash64(natural_key), F.lit(buckets)))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_bucket").orderBy(natural_key)
    return (
        bucketed.withColumn("_pos", F.row_number().over(inside))
        .join(offsets, "_bucket")
        .withColumn(key, (F.col("_offset") + F.col("_pos") + F.lit(start)).cast("int"))
        .drop("_bucket", "_offset", "_pos")
    )


def month_attributes(months: DataFrame) -> DataFrame:
    """Distinct months with quarter and half; months out of range fall into the last ones."""
    mes = F.col("mes")
    return months.select("ano", "mes", "ano_mes").distinct().select(
        "ano", "mes", "ano_mes",
        F.when(mes.between(1, 9), F.ceil(mes / 3).cast("int")).otherwise(4).alias("trimestre"),
        F.when(mes.between(1, 6), 1).otherwise(2).alias("semestre"),
    )


def build_dim_tempo(staging: DataFrame) -> DataFrame:
    return number_months(month_attributes(staging)).select(
        "id_tempo", "ano", "mes", "ano_mes", "trimestre", "semestre"
    )


def group_names(
    staging: DataFrame, aliases: Sequence[tuple[str, str]] = GROUP_ALIASES
) -> DataFrame:
    """Distinct final names. Names are cleaned after the first distinct, once per spelling."""
    return (
        staging.select("grupo_economico").distinct()
        .select(alias_name(clean_name(F.col("grupo_economico")), aliases).alias("nome_grupo"))
        .distinct()
    )


def build_dim_grupo(
    staging: DataFrame, aliases: Sequence[tuple[str, str]] = GROUP_ALIASES
) -> DataFrame:
    """Groups with a dense key, active by default."""
    return number_rows(group_names(staging, aliases), "nome_grupo", "id_grupo").select(
        "id_grupo", "nome_grupo", F.lit(True).alias("ativo")
    )


def service_attributes(
    staging: DataFrame, services: Mapping[str, tuple[str, str]] = SERVICES
) -> DataFrame:
    """Distinct service codes with name and description."""
    code = F.col("codigo_servico")
    name, description = F, F
    for known, (label, text) in services.items():
        name = name.when(code == known, label)
        description = description.when(code == known, text)
    return (
        staging.select("servico").distinct()
        .select(F.upper("servico").alias("codigo_servico")).distinct()
        .select(code, name.otherwise(code).alias("nome_servico"),
                description.otherwise(OTHER_SERVICE_DESCRIPTION).alias("descricao"))
    )


def build_dim_servico(
    staging: DataFrame, services: Mapping[str, tuple[str, str]] = SERVICES
) -> DataFrame:
    return number_rows(
        service_attributes(staging, services), "codigo_servico", "id_servico"
    ).select("id_servico", "codigo_servico", "nome_servico", "descricao")


def insert_absent(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of old as they are, and the rows of new whose key is not among them.

    One row of each new key is taken. A column that new lacks is null in its rows: a key column for assign_keys.
    """
    new = new.dropDuplicates(list(keys))
    return old.unionByName(new.join(old, list(keys), "left_anti"), allowMissingColumns=True)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], surrogate: str | None = None) -> DataFrame:
    """Rows of new replace those of old with the same key; the surrogate key is kept."""
    keys = list(keys)
    kept = old.join(new, keys, "left_anti")
    fresh = new
    if surrogate:
        fresh = new.drop(surrogate).join(old.select(*keys, surrogate), keys, "left")
    return kept.unionByName(fresh, allowMissingColumns=True)


def assign_keys(dimension: DataFrame, key: str, natural_key: str, chronological: bool = False) -> DataFrame:
    """Numbers the rows whose key is null, on from the highest key in use. The dimension is computed once."""
    dimension = materialize(dimension, "dimension")
    last = dimension.agg(F.coalesce(F.max(key), F.lit(0)).alias("m")).first()["m"]
    missing = dimension.filter(F.col(key).isNull()).drop(key)
    if chronological:
        numbered = number_months(missing, key, last)
    else:
        numbered = number_rows(missing, natural_key, key, last)
    return dimension.filter(F.col(key).isNotNull()).unionByName(numbered)


def with_load_time(df: DataFrame) -> DataFrame:
    return df.withColumn("data_carga", F.current_timestamp())
