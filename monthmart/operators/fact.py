"""Fact table: measures by month, group and service."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    GROUP_ALIASES, INDEX_PREFIXES, RATE_5D_PREFIX, RATE_TOTAL_NAME, REQUEST_NAMES, RESOLVED_NAMES,
)
from ..functions import alias_name, clean_name, rounded

MEASURES = ("val_ida", "tx_5d", "tx_tot", "sol_tot", "sol_res")
RATE_TYPE = "decimal(5,2)"


def measure_conditions() -> dict[str, Column]:
    """Which metric names feed which measure."""
    metric = F.col("variavel")
    index = metric.ilike(INDEX_PREFIXES[0] + "%")
    for prefix in INDEX_PREFIXES[1:]:
        index = index | metric.ilike(prefix + "%")
    return {
        "val_ida": index,
        "tx_5d": metric.ilike(RATE_5D_PREFIX + "%"),
        "tx_tot": metric.ilike(RATE_TOTAL_NAME),
        "sol_tot": metric.isin(*REQUEST_NAMES),
        "sol_res": metric.isin(*RESOLVED_NAMES),
    }


def summarise_staging(staging: DataFrame) -> DataFrame:
    """The measures by month, service and group as spelled in staging.

    The only pass over staging that the mart needs: dimensions and fact both start
    from this. Maxima of doubles are combined within each map task before the one
    shuffle, so a month, service or group that holds most rows makes no large task.
    """
    return staging.groupBy("ano", "mes", "ano_mes", "servico", "grupo_economico").agg(
        *[F.max(F.when(cond, F.col("valor"))).alias(m) for m, cond in measure_conditions().items()]
    )


def consolidate(
    summary: DataFrame, aliases: Sequence[tuple[str, str]] = GROUP_ALIASES
) -> DataFrame:
    """The measures by month, service code and final group name.

    Names are cleaned here, on the summary, and spellings of one group meet in a
    second maximum. Rows without group or service belong to no dimension and go
    first; the names are then declared never null, or Spark would repeat the
    cleaning as a null filter of later joins, pushed down to the staging rows.
    """
    name = alias_name(clean_name(F.col("grupo_economico")), aliases)
    return (
        summary.filter(F.col("grupo_economico").isNotNull() & F.col("servico").isNotNull())
        .withColumn("nome_grupo", F.coalesce(name, F.lit("")))
        .withColumn("codigo_servico", F.coalesce(F.upper("servico"), F.lit("")))
        .groupBy("ano_mes", "codigo_servico", "nome_grupo")
        .agg(*[F.max(m).alias(m) for m in MEASURES])
    )


def derive_measures(measures: DataFrame, missing: float | None = 0) -> DataFrame:
    """Published columns: fallbacks, derived resolved count, types.

    ``missing`` stands in for measures without any value; None leaves them null.
    """
    def filled(*cols: Column) -> Column:
        return F.coalesce(*cols, F.lit(missing).cast("double"))

    # A value that its column cannot hold fails the load, whatever the session does about overflows.
    def rate(col: Column) -> Column:
        value = rounded(col, 2)
        return F.when(F.abs(value) >= 1000, F.raise_error(F.lit("NUMERIC_VALUE_OUT_OF_RANGE: a rate of 1000 or more"))).otherwise(value.cast(RATE_TYPE))

    def total(col: Column) -> Column:
        value = F.round(col)
        return F.when(
            F.abs(value) > 2147483647, F.raise_error(F.lit("NUMERIC_VALUE_OUT_OF_RANGE: a total beyond 2147483647"))
        ).otherwise(value.cast("int"))

    estimated = F.round(F.col("sol_tot") * F.col("tx_tot") / 100)
    return measures.select(
        "ano_mes", "codigo_servico", "nome_grupo",
        rate(filled(F.col("val_ida"), F.col("tx_5d"))).alias("taxa_solicitacoes_resolvidas_5dias"),
        rate(filled(F.col("tx_tot"))).alias("taxa_solicitacoes_resolvidas"),
        total(filled(F.col("sol_tot"))).alias("total_solicitacoes"),
        total(filled(F.col("sol_res"), estimated)).alias("solicitacoes_resolvidas"),
    )


def build_fact(
    summary: DataFrame,
    dim_tempo: DataFrame,
    dim_grupo: DataFrame,
    dim_servico: DataFrame,
    aliases: Sequence[tuple[str, str]] = GROUP_ALIASES,
    with_surrogates: bool = False,
    missing: float | None = 0,
) -> DataFrame:
    """Fact rows of the summary that match all three dimensions, with the year to partition by.

    No join is hinted: Spark broadcasts a dimension where its size allows it.
    """
    ids = ["id_grupo", "id_servico"] if with_surrogates else []
    return (
        derive_measures(consolidate(summary, aliases), missing)
        .join(dim_tempo.select("ano_mes", "id_tempo", "ano"), "ano_mes")
        .join(dim_grupo.select("nome_grupo", *ids[:1]), "nome_grupo")
        .join(dim_servico.select("codigo_servico", *ids[1:]), "codigo_servico")
        .select(
            "id_tempo", *ids, "nome_grupo", "codigo_servico",
            "taxa_solicitacoes_resolvidas_5dias", "taxa_solicitacoes_resolvidas",
            "total_solicitacoes", "solicitacoes_resolvidas", "ano",
        )
    )
