"""Month-over-month variation of each group against the market."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import pct_change, rounded

RATE = "taxa_solicitacoes_resolvidas_5dias"
MONTH = ("ano", "mes", "ano_mes")
_MONTH_ORDER = ("ano", "mes")


def rated_rows(fact: DataFrame, dim_tempo: DataFrame) -> DataFrame:
    """Fact rows with their month and the rate as double: ano, mes, ano_mes, nome_grupo, codigo_servico, ida."""
    return fact.select(
        "id_tempo", "nome_grupo", "codigo_servico", F.col(RATE).cast("double").alias("ida")
    ).join(dim_tempo.select("id_tempo", *MONTH), "id_tempo").select(
        *MONTH, "nome_grupo", "codigo_servico", "ida"
    )


def group_means(rows: DataFrame) -> DataFrame:
    """Mean rate over services by month and group."""
    return rows.groupBy(*MONTH, "nome_grupo").agg(F.avg("ida").alias("ida"))


def market_means(rows: DataFrame) -> DataFrame:
    """Mean by month: over groups if rows are group means, over fact rows if they are those."""
    return rows.groupBy(*MONTH).agg(F.avg("ida").alias("valor_mercado"))


def market_variation(market: DataFrame) -> DataFrame:
    """Percent change from the month before. The window sees one row per month."""
    before = F.lag("valor_mercado").over(Window.orderBy(*_MONTH_ORDER))
    return (
        market.withColumn("antes", before)
        .withColumn("var_mercado", pct_change(F.col("valor_mercado"), F.col("antes")))
        .drop("antes")
    )


def individual_variation(
    rows: DataFrame, keys: Sequence[str] = ("nome_grupo",), tie_break: Sequence[str] = ()
) -> DataFrame:
    """Percent change from the previous observed row of the same keys."""
    order = Window.partitionBy(*keys).orderBy(*_MONTH_ORDER, *tie_break)
    return (
        rows.withColumn("antes", F.lag("ida").over(order))
        .withColumn("var_individual", pct_change(F.col("ida"), F.col("antes")))
        .drop("antes")
    )


def row_lag_market(rows: DataFrame, market: DataFrame, order_in_month: Sequence[str]) -> DataFrame:
    """Market variation as a row-by-row lag over (month, order_in_month) would give it.

    All rows of a month hold the same market value, so such a lag differs from zero
    only in the first row of each month, where it is the change from the month
    before. That is computed here without ordering all rows in one window. The
    order must be unique within a month.
    """
    first = rows.groupBy("ano_mes").agg(F.min(F.struct(*order_in_month)).alias("primeira"))
    monthly = market_variation(market).select(
        "ano_mes", "valor_mercado", F.col("var_mercado").alias("var_mes")
    ).join(first, "ano_mes")
    same_month = pct_change(F.col("valor_mercado"), F.col("valor_mercado"))
    return (
        rows.join(monthly, "ano_mes")
        .withColumn("var_mercado", F.when(F.struct(*order_in_month) == F.col("primeira"), F.col("var_mes"))
                    .otherwise(same_month))
        .drop("primeira", "var_mes")
    )


def variation(
    fact: DataFrame, dim_tempo: DataFrame, mode: str = "month", market: str = "groups"
) -> DataFrame:
    """Market and individual variation and their difference, by month and group.

    mode: 'month' takes the market change between months, 'row' the change between
    joined rows. market: 'groups' is the mean of group means, 'flat' the mean of
    fact rows. Rows without a market change are left out.
    """
    rows = rated_rows(fact, dim_tempo)
    means = group_means(rows)
    benchmark = market_means(means if market == "groups" else rows)
    own = individual_variation(means)
    if mode == "month":
        both = own.join(market_variation(benchmark).select("ano_mes", "valor_mercado", "var_mercado"), "ano_mes")
    elif mode == "row":
        both = row_lag_market(own, benchmark, ["nome_grupo"])
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return (
        both.filter(F.col("var_mercado").isNotNull())
        .select("ano_mes", F.upper(F.trim("nome_grupo")).alias("nome_grupo"), "var_mercado",
                "var_individual", difference().alias("diferenca"))
    )


def difference() -> Column:
    return F.col("var_mercado") - F.col("var_individual")


def long_delta(
    fact: DataFrame, dim_tempo: DataFrame, mode: str = "month", by_service: bool = True, digits: int = 2
) -> DataFrame:
    """Variation table at fact grain, rounded, without rows where either variation is missing.

    by_service compares a row with the same service of the group before it;
    otherwise rows of all services of a group follow each other, services in code
    order within a month.
    """
    rows = rated_rows(fact, dim_tempo)
    if by_service:
        own = individual_variation(rows, ("nome_grupo", "codigo_servico"))
    else:
        own = individual_variation(rows, ("nome_grupo",), ("codigo_servico",))
    benchmark = market_means(rows)
    if mode == "month":
        both = own.join(market_variation(benchmark).select("ano_mes", "var_mercado"), "ano_mes")
    elif mode == "row":
        both = row_lag_market(own, benchmark, ["nome_grupo", "codigo_servico"])
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return (
        both.filter(F.col("var_mercado").isNotNull() & F.col("var_individual").isNotNull())
        .select(
            "ano_mes", "nome_grupo", "codigo_servico",
            rounded(F.col("var_mercado"), digits).alias("var_mercado"),
            rounded(F.col("var_individual"), digits).alias("var_individual"),
            rounded(difference(), digits).alias("diferenca"),
        )
    )
