"""Variation carried forward: years that changed are computed from what was last observed before them, not from all history.

A boundary holds, for the end of a year, the last observed rate of each group (and service) and the last market mean. A
year's variation follows from its own fact rows and the boundary of the year before. When a year changes, its variation and its
boundary are computed anew; if the boundary is as it was, nothing after it can change; if not, the next year
follows, as its groups' first observations compare with other rates. So a new month costs its year, and a corrected old
month its year and those up to the next one in which its groups appear.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .variation import MONTH, difference, group_means, individual_variation, market_means, market_variation

# A boundary row: the year it ends, the keys (all null: the market), the last month observed and its rate.
BOUNDARY_SCHEMA = "ano int, nome_grupo string, codigo_servico string, ano_mes string, ida double"
KEYS = {"groups": ("nome_grupo",), "services": ("nome_grupo", "codigo_servico")}


def _observed(rows: DataFrame, grain: str) -> tuple[DataFrame, DataFrame]:
    """(rates by month and key, market mean by month) of rated rows: of group means, or of services as they are."""
    own = group_means(rows) if grain == "groups" else rows
    return own, market_means(own)


def _seen(rows: DataFrame, grain: str) -> DataFrame:
    """Rates of keys and market in the columns of a boundary, with the month they were observed in."""
    own, market = _observed(rows, grain)
    none = F.lit(None).cast("string")
    service = F.col("codigo_servico") if grain == "services" else none
    return own.select("ano", "nome_grupo", service.alias("codigo_servico"), "ano_mes", "ida").unionByName(
        market.select("ano", none.alias("nome_grupo"), none.alias("codigo_servico"), "ano_mes", F.col("valor_mercado").alias("ida")))


def boundary_after(rows: DataFrame, before: DataFrame, year: int, grain: str = "groups") -> DataFrame:
    """The boundary of a year: each key's last rate among the year's rated rows, else that of the boundary before.

    Maxima by key, combined within the tasks. A null rate counts as observed, as it does for a lag.
    """
    seen = _seen(rows, grain).unionByName(before)
    last = seen.groupBy("nome_grupo", "codigo_servico").agg(F.max(F.struct("ano_mes", "ida")).alias("u"))
    return last.select(F.lit(year).alias("ano"), "nome_grupo", "codigo_servico", "u.ano_mes", "u.ida")


def boundaries(rows: DataFrame, years: Sequence[int], grain: str = "groups") -> DataFrame:
    """The boundaries of all years from all rated rows at once, for a first load: one pass, a maximum by key and year.

    Each key's last rate of a year is offered to that year and all later ones, of which there are few; the latest offer wins.
    """
    by_year = _seen(rows, grain).groupBy("ano", "nome_grupo", "codigo_servico").agg(F.max(F.struct("ano_mes", "ida")).alias("u"))
    later = F.filter(F.array(*[F.lit(y) for y in sorted(years)]), lambda y: y >= F.col("ano"))
    offered = by_year.select(F.explode(later).alias("fim"), "nome_grupo", "codigo_servico", "u")
    return offered.groupBy("fim", "nome_grupo", "codigo_servico").agg(F.max("u").alias("u")).select(
        F.col("fim").alias("ano"), "nome_grupo", "codigo_servico", "u.ano_mes", "u.ida")


def year_variation(rows: DataFrame, before: DataFrame, grain: str = "groups") -> DataFrame:
    """Variation of the rated rows of a year, or of several, continued from the boundary before; an empty one starts anew.

    What variation gives for these months, or long_delta before it rounds and leaves rows out:
    (ano, ano_mes, nome_grupo[, codigo_servico], var_mercado, var_individual, diferenca). Rows without a market change are left out.
    """
    own, market = _observed(rows, grain)
    keys = KEYS[grain]
    # A boundary's rows stand before all months, so the lags of first observations end at them.
    first = [F.col("ano"), F.lit(0).alias("mes"), F.col("ano_mes")]
    earlier = before.filter("nome_grupo IS NOT NULL").select(*first, *keys, "ida")
    market_before = before.filter("nome_grupo IS NULL").select(*first, F.col("ida").alias("valor_mercado"))
    varied = individual_variation(own.select(*MONTH, *keys, "ida").unionByName(earlier), keys).filter("mes > 0")
    changes = market_variation(market.unionByName(market_before)).filter("mes > 0 AND var_mercado IS NOT NULL")
    return varied.join(changes.select("ano_mes", "var_mercado"), "ano_mes").select(
        "ano", "ano_mes", *keys, "var_mercado", "var_individual", difference().alias("diferenca"))


def carry_forward(
    years: Iterable[int], changed: Iterable[int], rated: Callable[[int], DataFrame], stored: Callable[[int | None], DataFrame],
    store: Callable[[int, DataFrame, DataFrame], tuple[DataFrame, bool]],
) -> list[int]:
    """Brings the variation of the years up to date after some changed, were added or went; the years computed, in order.

    rated(year) reads a year's rows, stored(year) the boundary kept of a year (None: before all). store(year, rows, before) writes what follows
    and returns the year's boundary and whether it differs from the one kept.
    """
    order, changed = sorted(years), set(changed)
    # After a year that went, the next one compares with the one before it.
    waiting = changed & set(order) | {next((y for y in order if y > gone), None) for gone in changed - set(order)}
    fresh: dict[int, DataFrame] = {}
    for before, year in zip([None, *order], order):
        if year in waiting:
            fresh[year], differs = store(year, rated(year), fresh[before] if before in fresh else stored(before))
            if differs:
                waiting.add(next((y for y in order if y > year), None))
    return list(fresh)
