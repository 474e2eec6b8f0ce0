"""Stored variation of a mart that follows its loads: only years whose facts changed, and those they carry into, are computed.

It is kept like the mart itself, in versions that share folders: ``variacao`` and ``fronteira`` (the boundaries) with a folder for each year.
A boundary's folder remembers the load of the facts it was computed from, which tells the years that changed since.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..operators import carry
from ..operators.variation import rated_rows
from . import versions
from .mart import Mart
from .versions import Folder, Version

VARIATION, BOUNDARY = "variacao", "fronteira"


def _folders(path: str, version: Version | None, table: str) -> list[Folder]:
    return [] if version is None else version.of(table)


def read_variation(mart: Mart, path: str) -> DataFrame | None:
    """The stored variation: (ano_mes, nome_grupo[, codigo_servico], var_mercado, var_individual, diferenca, ano); None if there is none."""
    folders = _folders(path, versions.current(mart.spark, path), VARIATION)
    return versions.read_folders(mart.spark, path, folders) if folders else None


def update_variation(mart: Mart, path: str, grain: str = "groups") -> list[int]:
    """Brings the variation at path up to the mart's facts and returns the years that were computed.

    The first time all years are computed at once; later ones one after another, from their boundaries. ``grain`` stays as it was
    first chosen. Of two updates at a time the second is refused (ConcurrentLoadError).
    """
    spark, load, before = mart.spark, f"c-{uuid.uuid4().hex}", versions.current(mart.spark, path)
    facts = mart.version.years("fato_ida")
    kept = {f.ano: f for f in _folders(path, before, BOUNDARY)}
    changed = [y for y in {**facts, **kept} if y not in facts or y not in kept or kept[y].digital != facts[y].carga]
    if not changed:
        return []
    months = mart.dim_tempo
    empty = spark.createDataFrame([], carry.BOUNDARY_SCHEMA)

    def stored(year: int | None) -> DataFrame:
        if year is None:
            return empty
        return versions.read_folders(spark, path, [kept[year]]).select(*empty.columns)

    def own(table: str) -> dict[int | None, Folder]:
        return {f.ano: f for f in versions.written_years(spark, path, table, load)}

    def store(year: int, rows: DataFrame, boundary: DataFrame) -> tuple[DataFrame, bool]:
        versions.write_years(carry.year_variation(rows, boundary, grain), path, VARIATION, load)
        versions.write_years(carry.boundary_after(rows, boundary, year, grain), path, BOUNDARY, load)
        after = versions.read_folders(spark, path, [own(BOUNDARY)[year]]).select(*empty.columns)
        same = year in kept and versions.year_digests(after, empty.columns) == versions.year_digests(stored(year), empty.columns)
        return after, not same

    try:
        if kept:
            computed = carry.carry_forward(facts, changed, lambda y: rated_rows(mart.fato.filter(mart.fato["ano"] == y), months), stored, store)
        else:
            rows, computed = rated_rows(mart.fato, months), sorted(facts)
            versions.write_years(carry.year_variation(rows, empty, grain), path, VARIATION, load)
            versions.write_years(carry.boundaries(rows, computed, grain), path, BOUNDARY, load)
        fresh = [*own(VARIATION).values(), *(Folder(BOUNDARY, y, load, digital=facts[y].carga) for y in own(BOUNDARY))]
        shared = [f for f in (before.folders if before else ()) if f.ano in facts and f.ano not in computed]
        versions.commit(spark, path, fresh + shared, before)
    except BaseException:
        versions.discard(spark, path, [VARIATION, BOUNDARY], load)
        raise
    return computed
