"""The whole load: staging to star schema, variation table, pivot report and checks."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import AbstractContextManager
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import STAGING_COLUMNS
from ..functions import nonnegative
from ..operators import dimensions, fact, pivot, quality, report, statistics, variation
from ..sources import save_table, save_view, scan_workbooks
from . import versions
from .ingest import clean_cache, load_cached, merge_runs
from .versions import Folder, Version

# Pivot reports by group means and by fact rows; a reader takes the first that exists.
REPORT_VIEWS = ("view_taxa_resolucao_5_dias", "pivot_variacao")


@dataclass(frozen=True)
class Mart:
    """Written tables of one version."""

    staging: DataFrame
    summary: DataFrame
    dim_tempo: DataFrame
    dim_grupo: DataFrame
    dim_servico: DataFrame
    fato: DataFrame
    path: str
    version: Version

    @property
    def spark(self) -> SparkSession:
        return self.fato.sparkSession

    @cached_property
    def groups(self) -> list[str]:
        return pivot.pivot_values(self.dim_grupo, "nome_grupo")

    def variation(self, mode: str = "month", market: str = "groups") -> DataFrame:
        return variation.variation(self.fato, self.dim_tempo, mode, market)

    def long_delta(self, mode: str = "month", by_service: bool = True) -> DataFrame:
        return variation.long_delta(self.fato, self.dim_tempo, mode, by_service)

    def pivot_view(self) -> DataFrame:
        """Benchmark report: one row per month, one column per group."""
        return pivot.pivot_report(self.variation(), self.groups)

    def report_long(self) -> DataFrame:
        """(Mes, Operadora, Delta) of every month and group, own minus market; no column for each group is made."""
        return report.report_long(self.variation(), self.dim_grupo)

    def trend(self, surrogate: bool | None = None) -> DataFrame:
        """By natural keys where the fact table has them, else by surrogate keys, unless told which."""
        if surrogate is None:
            surrogate = not {"nome_grupo", "codigo_servico"} <= set(self.fato.columns)
        return report.trend(
            self.fato, self.dim_tempo, self.dim_servico, self.dim_grupo if surrogate else None
        )

    def tables(self) -> dict[str, DataFrame]:
        return {
            "staging_ida": self.staging,
            "dim_tempo": self.dim_tempo,
            "dim_grupo_economico": self.dim_grupo,
            "dim_servico": self.dim_servico,
            "fato_ida": self.fato,
            "long_delta": self.long_delta(),
        }

    def create_views(self) -> list[str]:
        """The tables and both pivot reports as views, for use from SQL."""
        views = {
            **self.tables(),
            REPORT_VIEWS[0]: pivot.ordered(self.pivot_view()),
            REPORT_VIEWS[1]: pivot.ordered(pivot.pivot_report(self.long_delta(), self.groups, market="avg")),
        }
        for name, df in views.items():
            save_view(df, name)
        return list(views)

    def publish(self, prefix: str = "") -> list[str]:
        """Names for the stored tables in the catalogue, for any session: views that show the current version, also after later loads."""
        for field, name in TABLES.items():
            versions.create_view(self.spark, self.path, name, f"{prefix}{name}", getattr(self, field).columns, name in BY_YEAR)
        return [f"{prefix}{name}" for name in TABLES.values()]

    def lease(self, seconds: float = 3600) -> AbstractContextManager[None]:
        """Keeps the files of this version from being deleted while work on them lasts."""
        return versions.lease(self.spark, self.path, self.version.name, seconds)

    def checks(self) -> DataFrame:
        return quality.run_checks(self.tables(), quality.mart_checks())

    def constraints(self) -> DataFrame:
        """Keys, required columns, references and lengths, which a load must keep. From statistics; no table is read."""
        return statistics.checks_from_statistics(
            _statistics(self.spark, self.path, self.version.folders), quality.table_constraints()
        )


class ConstraintError(ValueError):
    """A load that breaks the constraints of its tables; the mart stays as it was."""


# Tables of a mart, and those of them that have a folder for each year.
TABLES = {
    "staging": "staging_ida", "summary": "resumo_ida", "dim_tempo": "dim_tempo", "dim_grupo": "dim_grupo_economico",
    "dim_servico": "dim_servico", "fato": "fato_ida",
}
BY_YEAR = ("staging_ida", "resumo_ida", "fato_ida")


def _opened(spark: SparkSession, path: str, version: Version) -> Mart:
    tables = {field: versions.read_folders(spark, path, version.of(name)) for field, name in TABLES.items() if version.of(name)}
    if "fato" not in tables:  # no row has a group and a service
        none = fact.build_fact(
            tables["summary"].limit(0), tables["dim_tempo"], tables["dim_grupo"], tables["dim_servico"], with_surrogates=True)
        tables["fato"] = dimensions.with_load_time(none)
    tables["staging"] = tables["staging"].select(*STAGING_COLUMNS, "data_carga")
    return Mart(**tables, path=path, version=version)


def open_mart(spark: SparkSession, path: str) -> Mart | None:
    """The mart of the last finished load under path, from its files alone; None if there is none."""
    version = versions.current(spark, path)
    return None if version is None else _opened(spark, path, version)


def delete_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Deletes what only versions before the last ones hold, but for those under a lease; their names.

    A reader of a deleted version without a lease fails from then on.
    """
    return versions.delete_old(spark, path, keep)


def _statistics(spark: SparkSession, path: str, folders: tuple[Folder, ...]) -> DataFrame:
    """Statistics of the folders: those of each load lie in a folder of their own."""
    loads = sorted({f.carga for f in folders})
    wanted = spark.createDataFrame([(f.tabela, f.ano, f.carga) for f in folders], "t string, a int, c string")
    kept = spark.read.schema(statistics.STATISTICS_SCHEMA).parquet(*[f"{path}/estatisticas/{load}" for load in loads])
    same = (F.col("tabela") == F.col("t")) & F.col("ano").eqNullSafe(F.col("a")) & (F.col("carga") == F.col("c"))
    return kept.join(F.broadcast(wanted), same, "left_semi")  # a row for each folder of the version


def _dimensions(summary: DataFrame, old: Mart | None) -> dict[str, Callable[[], DataFrame]]:
    """Dimension builds: anew, or on from those of the mart before, whose rows and keys stay."""
    if old is None:
        return {
            "dim_tempo": lambda: dimensions.build_dim_tempo(summary),
            "dim_grupo_economico": lambda: dimensions.build_dim_grupo(summary),
            "dim_servico": lambda: dimensions.build_dim_servico(summary),
        }
    months, services = dimensions.month_attributes(summary), dimensions.service_attributes(summary)
    groups = dimensions.group_names(summary).withColumn("ativo", F.lit(True))
    absent, keyed = dimensions.insert_absent, dimensions.assign_keys
    return {
        "dim_tempo": lambda: keyed(absent(old.dim_tempo, months, ["ano_mes"]), "id_tempo", "ano_mes", chronological=True),
        "dim_grupo_economico": lambda: keyed(absent(old.dim_grupo, groups, ["nome_grupo"]), "id_grupo", "nome_grupo"),
        "dim_servico": lambda: keyed(
            dimensions.upsert(old.dim_servico, services, ["codigo_servico"], "id_servico"), "id_servico", "codigo_servico"
        ),
    }


def build_mart(staging: DataFrame, path: str) -> Mart | None:
    """Reload of all tables under path, on the dimensions that are there; None and no change if there are no rows.

    Each load makes a version of its own. Years whose staging rows are those of the version before are not written again, as
    a digest of their rows tells: their folders are shared, and a load that changes nothing makes no version. Constraints are checked
    on statistics, taken of what this load wrote and kept for what it shares, before one last row makes the version the current
    one. So a load that fails, is refused (ConstraintError) or comes second (versions.ConcurrentLoadError) leaves the mart before as it is.

    The first load computes its input once; a later one once for the digests and once, where the input's files are by year only in those years, to
    write what changed. Each table is written once and the next ones read the written table, so a lost executor repeats no earlier step. The
    dimensions do not depend on each other and are written side by side.
    """
    spark, load = staging.sparkSession, f"c-{uuid.uuid4().hex}"
    rows = staging.select(*STAGING_COLUMNS).filter(nonnegative(F.col("valor")))
    before = versions.current(spark, path)
    try:
        version = _write_version(rows, path, load, before)
    except BaseException:
        versions.discard(spark, path, list(TABLES.values()), load)
        raise
    return None if version is None else _opened(spark, path, version)


def _write_version(rows: DataFrame, path: str, load: str, before: Version | None) -> Version | None:
    spark = rows.sparkSession
    changed = None
    if before is not None:
        digests = versions.year_digests(rows, STAGING_COLUMNS)
        if not digests:
            return None
        old_years = before.years("staging_ida")
        changed = [y for y, d in digests.items() if y not in old_years or (old_years[y].linhas, old_years[y].digital) != d]
        if not changed and set(digests) == set(old_years):
            return before
        years = F.col("ano").isin([y for y in changed if y is not None])
        rows = rows.filter(years | F.col("ano").isNull() if None in changed else years)
    if changed is None or changed:
        versions.write_years(dimensions.with_load_time(rows), path, "staging_ida", load)
    written = versions.written_years(spark, path, "staging_ida", load)
    if before is None and not written:
        return None
    if before is None:
        digests = versions.year_digests(versions.read_folders(spark, path, written), STAGING_COLUMNS)
    folders = [Folder("staging_ida", f.ano, load, *digests[f.ano]) for f in written]
    old = None if before is None else _opened(spark, path, before)
    if written:
        folders += _write_derived(spark, path, load, written, old)
    shared = [] if before is None else [
        f for f in before.folders
        if (f.ano in digests and f.ano not in changed if f.by_year else not written)
    ]
    _check(spark, path, load, folders, tuple(folders + shared))
    return versions.commit(spark, path, folders + shared, before)


def _write_derived(spark: SparkSession, path: str, load: str, written: list[Folder], old: Mart | None) -> list[Folder]:
    """Summary, dimensions and fact of the staging years that the load has written; the folders of all three."""
    loaded = versions.read_folders(spark, path, written)
    versions.write_years(fact.summarise_staging(loaded), path, "resumo_ida", load)
    folders = versions.written_years(spark, path, "resumo_ida", load)
    summary = versions.read_folders(spark, path, folders)
    builds = _dimensions(summary, old)
    with ThreadPoolExecutor(len(builds)) as pool:
        tempo, grupo, servico = pool.map(lambda b: versions.write_whole(b[1](), path, b[0], load), builds.items())
    folders += [Folder(name, None, load, by_year=False) for name in builds]
    facts = fact.build_fact(summary, tempo, grupo, servico, with_surrogates=True)
    versions.write_years(dimensions.with_load_time(facts), path, "fato_ida", load)
    fact_folders = versions.written_years(spark, path, "fato_ida", load)
    if strange := {f.ano for f in fact_folders} - {f.ano for f in written}:
        raise ConstraintError(f"months of other years: {sorted(map(str, strange))}")
    return folders + fact_folders


def _check(spark: SparkSession, path: str, load: str, own: list[Folder], folders: tuple[Folder, ...]) -> None:
    """Takes the statistics of the load's own folders and checks the constraints of the version that they are part of."""
    checks, taken = quality.table_constraints(), None
    for name in {f.tabela: None for f in own}:
        parts = [f for f in own if f.tabela == name]
        year = F.col("ano") if name in BY_YEAR else F.lit(None)
        found = statistics.part_statistics(versions.read_folders(spark, path, parts), name, checks, year, F.lit(load))
        taken = found if taken is None else taken.unionByName(found)
    if taken is not None:
        save_table(taken.coalesce(1), f"{path}/estatisticas/{load}")
    result = statistics.checks_from_statistics(_statistics(spark, path, folders), checks)
    broken = result.filter("should_error").select("checagem", "tabela", "coluna", "failures").collect()
    if broken:
        raise ConstraintError("; ".join(f"{r.tabela}.{r.coluna} {r.checagem}: {r.failures}" for r in broken))


def load_folder(
    spark: SparkSession, folder: str, path: str, keep: int = 2
) -> tuple[Mart | None, DataFrame | None]:
    """(mart, load report) from a folder of workbooks; files in the cache under path are not opened again.

    The report has the files that this load read: their status, rows and errors. None where no file was read. Then small runs of the cache are
    merged, and what neither the last ``keep`` versions nor a lease holds is deleted.
    """
    files = scan_workbooks(spark, folder)
    long, report = load_cached(files, f"{path}/cache")
    mart = build_mart(long, f"{path}/mart")
    if mart is not None:
        merge_runs(files, f"{path}/cache")
        clean_cache(spark, f"{path}/cache")
        delete_old_versions(spark, f"{path}/mart", keep)
    return mart, report
