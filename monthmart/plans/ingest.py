"""Workbook files to long rows, with a cache of what was already read.

The cache has three tables. ``linhas`` holds rows, tagged with the version of their file and the run (lote) that wrote them;
``partes`` lists the files of each run with their lengths; ``entradas`` has a row for each version that a run read to
the end. They are written in this order, so an entry says that its rows and their listing are there. A run whose
files are no longer as listed is passed over and its workbooks are read anew; what is delivered is read without
leaving anything out, so a part that is damaged afterwards gives an error, never fewer rows.

Each load opens the pending files only: by their names where they are few, else within a few ranges of modification times
that leave out as many files held already as they can. Runs of like size are merged once there are several (merge_runs), so
their number grows with the logarithm of what was loaded; a merged run is named in ``retirados`` from then on and its files stay until
clean_cache deletes them, so no reader loses what it reads.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import grid
from ..sources import delete_path, materialize, rebalanced, scan_workbooks, sheet_rows

LONG_SCHEMA = (
    "grupo_economico string, variavel string, periodo string, valor double, ano int, mes int, "
    "servico string, arquivo_origem string, ano_mes string"
)
VERSION = ("arquivo_origem", "length", "modificationTime")
ROWS_SCHEMA = LONG_SCHEMA + ", length bigint, modificationTime timestamp, lote string"
ENTRIES_SCHEMA = "arquivo_origem string, length bigint, modificationTime timestamp, lote string, linhas bigint"
PARTS_SCHEMA = "lote string, parte string, tamanho bigint"
RETIRED_SCHEMA = "lote string, retirado timestamp"
# So many pending files are named one by one; more are met by so many ranges, found at a resolution of so many steps of time.
FEW_FILES, MOST_RANGES, TIME_STEPS = 1000, 32, 4096
# Runs are merged when so many lie within the same power of this factor in size.
TIER = 4


def read_folder(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(long rows, load report) of all workbooks of a folder; the files are parsed once."""
    rows = materialize(sheet_rows(scan_workbooks(spark, folder)), "sheet-rows")
    return grid.grid_to_long(rows), grid.layout_report(rows)


def empty_long(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LONG_SCHEMA)


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _listing(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    """(lote, parte, tamanho) of the files of rows, of one run or all, by their names and lengths; no file is opened."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
            "recursiveFileLookup", "true").load(f"{path}/linhas" + (f"/lote={run}" if run else ""))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PARTS_SCHEMA)
    lote = F.regexp_extract("path", "/lote=([^/]+)/", 1)
    part = F.regexp_extract("path", "/lote=[^/]+/(.+)$", 1)
    return files.select(lote.alias("lote"), part.alias("parte"), F.col("length").alias("tamanho"))


def _retired(spark: SparkSession, path: str) -> DataFrame:
    return _stored(spark, f"{path}/retirados", RETIRED_SCHEMA)


def complete_entries(spark: SparkSession, path: str) -> DataFrame:
    """Entries whose run is there as its listing says, one run for each version of a file. Rows are not read."""
    entries = _stored(spark, f"{path}/entradas", ENTRIES_SCHEMA)
    parts = _stored(spark, f"{path}/partes", PARTS_SCHEMA)
    damaged = parts.join(_listing(spark, path), ["lote", "parte", "tamanho"], "left_anti").select("lote")
    passed = damaged.unionByName(_retired(spark, path).select("lote")).distinct()
    return entries.join(passed, "lote", "left_anti").groupBy(*VERSION).agg(F.min("lote").alias("lote"))


def time_ranges(
    listed: DataFrame, most: int = MOST_RANGES, steps: int = TIME_STEPS
) -> list[tuple[datetime, datetime]]:
    """At most ``most`` disjoint ranges that hold all pending modification times of listed (modificationTime, pendente).

    The ranges break where the most files that are not pending are left out, the earlier place on ties. Only counts of
    at most ``steps`` steps of time leave the tasks, however many files are listed; within a step no range breaks.
    """
    micros, waiting = F.unix_micros("modificationTime"), F.col("pendente")
    span = listed.filter(waiting).agg(F.min(micros).alias("first"), F.max(micros).alias("last")).first()
    if span["first"] is None:
        return []
    width = (span["last"] - span["first"]) // steps + 1
    step = F.floor((micros - span["first"]) / width)
    counted = listed.filter(micros.between(span["first"], span["last"])).groupBy(step.alias("step")).agg(
        F.min(F.when(waiting, F.col("modificationTime"))).alias("first"),
        F.max(F.when(waiting, F.col("modificationTime"))).alias("last"), F.count_if(~waiting).alias("held"),
    ).orderBy("step").collect()
    runs, left_out, held = [], [], 0
    for row in counted:
        if row["first"] is None:
            held += row["held"]
            continue
        if runs:
            left_out.append((-held, len(runs)))
        runs.append((row["first"], row["last"]))
        held = 0
    breaks = sorted(place for count, place in sorted(left_out)[: most - 1] if count < 0)
    return [(runs[a][0], runs[b - 1][1]) for a, b in zip([0, *breaks], [*breaks, len(runs)])]


def files_to_open(
    files: DataFrame, listed: DataFrame, few: int = FEW_FILES, most: int = MOST_RANGES
) -> DataFrame | None:
    """The files (arquivo, modificationTime, ...) that hold all pending ones of listed (arquivo_origem, modificationTime, pendente).

    What it filters by reaches the scan: names prune the files that are listed, times those that are opened. None if nothing waits.
    """
    names = [r["arquivo_origem"] for r in listed.filter("pendente").select("arquivo_origem").limit(few + 1).collect()]
    if not names:
        return None
    if len(names) <= few:
        return files.filter(F.col("arquivo").isin(names))
    chosen = F.lit(False)
    for first, last in time_ranges(listed, most):
        chosen = chosen | F.col("modificationTime").between(F.lit(first), F.lit(last))
    return files.filter(chosen)


def _write_run(rows: DataFrame, path: str, run: str) -> None:
    """Rows of a run, then the listing of their files."""
    rebalanced(rows.withColumn("lote", F.lit(run)), "ano").write.mode("append").partitionBy("lote", "ano").parquet(f"{path}/linhas")
    _listing(rows.sparkSession, path, run).coalesce(1).write.mode("append").parquet(f"{path}/partes")


def _append(listed: DataFrame, files: DataFrame, path: str) -> tuple[str, DataFrame] | None:
    """Reads the pending versions into the cache as a new run and returns its name and their load report."""
    opened = files_to_open(files, listed)
    if opened is None:
        return None
    pending = listed.filter("pendente").select(*VERSION)
    wanted = opened.withColumnRenamed("arquivo", "arquivo_origem").join(pending, list(VERSION), "left_semi")
    rows = materialize(sheet_rows(wanted.withColumnRenamed("arquivo_origem", "arquivo")), "sheet-rows")
    run = uuid.uuid4().hex
    _write_run(grid.grid_to_long(rows).join(pending, "arquivo_origem"), path, run)
    # A file that could not be read is tried again at the next load; one without a known layout stays as it is.
    status = grid.file_status(rows)
    read = status.filter(F.col("erro").isNull()).select(F.col("arquivo").alias("arquivo_origem"), "linhas")
    read.join(pending, "arquivo_origem").select(*VERSION, F.lit(run).alias("lote"), "linhas").coalesce(1).write.mode("append").parquet(
        f"{path}/entradas"
    )
    return run, grid.layout_report(rows)


def _rows_of(current: DataFrame, path: str) -> DataFrame:
    """Rows of the entries. Runs, one short name for each load, select the folders, so damaged ones are not opened."""
    runs = [r["lote"] for r in current.select("lote").distinct().collect()]
    rows = _stored(current.sparkSession, f"{path}/linhas", ROWS_SCHEMA).filter(F.col("lote").isin(runs))
    return rows.join(current, [*VERSION, "lote"], "left_semi")


def load_cached(files: DataFrame, path: str) -> tuple[DataFrame, DataFrame | None]:
    """(long rows, load report of the files read now) of files (arquivo, length, modificationTime, content).

    Only files that are new, changed, unread or damaged in the cache are opened. Rows of files no longer listed are passed
    over. Two files of one name cannot be told apart by the rows they give and are refused.
    """
    spark = files.sparkSession
    held = complete_entries(spark, path)
    listed = materialize(
        files.select(F.col("arquivo").alias("arquivo_origem"), "length", "modificationTime").join(held, list(VERSION), "left")
        .withColumn("pendente", F.col("lote").isNull()), "listed-files"
    )
    twice = listed.groupBy("arquivo_origem").count().filter("count > 1").select("arquivo_origem").head(3)
    if twice:
        raise ValueError(f"several files of one name: {', '.join(r[0] for r in twice)}")
    added = _append(listed, files, path)
    current = listed.filter("NOT pendente").select(*VERSION, "lote")
    if added is None:
        return _rows_of(current, path), None
    run, report = added
    fresh = _stored(spark, f"{path}/entradas", ENTRIES_SCHEMA).filter(F.col("lote") == run).select(*VERSION, "lote")
    return _rows_of(materialize(current.unionByName(fresh), "current-entries"), path), report


def full_tiers(sizes: dict[str, int], tier: int = TIER, least: int | None = None) -> list[list[str]]:
    """Runs to merge: those of each power of ``tier`` in size that at least ``least`` runs share, ``tier`` unless told."""
    tiers: dict[int, list[str]] = {}
    for run, size in sorted(sizes.items()):
        tiers.setdefault(int(math.log(max(size, 1), tier)), []).append(run)
    return [runs for _, runs in sorted(tiers.items()) if len(runs) >= (least or tier)]


def merge_runs(files: DataFrame, path: str, tier: int = TIER, least: int | None = None) -> int:
    """Merges runs of like size into one in place and returns how many are left; versions that no file has any more are dropped.

    The merged run is written like any other: rows, listing, entries; then the runs it replaces are retired in one write. A
    failure before that leaves both, with the same rows, of which one is read. A row written is written again once for each power
    of tier in the cache's size.
    """
    spark = files.sparkSession
    listed = files.select(F.col("arquivo").alias("arquivo_origem"), "length", "modificationTime")
    while True:
        current = materialize(complete_entries(spark, path).join(listed, list(VERSION), "left_semi"), "current-entries")
        # A row for each run, whose number this keeps small.
        counted = _stored(spark, f"{path}/entradas", ENTRIES_SCHEMA).join(current, [*VERSION, "lote"], "left_semi").groupBy("lote").agg(
            F.sum("linhas").alias("linhas"))
        sizes = {r["lote"]: r["linhas"] for r in counted.collect()}
        entered = _stored(spark, f"{path}/entradas", ENTRIES_SCHEMA).select("lote").distinct()
        dead = [r["lote"] for r in entered.join(_retired(spark, path), "lote", "left_anti").collect() if r["lote"] not in sizes]
        _retire(spark, path, dead)
        full = full_tiers(sizes, tier, least)
        if not full:
            return len(sizes)
        for runs in full:
            _merge(current.filter(F.col("lote").isin(runs)), path, runs)


def _merge(current: DataFrame, path: str, runs: Sequence[str]) -> None:
    spark, run = current.sparkSession, uuid.uuid4().hex
    _write_run(_rows_of(current, path).drop("lote"), path, run)
    entries = _stored(spark, f"{path}/entradas", ENTRIES_SCHEMA).join(current, [*VERSION, "lote"], "left_semi")
    # Written apart first, as a table is not appended to while it is read.
    kept = materialize(entries.dropDuplicates(list(VERSION)).withColumn("lote", F.lit(run)), "merged-entries")
    kept.coalesce(1).write.mode("append").parquet(f"{path}/entradas")
    _retire(spark, path, runs)


def _retire(spark: SparkSession, path: str, runs: Sequence[str]) -> None:
    if not runs:
        return
    retired = spark.createDataFrame([(r,) for r in runs], "lote string").withColumn("retirado", F.current_timestamp())
    retired.coalesce(1).write.mode("append").parquet(f"{path}/retirados")


def clean_cache(spark: SparkSession, path: str, hours: float = 24) -> list[str]:
    """Deletes the rows of runs retired so many hours ago, which readers of then have done with, and returns their names."""
    old = F.col("retirado") <= F.current_timestamp() - F.expr(f"INTERVAL {int(hours * 3600)} SECONDS")
    runs = [r["lote"] for r in _retired(spark, path).filter(old).select("lote").distinct().collect()]
    for run in runs:
        delete_path(spark, f"{path}/linhas/lote={run}")
    return runs


def cached_long_rows(files: DataFrame, path: str) -> DataFrame:
    return load_cached(files, path)[0]


def compact(spark: SparkSession, files: DataFrame, path: str, target: str) -> None:
    """Writes a cache that holds only the current versions of the files to the empty path target."""
    delete_path(spark, target)
    listed = files.select(F.col("arquivo").alias("arquivo_origem"), "length", "modificationTime")
    current = materialize(complete_entries(spark, path).join(listed, list(VERSION), "left_semi"), "current-entries")
    run = F.lit(uuid.uuid4().hex)
    kept = _rows_of(current, path).withColumn("lote", run)
    rebalanced(kept, "ano").write.partitionBy("lote", "ano").parquet(f"{target}/linhas")
    _listing(spark, target).coalesce(1).write.parquet(f"{target}/partes")
    entries = _stored(spark, f"{path}/entradas", ENTRIES_SCHEMA).join(current, [*VERSION, "lote"], "left_semi")
    entries.dropDuplicates(list(VERSION)).withColumn("lote", run).write.parquet(f"{target}/entradas")
