"""Load of arriving workbooks by version, with Structured Streaming.

The source's offset is the last version handed out: a modification time and a path. Files are handed out in the order of
their versions, so a workbook that is replaced under its name arrives again, as does one that was repaired; a restart goes on behind the
offset of its checkpoint. Each micro-batch writes its rows and then an entry for each file that it could read, in partitions
of its own, so a batch repeated after a failure leaves the same rows. The rows of a file are those of its latest version that could be read.
Versions that could not be read are kept in the state and tried again at the start of each run until they can be, or are replaced.

A file that arrives with a modification time before the offset is not seen; the cached load (plans.ingest) compares whole listings.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator, Sequence
from datetime import datetime, timezone
from fnmatch import fnmatch

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from ..constants import STAGING_COLUMNS, WORKBOOK_SUFFIX
from ..functions import nonnegative
from ..operators import grid
from ..sources import materialize, rebalanced, scan_workbooks, sheet_rows

# The source runs in Python processes of its own, so it travels with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "workbook_versions"
FILE_SCHEMA = "arquivo string, length bigint, modificationTime timestamp, content binary"
ENTRY_SCHEMA = "arquivo string, length bigint, modificationTime timestamp, erro string, lote string"
# A task reads so many bytes of files, or one larger file.
BYTES_PER_TASK = 64 << 20


class Files(InputPartition):
    def __init__(self, files: Sequence[tuple[int, str, int]]):
        super().__init__(None)
        self.files = list(files)


class VersionReader(DataSourceStreamReader):
    """Files of a folder in the order of (modification time in microseconds, path)."""

    def __init__(self, folder: str, glob: str):
        self.folder, self.glob = folder, glob

    def _store(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.folder)

    def _listed(self) -> list[tuple[int, str, int]]:
        """(microseconds, path, length), in order."""
        from pyarrow import fs

        store, root = self._store()
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return sorted(
            (f.mtime_ns // 1000, f.path, f.size) for f in found if f.type == fs.FileType.File and fnmatch(f.base_name, self.glob)
        )

    def initialOffset(self) -> dict:
        return {"micros": -1, "path": ""}

    def latestOffset(self) -> dict:
        listed = self._listed()
        return {"micros": listed[-1][0], "path": listed[-1][1]} if listed else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Files]:
        after, upto = ((o["micros"], o["path"]) for o in (start, end))
        tasks: list[list[tuple[int, str, int]]] = []
        room = 0
        for file in self._listed():
            if after < file[:2] <= upto:
                if not tasks or file[2] > room:
                    tasks.append([])
                    room = BYTES_PER_TASK
                tasks[-1].append(file)
                room -= file[2]
        return [Files(files) for files in tasks]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        """A batch for each file. One that was replaced since it was listed is passed over, as its new version is still to come."""
        store, _ = self._store()
        schema = pa.schema([
            ("arquivo", pa.string()), ("length", pa.int64()), ("modificationTime", pa.timestamp("us", "UTC")), ("content", pa.binary()),
        ])
        for micros, path, size in partition.files:
            try:
                with store.open_input_stream(path) as file:
                    content = file.read()
            except FileNotFoundError:
                continue
            now = store.get_file_info(path)
            if (now.mtime_ns or 0) // 1000 != micros or len(content) != size:
                continue
            when = datetime.fromtimestamp(micros // 1_000_000, timezone.utc).replace(microsecond=micros % 1_000_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(([path.rsplit("/", 1)[-1]], [size], [when], [content]), schema.types)], schema=schema)


class WorkbookVersions(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return FILE_SCHEMA

    def streamReader(self, schema) -> VersionReader:
        return VersionReader(self.options["path"], self.options.get("glob", "*" + WORKBOOK_SUFFIX))


def arriving_versions(spark: SparkSession, folder: str, glob: str = "*" + WORKBOOK_SUFFIX) -> DataFrame:
    """Stream of (arquivo, length, modificationTime, content), a row for each version of a file."""
    spark.dataSource.register(WorkbookVersions)
    return spark.readStream.format(FORMAT).option("path", folder).option("glob", glob).load()


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _load(files: DataFrame, path: str, lote: str) -> None:
    """Rows of the files, then their entries; both replace what an earlier try of the same lote left."""
    files = materialize(files, "arrived-files")
    rows = materialize(sheet_rows(files), "sheet-rows")
    version = files.select("arquivo", "length", "modificationTime")
    long = grid.grid_to_long(rows).filter(nonnegative(F.col("valor"))).select(*STAGING_COLUMNS, F.lit(lote).alias("lote"))
    rebalanced(long, "ano").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("lote", "ano").parquet(
        f"{path}/linhas")
    entries = version.join(grid.file_status(rows).select("arquivo", "erro"), "arquivo").withColumn("lote", F.lit(lote))
    entries.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("lote").parquet(f"{path}/entradas")


def _latest(entries: DataFrame) -> DataFrame:
    """The last version of each file among the entries, by its time; of one version the last lote."""
    order = F.struct("modificationTime", "length", "lote")
    return entries.groupBy("arquivo").agg(F.max(order).alias("u")).select("arquivo", "u.modificationTime", "u.length", "u.lote")


def unreadable(spark: SparkSession, path: str) -> DataFrame:
    """(arquivo, length, modificationTime): versions that no run could read and no later version of their file replaces."""
    entries = _stored(spark, f"{path}/entradas", ENTRY_SCHEMA)
    read = entries.filter("erro IS NULL").groupBy("arquivo").agg(F.max("modificationTime").alias("lida"))
    last = entries.groupBy("arquivo").agg(F.max(F.struct("modificationTime", "length")).alias("u")).select("arquivo", "u.length", "u.modificationTime")
    return last.join(read, "arquivo", "left").filter("lida IS NULL OR lida < modificationTime").drop("lida")


def current_rows(spark: SparkSession, path: str) -> DataFrame:
    """Staging rows of the latest version of each file that could be read."""
    current = _latest(_stored(spark, f"{path}/entradas", ENTRY_SCHEMA).filter("erro IS NULL")).select(
        F.col("arquivo").alias("arquivo_origem"), "lote")
    schema = "mes int, ano_mes string, servico string, grupo_economico string, variavel string, valor double, arquivo_origem string, lote string, ano int"
    return _stored(spark, f"{path}/linhas", schema).join(current, ["arquivo_origem", "lote"], "left_semi").select(*STAGING_COLUMNS)


def retry_unreadable(spark: SparkSession, folder: str, path: str, lote: str, glob: str = "*" + WORKBOOK_SUFFIX) -> None:
    """Tries the versions in the state again that are still there unchanged, as a lote of its own."""
    waiting = materialize(unreadable(spark, path), "unreadable-files")
    names = [r["arquivo"] for r in waiting.select("arquivo").limit(1000).collect()]  # others wait for the next run
    if names:
        files = scan_workbooks(spark, folder, glob).filter(F.col("arquivo").isin(names))
        again = materialize(files.join(waiting, ["arquivo", "length", "modificationTime"], "left_semi"), "files-again")
        if not again.isEmpty():
            _load(again.select("arquivo", "length", "modificationTime", "content"), path, lote)


def load_versions(
    spark: SparkSession, folder: str, path: str, checkpoint: str, glob: str = "*" + WORKBOOK_SUFFIX
) -> StreamingQuery:
    """Loads the versions that arrived since the last run into the tables at path, then stops. First tries again what could not be read."""
    retry_unreadable(spark, folder, path, f"r-{uuid.uuid4().hex}", glob)
    return (
        arriving_versions(spark, folder, glob).writeStream
        .foreachBatch(lambda batch, number: _load(batch, path, f"{number:09d}"))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
