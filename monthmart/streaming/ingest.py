"""Incremental load of arriving workbooks with Structured Streaming.

The file source remembers in its checkpoint which files it has handed out, so a
run takes only the new ones. Each micro-batch replaces its own partition, and a
batch repeated after a failure leaves the same rows.

The source knows a file by its path. A workbook that is replaced under its name, or that could not be read when it
came, is not taken again: where that can happen, load the folder with the cache (plans.ingest), which knows
versions and retries unreadable files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..constants import STAGING_COLUMNS, WORKBOOK_SUFFIX
from ..functions import nonnegative
from ..operators import grid
from ..sources import materialize, rebalanced, sheet_rows

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def arriving_workbooks(
    spark: SparkSession, folder: str, files_per_batch: int = 1000, glob: str = "*" + WORKBOOK_SUFFIX
) -> DataFrame:
    """Stream of (arquivo, content)."""
    return (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
        .option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("arquivo"), "content")
    )


def load_arriving(
    spark: SparkSession, folder: str, staging_path: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Load the workbooks that arrived since the last run into the staging table, then stop."""

    def load(batch: DataFrame, batch_id: int) -> None:
        rows = materialize(sheet_rows(batch), "sheet-rows")
        long = grid.grid_to_long(rows).filter(nonnegative(F.col("valor")))
        (rebalanced(long.select(*STAGING_COLUMNS, F.lit(batch_id).alias("lote")), "ano")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("lote", "ano").parquet(staging_path))

    return (
        arriving_workbooks(spark, folder, files_per_batch).writeStream
        .foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
