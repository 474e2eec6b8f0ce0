"""Tables: shared folder, writes, reads with fallback, inventory."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import STAGING_COLUMNS


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors see, as the session names it in spark.checkpoint.dir.

    A session without the setting uses a folder of its warehouse, which is shared as well.
    """
    conf = spark.sparkContext.getConf()
    folder = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    folder = folder or spark.sparkContext.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """One partition value per file; AQE splits values that hold too many rows."""
    return df.hint("rebalance", *columns)


def _overwriting(df: DataFrame, partition_by: Sequence[str]):
    """Writer that replaces. Only tables with partitions are shuffled for their layout."""
    if not partition_by:
        return df.write.mode("overwrite")
    return rebalanced(df, *partition_by).write.mode("overwrite").partitionBy(*partition_by)


def save_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), only_partitions: bool = False
) -> DataFrame:
    """Reload a Parquet table and return it: as a whole, or only the partitions that df holds.

    ``path`` must not be an input of ``df``.
    """
    # Said for each write, so that a setting of the session changes nothing.
    mode = "dynamic" if only_partitions else "static"
    _overwriting(df, partition_by).option("partitionOverwriteMode", mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_catalog_table(df: DataFrame, name: str, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Full reload of a table that the catalog knows by name, with its files at path."""
    _overwriting(df, partition_by).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def save_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path in the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    files, hadoop_path = _store(spark, path)
    files.deleteOnExit(hadoop_path)
    return path


def _store(spark: SparkSession, path: str):
    """(file system, path) as Hadoop knows them."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def delete_path(spark: SparkSession, path: str) -> None:
    """Removes a table's files, if there are any."""
    files, hadoop_path = _store(spark, path)
    files.delete(hadoop_path, True)


def create_new(spark: SparkSession, path: str) -> bool:
    """Creates an empty file that is not there yet; False if it is, so that of several writers one gets it."""
    files, hadoop_path = _store(spark, path)
    return files.createNewFile(hadoop_path)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder, hidden ones left out; none if it is not there."""
    files, hadoop_path = _store(spark, path)
    if not files.exists(hadoop_path):
        return []
    names = [status.getPath().getName() for status in files.listStatus(hadoop_path)]
    return sorted(n for n in names if not n.startswith((".", "_")))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, so that it means the same in any session."""
    files, hadoop_path = _store(spark, path)
    return files.makeQualified(hadoop_path).toString()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result once to the shared folder and go on from the file.

    Cuts the lineage, survives the loss of executors and gives later joins the
    true size of the data to choose their strategy by.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bulk_load(
    df: DataFrame, path: str, columns: Sequence[str] = STAGING_COLUMNS, truncate: bool = True
) -> None:
    """Load the columns into the staging table at path; every task writes its own rows.

    A truncating load writes beside the table, looks at what it wrote and only then takes the table's place, so the
    input is computed once, and one without rows leaves the table as it is. A plain append repeats its rows if it is
    repeated; append_once does not.
    """
    chosen = df.select(*columns)
    if not truncate:
        chosen.write.mode("append").parquet(path)
        return
    spark, beside = df.sparkSession, f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    chosen.write.parquet(beside)
    if spark.read.schema(chosen.schema).parquet(beside).isEmpty():
        delete_path(spark, beside)
    else:
        _take_place(spark, beside, path)


def _take_place(spark: SparkSession, new: str, path: str) -> None:
    """Moves the files at new to path; those there before go once that is done."""
    (files, source), (_, target) = _store(spark, new), _store(spark, path)
    old = _store(spark, f"{new}-old")[1]
    before = files.exists(target)
    if before and not files.rename(target, old):
        raise OSError(f"{path} could not be moved")
    if not files.rename(source, target):
        if before:
            files.rename(old, target)
        raise OSError(f"{new} could not be moved to {path}")
    if before:
        files.delete(old, True)


def _load_folder(path: str, load_id: str) -> str:
    if not re.fullmatch(r"[\w.-]+", load_id):
        raise ValueError(f"a load id has letters, digits, _, . and - only: {load_id!r}")
    return f"{path}/linhas/carga={load_id}"


def write_load(df: DataFrame, path: str, load_id: str, columns: Sequence[str] = STAGING_COLUMNS) -> None:
    """Rows of a load in a folder of its own, in place of what an earlier try left there. They count once the ledger has the load."""
    df.select(*columns).write.mode("overwrite").parquet(_load_folder(path, load_id))


def append_once(df: DataFrame, path: str, load_id: str, columns: Sequence[str] = STAGING_COLUMNS) -> bool:
    """Appends rows to the table of loads at path as the load of this id; False, and nothing is done, if that load is there.

    Rows first, then the ledger, a file named as the load. A load that is killed between the two, or while it writes, is repeated under its
    id and gives its rows once. Loads of different ids may run at the same time.
    """
    spark = df.sparkSession
    if load_id in list_names(spark, f"{path}/livro"):
        return False
    write_load(df, path, load_id, columns)
    return create_new(spark, f"{path}/livro/{load_id}")


def loaded_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of the loads that the ledger has, with their id as carga, which chooses their folders: no other load is opened.

    schema: the columns of the rows. A table without loads has no rows.
    """
    loads = list_names(spark, f"{path}/livro")
    if not loads:
        return spark.createDataFrame([], f"{schema}, carga string")
    return spark.read.schema(f"{schema}, carga string").parquet(f"{path}/linhas").filter(F.col("carga").isin(loads))


def first_existing(spark: SparkSession, names: Sequence[str]) -> DataFrame | None:
    """First table or view of the list that exists, even if it is empty."""
    for name in names:
        if spark.catalog.tableExists(name):
            return spark.table(name)
    return None


def inventory(spark: SparkSession, names: Sequence[str] | None = None) -> DataFrame:
    """(tabela, n) of the named tables and views, or of all in the current database."""
    if names is None:
        names = sorted(t.name for t in spark.catalog.listTables())
    counts = [
        spark.table(n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("tabela"), "n")
        for n in names
    ]
    if not counts:
        return spark.createDataFrame([], "tabela string, n bigint")
    result = counts[0]
    for c in counts[1:]:
        result = result.unionByName(c)
    return result
