"""Results kept as Parquet: whole tables, appended tables and dated snapshots.

A chain of steps stays lazy; a result is written only where several jobs use it.  A
written table also ends a long lineage in a way that survives the loss of executors.
"""

from __future__ import annotations

import tempfile
import time
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT = "snapshot_week"
_SHARED_CONF = "spark.checkpoint.dir"


@lru_cache
def _local_dir(application: str) -> str:
    """One temporary folder per local application."""
    return tempfile.mkdtemp(prefix="clientele-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Without the setting only a local session gets a temporary folder; on a cluster that
    would be a different folder on every machine.
    """
    named = spark.conf.get(_SHARED_CONF, None) or spark.sparkContext.getConf().get(_SHARED_CONF)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SHARED_CONF} to a folder every executor can reach")
    return _local_dir(spark.sparkContext.applicationId)


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_NEW, _OLD = ".new-", ".old-"


def _files(spark: SparkSession, path: str):
    """The file system of a path, and a function from texts to its paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def recover(spark: SparkSession, path: str) -> bool:
    """Put back a table whose replacement stopped between taking the old one away and putting the
    new one in; delete what other interrupted replacements left.  True where one was put back."""
    files, make = _files(spark, path)
    target = make(path)
    if target.getParent() is None or not files.exists(target.getParent()):
        return False
    left = [s.getPath() for s in files.listStatus(target.getParent())]
    old = sorted((x for x in left if x.getName().startswith(target.getName() + _OLD)), key=lambda x: x.getName())
    back = bool(old) and not files.exists(target) and files.rename(old.pop(), target)
    for x in [*old, *(x for x in left if x.getName().startswith(target.getName() + _NEW))]:
        files.delete(x, True)
    return back


def save(df: DataFrame, path: str, append: bool = False) -> DataFrame:
    """Write a table (replacing or adding to what is there) and return it as read back.

    A table that is replaced stays whole until the new one is: rows are written to a folder
    beside it, then the folders are renamed, and the old one is deleted last.  So a table may be
    replaced by rows read from itself, and a write that fails leaves it as it was.  If the driver
    is lost between the renames, ``recover`` (called by the next save) puts the old one back.  One
    job replaces a table at a time.
    """
    spark = df.sparkSession
    files, make = _files(spark, path)
    target = make(path)
    if append or not (files.exists(target) or recover(spark, path)):
        df.write.mode("append" if append else "overwrite").parquet(path)
        return spark.read.parquet(path)
    name = path.rstrip("/")
    # Names sort by time, so that the youngest is put back.
    mark = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    fresh, old = make(name + _NEW + mark), make(name + _OLD + mark)
    try:
        df.write.parquet(fresh.toString())
    except BaseException:
        files.delete(fresh, True)
        raise
    if not files.rename(target, old):
        raise OSError(f"could not take {path} away")
    if not files.rename(fresh, target):
        files.rename(old, target)
        raise OSError(f"could not replace {path}")
    files.delete(old, True)
    return spark.read.parquet(path)


# Rows that are worth a task of their own.
PIECE_ROWS = 5_000


def spread(df: DataFrame) -> DataFrame:
    """The same rows in as many partitions as the session has cores, or more where they were read
    in more; small tables in fewer.

    A file of one row group is read by one task, however many cores there are, and so is all that
    follows it up to the next shuffle.  Rows are counted for this.
    """
    rows = df.count()  # Also makes sure that executors are there to be counted.
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(min(cores, -(-rows // PIECE_ROWS)), df.rdd.getNumPartitions(), 1))


def empty(spark: SparkSession, path: str) -> DataFrame:
    """Delete a table's rows and keep its columns."""
    schema = spark.read.parquet(path).schema
    return save(spark.createDataFrame([], schema), path)


def drop(spark: SparkSession, path: str) -> bool:
    """Delete a table with its files; False when there was none."""
    files, make = _files(spark, path)
    return files.delete(make(path), True)


def save_snapshot(df: DataFrame, path: str, week: str) -> None:
    """Write one week's snapshot of a source; other weeks are left alone."""
    (
        df.withColumn(SNAPSHOT, F.lit(week))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(SNAPSHOT)
        .parquet(path)
    )


def read_snapshot(spark: SparkSession, path: str, week: str) -> DataFrame:
    """One week's snapshot; the filter prunes the other weeks' folders."""
    return spark.read.parquet(path).filter(F.col(SNAPSHOT) == week).drop(SNAPSHOT)


def publish(df: DataFrame, path: str, display_names: dict[str, str]) -> None:
    """Write a report under its display names (text in a header may hold any character)."""
    shown = df.withColumnsRenamed(display_names)
    shown.write.mode("overwrite").option("header", True).csv(path)
