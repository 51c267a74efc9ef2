"""Small helpers the operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Sequence
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.sources import tables

# Bytes per Arrow batch.  A batch is held whole by a Python worker: a few hundred texts of usual
# length, or one very long one, or thousands of rows of numbers.
BATCH_BYTES = 1 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


@lru_cache
def _ship(application: str) -> None:
    """Give the executors this package, as a user would with --py-files."""
    package = Path(__file__).resolve().parents[1]
    # The driver's Spark serves this file to the executors as long as the application runs.
    archive = f"{tempfile.mkdtemp(prefix=package.name)}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    SparkSession.active().sparkContext.addPyFile(archive)


def small_batches(spark: SparkSession) -> None:
    """Make Python tasks ready: the package on the executors, and whole texts handed over in
    batches that fit beside the executor's heap."""
    _ship(spark.sparkContext.applicationId)
    spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def partitions(spark: SparkSession) -> int:
    """The number of shuffle partitions, by which salts and buckets grow with the cluster."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and return it as read back.

    It is computed once, ends the lineage, and is still there when an executor is lost.
    """
    return tables.save(df, tables.new_table_path(df.sparkSession, name))


def piece_of(columns: Sequence[str], pieces: int):
    """A piece number that depends on a row's content only, so that a repeated task deals
    every row to the same place."""
    return F.pmod(F.xxhash64(*columns), F.lit(pieces)).cast("int")


def forget(tables_made: list[DataFrame]) -> None:
    """Delete tables made by ``keep`` that no later step reads, and empty the list."""
    for df in tables_made:
        jvm, files = df.sparkSession.sparkContext._jvm, df.inputFiles()
        if files:
            folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    tables_made.clear()


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps.

    It does so when the driver's JVM collects its garbage, which a chain of many small jobs
    may not cause for a long time.
    """
    spark.sparkContext._jvm.System.gc()
