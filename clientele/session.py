"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings.  They are applied to a session that already exists, so a
# cluster's own values for memory, shuffle partitions and file splits stay as they are.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Let a skewed join be split even when the step above it has to shuffle once more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Dates are read from zone-less text and timestamps; pin the zone they are shown in.
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to ``spark`` and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "clientele") -> SparkSession:
    """A local session for tests and the benchmark; a cluster job brings its own."""
    parallelism = str(cores) if cores != "*" else "8"
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", parallelism)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # Plans are built from many small column expressions; recording the Python call
        # site of each one costs more than building it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
