"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE measures every shuffle and splits a join partition that one hot key has
# filled. The last setting lets it do so also where a later aggregate or window
# was going to reuse the join's partitioning: without it such a plan keeps the
# hot key whole in one task.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows with whole texts go to Python and back in batches of a few MB, not of 10,000 rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that the session has not set itself."""
    given = spark.conf.getAll
    for key, value in RUNTIME.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: str = "*", name: str = "rankloom", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
