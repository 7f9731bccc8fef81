"""Session settings the operators are designed for.

Broadcasting is never forced by a hint: Spark compares the size of each join
side with its thresholds, at planning time from file statistics and again at
run time from the finished shuffle, and falls back to a shuffled join beyond
them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Runtime SQL settings; safe to apply to a running session.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # split hot join partitions even where that costs a further exchange
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # repeated values make files far smaller than their rows: compare with the broadcast limit as if they did not
    "spark.sql.sources.fileCompressionFactor": "8.0",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(name: str, cpus: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
