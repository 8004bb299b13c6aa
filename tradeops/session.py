"""Session settings the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .sources.staging import staging_root

# Runtime settings only: they can be applied to a session somebody else built.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot join keys even when the aggregate above would have reused the
    # join's partitioning; one more shuffle is cheaper than one endless task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM leaves methods above 8000 bytes of code uncompiled. Fused stages
    # beyond that (the wide reports) run as separate operators instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a running session and return it.

    No operator uses a broadcast hint: a side is broadcast only where Spark's
    own size check (plan statistics, or measured shuffle bytes under adaptive
    execution) finds it below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "tradeops") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    staging_root(spark)
    return tune(spark)
