"""Session settings the results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession


# Runtime settings every job relies on. Days, hours and months are those of UTC.
# A join partition that one hot key fills is split even if that costs another shuffle later.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Where nothing is set: small shuffle partitions are merged up to 16 MB only. Compressed rows of sorted keys grow tenfold and more in a
# task's sorts and hash tables, and a task that reads 64 MB (Spark's default) needs gigabytes.
# A join of which one side has no shuffle partition above 16 MB builds hash tables of that side and sorts neither; any other is sorted, and
# spills, as before.
DEFAULTS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16m",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str, **conf: str) -> SparkSession:
    """Session for a job; deployment settings (master, memory) come from spark-submit."""
    builder = SparkSession.builder.appName(app_name).config("spark.sql.parquet.compression.codec", "snappy")
    builder = builder.config("spark.scheduler.mode", "FAIR")  # fits run beside each other
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())
