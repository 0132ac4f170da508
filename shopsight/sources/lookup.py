"""Score tables for point look-ups: one key reads one bucket, and there the row groups that may hold it.

Rows are dealt into buckets by a hash of the key, a folder each, and sorted by key within their files; Parquet keeps the least and
the largest key of a row group, and a Bloom filter of its keys. A look-up names its bucket, so the other folders are not even
listed among its files. The table is published in versions, so readers never meet a half-written one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.sources import versions

BUCKET = "bucket"


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def publish_lookup(df: DataFrame, root: str, key: str, buckets: int = 64) -> None:
    """Store `df` for look-ups by `key`; choose buckets of a few files' size. A key of many rows stays in one bucket."""
    spark, folder = df.sparkSession, versions.new_version(root)
    dealt = df.withColumn(BUCKET, _bucket(F.col(key), buckets)).repartition(BUCKET).sortWithinPartitions(BUCKET, key)
    dealt.write.option(f"parquet.bloom.filter.enabled#{key}", "true").partitionBy(BUCKET).parquet(folder)
    versions.write_text(spark, f"{folder}/_about", f"{key} {df.schema[key].dataType.simpleString()} {buckets}")
    versions.commit(spark, root, folder)


def lookup(spark: SparkSession, root: str, value: object) -> DataFrame:
    """The rows of one key."""
    folder = versions.current(spark, root)
    if folder is None:
        raise FileNotFoundError(f"no version of {root}")
    key, kind, buckets = versions.read_text(spark, f"{folder}/_about").split(" ")
    wanted = F.lit(value).cast(kind)
    rows = spark.read.parquet(folder).where((F.col(BUCKET) == _bucket(wanted, int(buckets))) & (F.col(key) == wanted))
    return rows.drop(BUCKET)
