"""Raw event files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsight.functions.numbers import hash_bucket
from shopsight.sources.tables import require_sources

# Columns and types of the event files.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("user_session", T.StringType()),
    ]
)
CORRUPT = "_corrupt_record"


def read_raw_csv(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """CSV with header and fixed schema; a value that does not parse becomes null."""
    schema = RAW_SCHEMA
    if keep_corrupt:
        schema = T.StructType([*RAW_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def read_checked_csv(spark: SparkSession, path: str) -> DataFrame:
    require_sources(spark, path)
    return read_raw_csv(spark, path)


def union_periods(frames: dict[str, DataFrame], label: str = "month") -> DataFrame:
    """Concatenate per-period inputs, tagging every row with the name of its period."""
    tagged = [df.withColumn(label, F.lit(name)) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, tagged)


def hash_sample(df: DataFrame, key: Column, percent: int, seed: int = 42) -> DataFrame:
    """Reproducible sample: the same keys whatever the file layout or partitioning."""
    return df.filter(hash_bucket(key, seed, 100) < percent)
