"""Expressions over the columns of one event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.functions.numbers import cents

UNKNOWN = "unknown"


def parse_time(text: Column) -> Column:
    """UTC timestamp from text such as '2019-11-01 00:00:00 UTC'; null where it does not parse."""
    return F.try_to_timestamp(F.regexp_replace(text, " UTC$", ""))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def category_part(code: Column, position: int) -> Column:
    """Zero-based part of a dotted code; null where the part is missing or empty."""
    part = F.substring_index(code, ".", 1) if position == 0 else F.split_part(code, F.lit("."), F.lit(position + 1))
    return F.nullif(part, F.lit(""))


def is_type(event_type: str) -> Column:
    return F.col("event_type") == event_type


def event_key() -> Column:
    """md5 over the five identifying columns, nulls as empty text."""
    parts = [
        F.col("user_id").cast("string"),
        F.col("user_session"),
        F.unix_micros("event_time").cast("string"),
        F.col("event_type"),
        F.col("product_id").cast("string"),
    ]
    return F.md5(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]))


def with_time_parts(events: DataFrame) -> DataFrame:
    return events.withColumns(
        {
            "event_date": F.to_date("event_time"),
            "event_month": F.date_format("event_time", "yyyy-MM"),
            "event_hour": F.hour("event_time"),
            "event_weekday": F.date_format("event_time", "EEEE"),
        }
    )


def with_category_parts(events: DataFrame) -> DataFrame:
    return events.withColumns(
        {
            "category_root": category_part(F.col("category_code"), 0),
            "category_sub": category_part(F.col("category_code"), 1),
        }
    )


def with_category(events: DataFrame, level: str = "root") -> DataFrame:
    """`category` for panels and recommendations: the root or the whole code, never null."""
    source = {
        "root": category_part(F.col("category_code"), 0),
        "full": F.nullif(F.col("category_code"), F.lit("")),
    }[level]
    return events.withColumn("category", F.coalesce(source, F.lit(UNKNOWN)))


def as_facts(events: DataFrame, level: str = "root") -> DataFrame:
    """Events with their panel dimensions and two measures: n events, cents of price."""
    return with_category(with_time_parts(events), level).select(
        "event_month",
        "event_date",
        "event_hour",
        "event_weekday",
        "category",
        F.coalesce("brand", F.lit(UNKNOWN)).alias("brand"),
        "product_id",
        "event_type",
        F.lit(1).cast("long").alias("n"),
        F.coalesce(cents(F.col("price")), F.lit(0).cast("long")).alias("cents"),
    )
