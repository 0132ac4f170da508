"""Bronze: typed, normalised, de-duplicated events."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.config import DEDUP_KEYS, EVENT_TYPES
from shopsight.functions.events import blank_to_null, parse_time, with_category_parts, with_time_parts
from shopsight.sources.tables import write_partitioned

PARTITIONS = ("event_month", "event_date")
BATCH = "_batch"


def clean_events(raw: DataFrame, month: str | None = None) -> DataFrame:
    """Raw text columns to typed ones; rows without a known type, user or time are dropped.

    `price_raw` keeps the parsed price with its nulls, `price` is never null or negative.
    """
    price = F.col("price").try_cast("double")
    usable = price.isNotNull() & ~F.isnan(price) & (price >= 0)
    typed = raw.select(
        parse_time(F.col("event_time").cast("string")).alias("event_time"),
        F.lower(F.trim("event_type")).alias("event_type"),
        F.col("product_id").try_cast("long").alias("product_id"),
        F.col("category_id").try_cast("long").alias("category_id"),
        blank_to_null(F.col("category_code")).alias("category_code"),
        blank_to_null(F.lower("brand")).alias("brand"),
        price.alias("price_raw"),
        F.when(usable, price).otherwise(F.lit(0.0)).alias("price"),
        F.col("user_id").try_cast("long").alias("user_id"),
        blank_to_null(F.col("user_session")).alias("user_session"),
        *[c for c in ("_source",) if c in raw.columns],
    )
    valid = typed.filter(
        F.col("event_type").isin(*EVENT_TYPES) & F.col("user_id").isNotNull() & F.col("event_time").isNotNull()
    )
    events = with_category_parts(with_time_parts(valid))
    return events if month is None else events.filter(F.col("event_month") == month)


def dedup_events(events: DataFrame, keys: tuple[str, ...] = DEDUP_KEYS) -> DataFrame:
    """One row per key; among rows that differ elsewhere, the least by the other columns.

    An aggregate, not a window: copies collapse before the shuffle, so a row repeated
    without end never gathers in one task. Day and month follow from the time; as grouping keys they let a
    filter on days reach the scan.
    """
    group = [*keys, *(c for c in PARTITIONS if c in events.columns and "event_time" in keys)]
    rest = [c for c in events.columns if c not in group]
    least = events.groupBy(*group).agg(F.min(F.struct(*rest)).alias("_row"))
    return least.select(*group, "_row.*").select(*events.columns)


def with_ingestion_columns(events: DataFrame, run_date: str, source: str) -> DataFrame:
    """When, from which file (the pattern where rows don't say) and in which batch the rows arrived."""
    return events.withColumns(
        {
            "_ingested_at": F.current_timestamp(),
            "_source": F.col("_source") if "_source" in events.columns else F.lit(source),
            "_run_date": F.lit(run_date).cast("date"),
            BATCH: F.lit(batch_name(source, run_date)),
        }
    )


def batch_name(source: str, run_date: str) -> str:
    return hashlib.md5(f"{source} {run_date}".encode()).hexdigest()[:12]


def write_bronze(events: DataFrame, path: str) -> None:
    """Each batch has folders of its own within the days: a batch that runs again replaces itself, no other batch."""
    write_partitioned(events, path, (*PARTITIONS, BATCH))
