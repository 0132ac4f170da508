"""Silver: keyed events without bot sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.config import SilverConfig
from shopsight.functions.events import UNKNOWN, event_key, is_type, with_category_parts, with_time_parts
from shopsight.operators.joins import exclude_keys


def bot_sessions(events: DataFrame, limit: int) -> DataFrame:
    """Sessions with more than `limit` events: at most rows / limit of them."""
    sizes = events.filter(F.col("user_session").isNotNull()).groupBy("user_session").agg(F.count("*").alias("n"))
    return sizes.filter(F.col("n") > limit)


def drop_bot_sessions(events: DataFrame, limit: int, every: DataFrame | None = None) -> DataFrame:
    """Events of sessions up to `limit` events, counted over `every`; events without a session are kept."""
    return exclude_keys(events, bot_sessions(events if every is None else every, limit), "user_session")


def build_silver(bronze: DataFrame, config: SilverConfig = SilverConfig(), every: DataFrame | None = None) -> DataFrame:
    """Bronze to `events_cleaned`: bot filter, surrogate key, default brand, time parts.

    Where `bronze` is only a part of the events, `every` holds all of them, for the sizes of the sessions.
    """
    return _shaped(drop_bot_sessions(bronze, config.bot_limit, every))


def silver_without(bronze: DataFrame, bots: DataFrame) -> DataFrame:
    """Bronze to `events_cleaned`, where the sessions of bots are known (a stored table)."""
    return _shaped(bronze.join(bots, "user_session", "left_anti"))


def _shaped(kept: DataFrame) -> DataFrame:
    priced = F.col("price_raw").isNotNull() | ~is_type("purchase")
    return (
        with_category_parts(with_time_parts(kept.filter(priced)))
        .withColumn("event_id", event_key())
        .withColumn("brand", F.coalesce("brand", F.lit(UNKNOWN)))
        .drop("price_raw", "_batch")
    )
