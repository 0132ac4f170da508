"""Buyer cohorts, churn labels and leak-free churn features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.config import ChurnConfig, RfmConfig
from shopsight.functions.events import category_part, is_type
from shopsight.functions.numbers import cents, from_cents, panel_number, ratio
from shopsight.operators.rfm import customer_rfm, recency_days


def in_period(start: str, end: str) -> Column:
    """event_time in [start, end)."""
    time = F.col("event_time")
    return (time >= F.lit(start).cast("timestamp")) & (time < F.lit(end).cast("timestamp"))


def buyers(events: DataFrame, start: str, end: str) -> DataFrame:
    return events.filter(is_type("purchase") & in_period(start, end)).select("user_id").distinct()


def retained_buyers(events: DataFrame, config: ChurnConfig) -> DataFrame:
    return buyers(events, config.start, config.cut).intersect(buyers(events, config.cut, config.end))


def churned_buyers(events: DataFrame, config: ChurnConfig) -> DataFrame:
    return buyers(events, config.start, config.cut).subtract(buyers(events, config.cut, config.end))


def new_buyers(events: DataFrame, config: ChurnConfig) -> DataFrame:
    return buyers(events, config.cut, config.end).subtract(buyers(events, config.start, config.cut))


def _flags(events: DataFrame, config: ChurnConfig) -> DataFrame:
    """Per buyer of either period: bought before / after the cut. One pass, one shuffle."""
    return (
        events.filter(is_type("purchase") & in_period(config.start, config.end))
        .groupBy("user_id")
        .agg(
            F.max(F.col("event_time") < F.lit(config.cut).cast("timestamp")).alias("before"),
            F.max(F.col("event_time") >= F.lit(config.cut).cast("timestamp")).alias("after"),
        )
    )


def cohort_retention(events: DataFrame, config: ChurnConfig) -> DataFrame:
    before, after = F.col("before"), F.col("after")
    counts = _flags(events, config).agg(
        F.count_if(before).alias("period_buyers"),
        F.count_if(after).alias("next_period_buyers"),
        F.count_if(before & after).alias("retained"),
        F.count_if(before & ~after).alias("churned"),
        F.count_if(~before & after).alias("new_buyers"),
    )
    rate = F.lit(100) * F.col("churned") / F.greatest("period_buyers", F.lit(1))
    return counts.withColumn("churn_rate", panel_number(rate))


def churn_labels(events: DataFrame, config: ChurnConfig) -> DataFrame:
    """(user_id, churned) for buyers of the observation period."""
    return _flags(events, config).filter("before").select("user_id", (~F.col("after")).cast("int").alias("churned"))


def churn_features(events: DataFrame, config: ChurnConfig) -> DataFrame:
    """Features strictly before the cut, label from [cut, end).

    Two aggregates by user and a join of co-partitioned results: breadth over observed
    purchases, activity counts and the label flag over the narrow remainder.
    """
    observed = in_period(config.start, config.cut)
    bought = (
        events.filter(is_type("purchase") & observed)
        .groupBy("user_id")
        .agg(
            F.count("*").alias("frequency"),
            F.sum(cents(F.col("price"))).alias("_cents"),
            F.max("event_time").alias("_last"),
            F.countDistinct(category_part(F.col("category_code"), 0)).alias("unique_cats"),
            F.countDistinct("brand").alias("unique_brands"),
            F.countDistinct("product_id").alias("unique_prods"),
        )
    )
    late = F.col("event_time") >= F.lit(config.cut).cast("timestamp")
    activity = (
        events.filter(in_period(config.start, config.end))
        .filter(F.col("event_type").isin("view", "cart") & ~late | is_type("purchase") & late)
        .groupBy("user_id")
        .agg(
            F.count_if(is_type("view")).alias("n_views"),
            F.count_if(is_type("cart")).alias("n_carts"),
            F.count_if(is_type("purchase")).alias("_later"),
        )
    )
    joined = bought.join(activity, "user_id", "left").fillna(0, ["n_views", "n_carts", "_later"])
    return joined.select(
        "user_id",
        "frequency",
        from_cents(F.col("_cents")).alias("monetary"),
        (from_cents(F.col("_cents")) / F.col("frequency")).alias("avg_price"),
        recency_days(F.col("_last"), config.reference).alias("recency"),
        "unique_cats",
        "unique_brands",
        "unique_prods",
        "n_views",
        "n_carts",
        ratio(F.col("n_carts"), F.col("frequency")).alias("cart_to_pur_ratio"),
        (F.col("_later") == 0).cast("int").alias("churned"),
    )


def churn_features_gold(events: DataFrame, config: ChurnConfig) -> DataFrame:
    """Churn features beside the RFM scores and segment of the same observation period."""
    observed = events.filter(in_period(config.start, config.cut))
    scored = customer_rfm(observed, RfmConfig(ref_date=config.reference), breadth=False)
    segments = scored.select("user_id", "r_score", "f_score", "m_score", "rfm_score", "segment")
    return churn_features(events, config).join(segments, "user_id", "left")
