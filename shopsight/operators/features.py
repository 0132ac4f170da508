"""User, product, session and category features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.functions.events import UNKNOWN, category_part, is_type
from shopsight.functions.numbers import cents, from_cents, ratio
from shopsight.operators.rfm import recency_days


def user_features(events: DataFrame, ref_date: str) -> DataFrame:
    """Per buyer: purchases, spend, breadth, first and last purchase, views, carts, ratios.

    Distinct counts multiply rows, so they run over purchases only; views and carts are
    counted in a second narrow aggregate. Both sides end up partitioned by user, and the
    join adds no shuffle.
    """
    bought = (
        events.filter(is_type("purchase"))
        .groupBy("user_id")
        .agg(
            F.count("*").alias("total_purchases"),
            F.sum(cents(F.col("price"))).alias("_cents"),
            F.countDistinct("product_id").alias("unique_products"),
            F.countDistinct(category_part(F.col("category_code"), 0)).alias("unique_categories"),
            F.countDistinct("brand").alias("unique_brands"),
            F.min("event_time").alias("_first"),
            F.max("event_time").alias("_last"),
        )
    )
    browsed = (
        events.filter(F.col("event_type").isin("view", "cart"))
        .groupBy("user_id")
        .agg(F.count_if(is_type("view")).alias("total_views"), F.count_if(is_type("cart")).alias("total_carts"))
    )
    return (
        bought.join(browsed, "user_id", "left")
        .fillna(0, ["total_views", "total_carts"])
        .select(
            "user_id",
            "total_purchases",
            from_cents(F.col("_cents")).alias("total_spend"),
            (from_cents(F.col("_cents")) / F.col("total_purchases")).alias("avg_purchase_price"),
            "unique_products",
            "unique_categories",
            "unique_brands",
            F.unix_micros("_first").alias("first_purchase_us"),
            F.unix_micros("_last").alias("last_purchase_us"),
            "total_views",
            "total_carts",
            recency_days(F.col("_last"), ref_date).alias("recency_days"),
            ratio(F.col("total_carts"), F.col("total_purchases")).alias("cart_to_pur_ratio"),
            ratio(F.col("total_views"), F.col("total_purchases")).alias("view_to_pur_ratio"),
        )
    )


def product_features(events: DataFrame) -> DataFrame:
    """Per (product, category, brand) bought: purchases, revenue, price; views and carts per product."""
    bought = (
        events.filter(is_type("purchase"))
        .groupBy("product_id", "category_code", "brand")
        .agg(F.count("*").alias("total_purchases"), F.sum(cents(F.col("price"))).alias("_cents"))
    )
    browsed = (
        events.filter(F.col("event_type").isin("view", "cart"))
        .groupBy("product_id")
        .agg(F.count_if(is_type("view")).alias("total_views"), F.count_if(is_type("cart")).alias("total_carts"))
    )
    return (
        bought.join(browsed, "product_id", "left")
        .fillna(0, ["total_views", "total_carts"])
        .select(
            "product_id",
            "category_code",
            "brand",
            "total_purchases",
            from_cents(F.col("_cents")).alias("total_revenue"),
            (from_cents(F.col("_cents")) / F.col("total_purchases")).alias("avg_price"),
            "total_views",
            "total_carts",
            ratio(F.col("total_purchases"), F.col("total_views")).alias("conversion_rate"),
        )
    )


def session_features(events: DataFrame) -> DataFrame:
    """Per session; `session_value` sums all prices, `session_revenue` purchases only."""
    amount = F.coalesce(cents(F.col("price")), F.lit(0))
    sessions = (
        events.filter(F.col("user_session").isNotNull())
        .groupBy("user_session")
        .agg(
            F.min(F.struct("event_time", "user_id")).alias("_start"),
            F.max("event_time").alias("_end"),
            F.count("*").alias("session_events"),
            F.count_if(is_type("purchase")).alias("session_purchases"),
            F.sum(amount).alias("_value"),
            F.sum(F.when(is_type("purchase"), amount).otherwise(0)).alias("_revenue"),
        )
    )
    start, end = F.unix_micros("_start.event_time"), F.unix_micros("_end")
    return sessions.select(
        "user_session",
        F.col("_start.user_id").alias("user_id"),
        "session_events",
        "session_purchases",
        from_cents(F.col("_value")).alias("session_value"),
        from_cents(F.col("_revenue")).alias("session_revenue"),
        start.alias("session_start_us"),
        end.alias("session_end_us"),
        (F.greatest(end - start, F.lit(0)) / F.lit(60_000_000.0)).alias("duration_minutes"),
        (F.col("session_purchases") > 0).cast("int").alias("converted"),
    )


def category_stats(events: DataFrame, include_unknown: bool = False) -> DataFrame:
    """Per `category`: views, carts, purchases, revenue, mean purchase price."""
    bought = is_type("purchase")
    known = events if include_unknown else events.filter(F.col("category") != UNKNOWN)
    stats = known.groupBy("category").agg(
        F.count_if(is_type("view")).alias("total_views"),
        F.count_if(is_type("cart")).alias("total_carts"),
        F.count_if(bought).alias("total_purchases"),
        F.coalesce(F.sum(F.when(bought, cents(F.col("price")))), F.lit(0)).alias("_cents"),
    )
    revenue = from_cents(F.col("_cents"))
    return stats.select(
        "category",
        "total_views",
        "total_carts",
        "total_purchases",
        revenue.alias("total_revenue"),
        F.try_divide(revenue, F.col("total_purchases")).alias("avg_price"),
    )


def user_categories(events: DataFrame, include_unknown: bool = False) -> DataFrame:
    """Distinct (user, category) bought."""
    bought = events.filter(is_type("purchase"))
    if not include_unknown:
        bought = bought.filter(F.col("category") != UNKNOWN)
    return bought.select("user_id", "category").distinct()


def distinct_counts(events: DataFrame) -> DataFrame:
    """Exact numbers of users, products, categories, brands and sessions.

    One scan: every event gives one narrow (entity, value) row per column, and tasks collapse repeats before the shuffle.
    """
    columns = ["user_id", "product_id", "category_code", "brand", "user_session"]
    pairs = [F.struct(F.lit(c).alias("entity"), F.col(c).cast("string").alias("value")) for c in columns]
    values = events.select(F.inline(F.array(*pairs))).distinct()
    counts = values.agg(*[F.count(F.when(F.col("entity") == c, F.col("value"))).alias(c) for c in columns])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("entity"), F.col(c).alias("distinct_values")) for c in columns])))
