"""Recency, frequency, monetary: base table, scores and customer segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.config import RfmConfig
from shopsight.functions.events import category_part, is_type
from shopsight.functions.labels import SEGMENT_ACTIONS, segment
from shopsight.functions.numbers import cents, from_cents, hash_order
from shopsight.operators import ranking
from shopsight.sources.tables import materialise

METRICS = ["recency", "frequency", "monetary_cents"]


def recency_days(last: Column, ref_date: str, mode: str = "elapsed") -> Column:
    """Whole 24-hour periods since `last`, or calendar days between the two dates."""
    if mode == "calendar":
        return F.datediff(F.lit(ref_date).cast("date"), F.to_date(last))
    elapsed = F.unix_micros(F.lit(ref_date).cast("timestamp")) - F.unix_micros(last)
    return F.floor(elapsed / F.lit(86_400_000_000)).cast("int")


def purchases_of(events: DataFrame, min_price: float | None = None) -> DataFrame:
    purchases = events.filter(is_type("purchase"))
    return purchases if min_price is None else purchases.filter(F.col("price") > min_price)


def rfm_base(events: DataFrame, config: RfmConfig = RfmConfig(), breadth: bool = True) -> DataFrame:
    """One row per buyer with positive spend.

    `breadth` adds distinct counts. They are two-phase aggregates on (user, value), so even
    a user with a third of all purchases is counted by many tasks.
    """
    measures = [
        F.max("event_time").alias("_last"),
        F.min("event_time").alias("_first"),
        F.count("*").alias("frequency"),
        F.sum(cents(F.col("price"))).alias("monetary_cents"),
    ]
    wide = []
    if breadth:
        measures += [
            F.countDistinct(category_part(F.col("category_code"), 0)).alias("unique_categories"),
            F.countDistinct("brand").alias("unique_brands"),
            F.countDistinct("product_id").alias("unique_products"),
        ]
        wide = ["unique_categories", "unique_brands", "unique_products"]
    grouped = purchases_of(events, config.min_purchase_price).groupBy("user_id").agg(*measures)
    return grouped.filter(F.col("monetary_cents") > 0).select(
        "user_id",
        recency_days(F.col("_last"), config.ref_date, config.recency).alias("recency"),
        "frequency",
        "monetary_cents",
        from_cents(F.col("monetary_cents")).alias("monetary"),
        (from_cents(F.col("monetary_cents")) / F.col("frequency")).alias("avg_price"),
        *wide,
        F.to_date("_first").alias("first_purchase_date"),
        F.to_date("_last").alias("last_purchase_date"),
    )


def with_scores(base: DataFrame, config: RfmConfig = RfmConfig()) -> DataFrame:
    """r, f, m scores with 5 = best, whatever the method.

    Scores depend on a value (or value and user) alone, so each needs only bins - 1 cut
    points. Those are the only data that reach the driver; the scoring itself is a projection.
    """
    base = materialise(base, "rfm")
    recency, frequency, monetary = (F.col(m) for m in METRICS)
    if config.method == "ntile":
        oriented = base.withColumn("recency", -recency)
        cuts = ranking.ntile_cuts(oriented, METRICS, "user_id", config.bins)
        user = F.col("user_id")
        scores = {
            "r_score": ranking.ntile_score(-recency, user, cuts.get("recency", [])),
            "f_score": ranking.ntile_score(frequency, user, cuts.get("frequency", [])),
            "m_score": ranking.ntile_score(monetary, user, cuts.get("monetary_cents", [])),
        }
    else:
        find = {"percent_rank": ranking.percent_rank_cuts, "qcut": ranking.quantile_cuts}[config.method]
        cuts = find(base, METRICS, config.bins)
        scores = {
            "r_score": ranking.value_score(recency, cuts.get("recency", []), config.bins, descending=True),
            "f_score": ranking.value_score(frequency, cuts.get("frequency", []), config.bins),
            "m_score": ranking.value_score(monetary, cuts.get("monetary_cents", []), config.bins),
        }
    return base.withColumns(scores).withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))


def customer_rfm(events: DataFrame, config: RfmConfig = RfmConfig(), breadth: bool = True) -> DataFrame:
    """Scored and segmented buyers."""
    scored = with_scores(rfm_base(events, config, breadth), config)
    return scored.withColumn("segment", segment(F.col("r_score"), F.col("f_score"))).drop("monetary_cents")


def segment_counts(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("segment").agg(F.count("*").alias("customers"))


def segment_actions(rfm: DataFrame) -> DataFrame:
    """Segment sizes with churn risk and upsell priority from the fixed eight-row table."""
    spark = rfm.sparkSession
    actions = spark.createDataFrame(list(SEGMENT_ACTIONS), "segment string, churn_risk string, upsell_priority string")
    return segment_counts(rfm).join(F.broadcast(actions), "segment")


def rfm_sample(rfm: DataFrame, size: int = 5000, seed: int = 42) -> DataFrame:
    """At most `size` buyers for a scatter plot, the same ones on every run."""
    sampled = rfm.withColumn("_order", hash_order(F.col("user_id"), seed)).orderBy("_order", "user_id").limit(size)
    return sampled.select("user_id", "recency", "frequency", "monetary", "rfm_score", "segment")
