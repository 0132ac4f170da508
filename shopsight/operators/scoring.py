"""Score tables and the look-ups served from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.functions.labels import risk_tier
from shopsight.operators.ranking import top_per_group


SEGMENT_COLUMNS = ("segment", "rfm_score", "r_score", "f_score", "m_score", "recency", "frequency", "monetary")


def with_risk(scores: DataFrame) -> DataFrame:
    return scores.withColumn("churn_risk", risk_tier(F.col("churn_score")))


def rule_score(features: DataFrame) -> DataFrame:
    """Recency as a share of the longest recency: a score both engines can compute."""
    longest = features.agg(F.max("recency").alias("m"))
    return features.withColumn("churn_score", F.col("recency") / F.greatest(longest.scalar(), F.lit(1)))


def top_churn(scores: DataFrame, n: int = 100) -> DataFrame:
    return scores.select("user_id", "churn_score", "churn_risk").orderBy(F.col("churn_score").desc(), "user_id").limit(n)


def score_overview(rfm: DataFrame, churn: DataFrame) -> DataFrame:
    """Rows (metric, key, value): users, high-risk users, mean score, segment sizes."""
    totals = churn.agg(
        F.count_if(F.col("churn_risk") == "High").alias("high"), F.avg("churn_score").alias("mean")
    ).select(
        F.inline(
            F.array(
                _entry("churned_users", F.lit(None).cast("string"), F.col("high")),
                _entry("avg_churn_score", F.lit(None).cast("string"), F.round(F.coalesce("mean", F.lit(0.0)), 6)),
            )
        )
    )
    users = rfm.agg(F.count("*").alias("n")).select(
        F.inline(F.array(_entry("total_users", F.lit(None).cast("string"), F.col("n"))))
    )
    segments = rfm.groupBy("segment").agg(F.count("*").alias("n")).select(
        F.inline(F.array(_entry("segment", F.col("segment"), F.col("n"))))
    )
    return users.unionByName(totals).unionByName(segments)


def _entry(metric, key, value):
    return F.struct(F.lit(metric).alias("metric"), key.alias("key"), value.cast("double").alias("value"))


def lookup_scores(requested: DataFrame, churn: DataFrame, rfm: DataFrame, upsell: DataFrame, top_k: int = 5) -> DataFrame:
    """Batch form of the score look-ups: one row per requested user, with found flags.

    Recommendations come as an array of at most `top_k` names, best first.
    """
    best = (
        top_per_group(upsell, ["user_id"], [F.col("upsell_score").desc(), F.col("rank")], top_k, rank="_k")
        .groupBy("user_id")
        .agg(F.sort_array(F.collect_list(F.struct("_k", "category"))).alias("_top"))
    )
    return (
        requested.select("user_id")
        .join(churn.select("user_id", "churn_score", "churn_risk"), "user_id", "left")
        .join(rfm.select("user_id", *SEGMENT_COLUMNS), "user_id", "left")
        .join(best, "user_id", "left")
        .select(
            "user_id",
            F.col("churn_score").isNotNull().alias("churn_found"),
            "churn_score",
            "churn_risk",
            F.col("segment").isNotNull().alias("segment_found"),
            *SEGMENT_COLUMNS,
            F.col("_top").isNotNull().alias("upsell_found"),
            F.concat_ws(",", F.transform("_top", lambda t: t["category"])).alias("recommendations"),
        )
    )


def lookup_upsell(requested: DataFrame, upsell: DataFrame, top_k: int = 5) -> DataFrame:
    """One row per requested user and recommendation with its scores; users without any have one row, not found."""
    best = top_per_group(upsell, ["user_id"], [F.col("upsell_score").desc(), F.col("rank")], top_k, rank="_k")
    return requested.select("user_id").join(best, "user_id", "left").select(
        "user_id",
        F.col("_k").isNotNull().alias("found"),
        F.col("_k").alias("rank"),
        "category",
        "upsell_score",
        "opportunity",
        "affinity",
    )
