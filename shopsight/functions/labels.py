"""Segments, risk tiers and panel tiers as `when` chains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Segment, churn risk, upsell priority.
SEGMENT_ACTIONS = (
    ("Champions", "Low", "High"),
    ("Loyal", "Low", "High"),
    ("Potential Loyalist", "Low", "Medium"),
    ("At Risk", "High", "Medium"),
    ("Needs Attention", "Medium", "Low"),
    ("Can't Lose", "High", "Low"),
    ("Hibernating", "High", "Very Low"),
    ("Lost", "Very High", "Very Low"),
)


def segment(r: Column, f: Column) -> Column:
    """Customer segment from recency and frequency scores, first matching rule wins."""
    # Bounds and names.
    return (
        F.when((r >= 4) & (f >= 4), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal")
        .when(r >= 3, "Potential Loyalist")
        .when((r == 2) & (f >= 3), "At Risk")
        .when((r == 2) & (f == 2), "Needs Attention")
        .when((r == 1) & (f >= 3), "Can't Lose")
        .when((r == 1) & (f == 2), "Hibernating")
        .otherwise("Lost")
    )


def risk_tier(score: Column) -> Column:
    """[0, 0.35] Low, (0.35, 0.60] Medium, (0.60, 1] High; anything else has no tier."""
    return (
        F.when((score >= 0) & (score <= 0.35), "Low")
        .when((score > 0.35) & (score <= 0.60), "Medium")
        .when((score > 0.60) & (score <= 1), "High")
    )


def conversion_tier(percent: Column) -> Column:
    return F.when(percent > 2, "high").when(percent > 1, "medium").otherwise("low")


def depth_tier(depth: Column) -> Column:
    return F.when(depth >= 15, "deep").when(depth >= 5, "medium").otherwise("shallow")


def churn_rate_band(percent: Column) -> Column:
    return F.when(percent < 30, "low").when(percent < 70, "medium").otherwise("high")
