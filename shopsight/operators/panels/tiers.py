"""Tier columns the panels colour by."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.functions.labels import churn_rate_band, conversion_tier, depth_tier


def panel_tiers(conversion: DataFrame, depth: DataFrame, cohort: DataFrame, histogram: DataFrame) -> DataFrame:
    """Rows (panel, key, value, tier) for conversion, session depth, churn rate and score bins."""
    bin_tier = F.when(F.col("bin_start") < 0.35, "low").when(F.col("bin_start") < 0.60, "medium").otherwise("high")

    def rows(df: DataFrame, panel: str, key, value, tier) -> DataFrame:
        return df.select(
            F.lit(panel).alias("panel"), key.cast("string").alias("key"), value.cast("double").alias("value"), tier.alias("tier")
        )

    parts = [
        rows(conversion, "category_conversion", F.concat_ws("/", "slice", "category"), F.col("rate"), conversion_tier(F.col("rate"))),
        rows(depth, "session_depth", F.concat_ws("/", "slice", F.col("depth").cast("string")), F.col("depth"), depth_tier(F.col("depth"))),
        rows(cohort, "churn_rate", F.lit("churn_rate"), F.col("churn_rate"), churn_rate_band(F.col("churn_rate"))),
        rows(histogram, "score_histogram", F.col("bin"), F.col("bin_start"), bin_tier),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
