"""Physical plans keep the properties the jobs need at scale."""

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from shopsight.plans import catalog
from shopsight.sources import shop

LAZY = [
    "bronze_clean", "event_dedup", "dq_metrics", "user_features", "product_features", "session_features", "churn_features",
    "category_stats", "overview_kpis", "daily_revenue", "top_brands_by_category", "top_products", "session_depth",
    "cohort_retention", "category_affinity", "rfm_percent_rank", "upsell_top_k", "roc_curve",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cartesian_product_and_no_python(spark, name):
    plan = plan_of(catalog.queries()[name](spark, SMALL))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
        assert operator not in plan


def test_scan_reads_only_the_columns_used(spark):
    plan = plan_of(catalog.queries()["daily_revenue"](spark, SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert sorted(schemas) == ["l_orderkey:bigint,l_extendedprice:double", "o_orderkey:bigint,o_orderdate:timestamp_ntz"]


def test_product_join_is_dropped_where_no_product_column_is_used(spark):
    for name in ("overview_kpis", "daily_events", "cohort_retention", "session_depth", "run_metadata"):
        assert "p_partkey" not in plan_of(catalog.queries()[name](spark, SMALL)), name


def test_type_filter_reaches_the_scan(spark):
    plan = plan_of(catalog.queries()["churn_features"](spark, SMALL))
    assert "PushedFilters" in plan and "GreaterThanOrEqual(ts" in plan


def test_top_k_per_group_filters_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(catalog.queries()["top_brands_by_category"](spark, SMALL))


def test_global_scores_use_no_window_over_all_rows(spark):
    plan = plan_of(catalog.queries()["rfm_percent_rank"](spark, SMALL))
    assert "Window" not in plan and "SinglePartition" not in plan


def test_hot_product_is_split(spark, folder):
    rows = spark.range(40_000, numPartitions=8)
    product = F.when(F.col("id") % 5 > 0, 5).otherwise(F.col("id") % 100)
    events = rows.select(
        F.col("id").alias("event_id"), F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("ts"), F.col("id").alias("user_id"),
        F.lit("view").alias("event_type"), F.rand(1).alias("value"), F.format_string('{"k": %d}', product).alias("props"))
    events.write.parquet(f"{folder}/events.parquet")
    spark.read.parquet(f"{SMALL}/part.parquet").write.parquet(f"{folder}/part.parquet")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = shop.shop_events(spark, folder)
        assert len(df.collect()) == 40_000
        assert "SortMergeJoin(skew=true)" in plan_of(df)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_distinct_counts_scan_events_once(spark):
    plan = plan_of(catalog.queries()["distinct_counts"](spark, SMALL))
    assert len(re.findall(r"ReadSchema: struct<[^>]*props", plan)) == 1
