"""Landing files to bronze, bronze to silver, silver to gold."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.config import DEDUP_KEYS, ChurnConfig, RfmConfig, SilverConfig, UpsellConfig
from shopsight.functions.events import with_category
from shopsight.operators import bronze, churn, features, quality, rfm, upsell
from shopsight.operators.silver import build_silver
from shopsight.sources import tables
from shopsight.sources.raw import read_checked_csv


@dataclass
class IngestReport:
    metrics: DataFrame
    written_rows: int


def ingest(
    spark: SparkSession, source: str, target: str, run_date: str, month: str | None = None
) -> IngestReport:
    """CSV files matching `source` into the bronze table, as one batch. Running it again changes nothing.

    The text is parsed once: typed rows are stored as columns, from which metrics and de-duplication read what they need. (Counters
    observed in passing would save the metrics a column; but Spark 4.1 sessions that have observed fail to ship fitted models.)
    """
    raw = read_checked_csv(spark, source).withColumn("_source", F.col("_metadata.file_path"))
    with tables.temporary(spark):
        landed = tables.materialise(raw, "landed")
        found = quality.dq_metrics(landed)
        metrics = spark.createDataFrame(found.collect(), found.schema)  # one row
        events = bronze.dedup_events(bronze.clean_events(landed, month))
        bronze.write_bronze(bronze.with_ingestion_columns(events, run_date, source), target)
    written = spark.read.parquet(target).filter(F.col(bronze.BATCH) == bronze.batch_name(source, run_date))
    if month is not None:
        written = written.filter(F.col("event_month") == month)
    return IngestReport(metrics, written.count())


def refresh_silver(bronze_events: DataFrame, path: str, config: SilverConfig = SilverConfig()) -> None:
    """Bring silver to what a full rebuild from bronze would give, rewriting only the days that can differ.

    These are the days whose events have changed since the last run, however old, and all days on which the sessions
    of such a day have events, as those may have become bots. Sessions are sized over all events. Batches may
    overlap: events are de-duplicated across them. One row per day passes through the driver.
    """
    spark = bronze_events.sparkSession
    state_path = f"{path.rstrip('/')}_days"
    events = bronze.dedup_events(bronze_events)
    content = F.sum(F.xxhash64(*DEDUP_KEYS, "price_raw").cast("decimal(38,0)")).cast("string")
    days = tables.materialise(events.groupBy("event_date").agg(F.count("*").alias("n"), content.alias("content")), "days")
    if tables.path_exists(spark, state_path):
        known = spark.read.parquet(state_path).toDF("day", "n0", "content0")
        both = days.join(known, days["event_date"] == known["day"], "full")
        differs = ~(F.col("n").eqNullSafe(F.col("n0")) & F.col("content").eqNullSafe(F.col("content0")))
        changed = [r[0] for r in both.filter(differs).select(F.coalesce("event_date", "day")).collect()]
        if not changed:
            return
        sessions = events.filter(F.col("event_date").isin(changed) & F.col("user_session").isNotNull())
        sessions = tables.materialise(sessions.select("user_session").distinct(), "sessions")
        more = events.join(sessions, "user_session", "left_semi").select("event_date").distinct()
        affected = sorted({*changed, *(r[0] for r in more.collect())})
        silver = build_silver(events.filter(F.col("event_date").isin(affected)), config, events)
    else:
        affected, silver = [], build_silver(events, config)
    silver = tables.materialise(silver, "silver")
    tables.write_partitioned(silver, path, bronze.PARTITIONS)
    filled = {r[0] for r in silver.select("event_date").distinct().collect()}
    for day in affected:
        if day not in filled:
            tables.drop_partition(spark, path, event_month=day.strftime("%Y-%m"), event_date=day.isoformat())
    days.write.mode("overwrite").parquet(state_path)


GOLD = ("customer_rfm", "upsell_features", "user_features", "product_features", "session_features", "churn_features")


def build_gold(
    silver: DataFrame, folder: str, rfm_config: RfmConfig = RfmConfig(), churn_config: ChurnConfig = ChurnConfig(),
    upsell_config: UpsellConfig = UpsellConfig(min_views=100),
) -> None:
    """Full refresh of the gold and feature tables, one folder per table."""
    by_root = with_category(silver, "root")
    outputs = {
        "customer_rfm": rfm.customer_rfm(silver, rfm_config),
        "upsell_features": upsell.upsell_features(by_root, upsell_config.alpha, upsell_config.min_views),
        "user_features": features.user_features(silver, rfm_config.ref_date),
        "product_features": features.product_features(silver),
        "session_features": features.session_features(silver),
        "churn_features": churn.churn_features_gold(silver, churn_config),
    }
    for name, df in outputs.items():
        tables.write_table(df.withColumn("computed_at", F.current_timestamp()), f"{folder}/{name}")
