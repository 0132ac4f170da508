"""Registered queries that run whole jobs over the given tables: landing to bronze, gold, published tables, resumed streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.config import CHURN_FEATURES, UpsellConfig
from shopsight.operators import bronze, quality, scoring
from shopsight.plans import catalog, ingest
from shopsight.session import prepare
from shopsight.sources import lookup, ordered, shop, tables
from shopsight.streaming import jobs, resumable

Query = Callable[[SparkSession, str], DataFrame]
RUN_DATE = "2024-01-31"
GOLD_UPSELL = UpsellConfig(alpha=1.0, min_views=10)


def _landed(spark, d, label, events):
    """A folder of CSV files, as they come from outside."""
    path = tables.scratch_path(prepare(spark), label)
    events.select(*shop.RAW_TEXT_COLUMNS).write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return path


def ingest_report(spark, d):
    """Quality metrics that the ingestion of all events takes while it reads them."""
    source = _landed(spark, d, "landing", shop.shop_events_dirty(spark, d))
    return ingest.ingest(spark, source, tables.scratch_path(spark, "bronze"), RUN_DATE).metrics


def ingestion_columns(spark, d):
    """Two batches: from which landing folder, on which date and in which batch every bronze row came."""
    dirty, target = shop.shop_events_dirty(spark, d), tables.scratch_path(prepare(spark), "bronze")
    early = F.col("event_time") < catalog.SILVER_CUT
    known = F.lit(False)
    for label, part in (("early", dirty.where(early)), ("late", dirty.where(~early))):
        source = _landed(spark, d, f"landed-{label}", part)
        ingest.ingest(spark, source, target, RUN_DATE)
        known = known | ((F.col("landing") == label) & (F.col(bronze.BATCH) == bronze.batch_name(source, RUN_DATE)))
    rows = spark.read.parquet(target).withColumn("landing", F.regexp_extract("_source", "/landed-([a-z]+)-", 1))
    return rows.select(
        F.unix_micros("event_time").alias("event_us"), "event_type", "product_id", "user_id", "user_session",
        F.col("_run_date").alias("run_date"), "landing", known.alias("batch_named"),
    )


def gold_tables(spark, d):
    """Rows of every gold and feature table after a full refresh."""
    folder = tables.scratch_path(prepare(spark), "gold")
    ingest.build_gold(catalog._events(spark, d), folder, catalog.EVENTS_RFM, catalog.EVENTS_CHURN, GOLD_UPSELL)
    counts = None
    for name in ingest.GOLD:
        part = spark.read.parquet(f"{folder}/{name}").agg(F.count("*").alias("rows"), F.count("computed_at").alias("stamped"))
        part = part.select(F.lit(name).alias("table"), "rows", "stamped")
        counts = part if counts is None else counts.unionAll(part)
    return counts


def source_presence(spark, d):
    """Which of the sources of a run are there."""
    names = ("events", "orders", "lineitem", "part", "customer", "returns")
    return tables.source_report(prepare(spark), {n: f"{d}/{n}.parquet" for n in names})


def repaired_features(spark, d):
    """Model inputs of which two columns were missing and are filled in on request."""
    found = catalog._churn_features(spark, d).drop("n_carts", "unique_brands")
    return quality.require_columns(found, CHURN_FEATURES, fill_missing=True).select("user_id", *CHURN_FEATURES)


def sorted_revenue(spark, d):
    """Revenue of every product, stored in its global order; positions follow from file and row."""
    path = tables.scratch_path(prepare(spark), "sorted-revenue")
    revenue = shop.shop_purchases(spark, d).groupBy("product_id").agg(F.sum(F.round(F.col("price") * 100).cast("long")).alias("revenue_cents"))
    ordered.write_ordered(revenue, path, F.col("revenue_cents").desc(), F.col("product_id").asc())
    return ordered.read_ordered(spark, path).select("position", "product_id", "revenue_cents")


POINTS = (1, 7, 12, 10_000_000)


def score_lookup_point(spark, d):
    """Segments of a few users, each read from its bucket of the published table; one user is unknown."""
    path = tables.scratch_path(prepare(spark), "scores")
    lookup.publish_lookup(catalog._event_rfm(spark, d).select("user_id", *scoring.SEGMENT_COLUMNS), path, "user_id")
    found = None
    for user in POINTS:
        asked = spark.range(1).select(F.lit(user).cast("long").alias("asked"))
        rows = lookup.lookup(spark, path, user)
        part = asked.join(rows, F.col("asked") == F.col("user_id"), "left")
        found = part if found is None else found.unionAll(part)
    return found.select("asked", F.col("user_id").isNotNull().alias("found"), *scoring.SEGMENT_COLUMNS)


def _resumed(spark, d, label, reduce):
    """The event table in two arrivals, the second with rows that are late; the stream stops in between."""
    source, path = tables.scratch_path(prepare(spark), f"{label}-source"), tables.scratch_path(spark, label)
    checkpoint = tables.scratch_path(spark, f"{label}-checkpoint")
    rows = spark.read.schema(shop.TABLE_SCHEMAS["events"]).parquet(f"{d}/events.parquet")
    first = (F.col("ts") < F.lit(catalog.SILVER_CUT).cast("timestamp_ntz")) & (F.col("event_id") % 10 != 0)
    for part in (rows.where(first), rows.where(~first)):
        part.write.mode("append").parquet(source)
        stream = shop.from_event_rows(jobs.event_stream(spark, source, shop.TABLE_SCHEMAS["events"]))
        resumable.resume(stream, reduce, path, checkpoint)
    return path


def stream_daily_resumed(spark, d):
    path = _resumed(spark, d, "days", resumable.day_parts)
    resumable.compact(spark, path, resumable.daily)
    return resumable.daily(spark, path)


def stream_sessions_resumed(spark, d):
    return resumable.sessions(spark, _resumed(spark, d, "sessions", resumable.session_parts()))


def stream_late_rows(spark, d):
    path = _resumed(spark, d, "late", resumable.day_parts)
    schema = "event_id long, event_time timestamp, event_type string, product_id long, price double, user_id long, user_session string"
    return resumable.late_rows(spark, path, schema).select("event_id", F.unix_micros("event_time").alias("event_us"), "event_type", "batch")


def queries() -> dict[str, Query]:
    return {
        "ingest_report": ingest_report,
        "ingestion_columns": ingestion_columns,
        "gold_tables": gold_tables,
        "source_presence": source_presence,
        "repaired_features": repaired_features,
        "sorted_revenue": sorted_revenue,
        "score_lookup_point": score_lookup_point,
        "stream_daily_resumed": stream_daily_resumed,
        "stream_sessions_resumed": stream_sessions_resumed,
        "stream_late_rows": stream_late_rows,
    }
