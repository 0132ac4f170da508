"""Idempotent writes, incremental silver, ingestion end to end."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from shopsight.config import SilverConfig
from shopsight.operators import bronze
from shopsight.plans import catalog, dashboard, ingest
from shopsight.sources import raw, shop, tables


def snapshot(spark, path):
    df = spark.read.parquet(path)
    columns = sorted(c for c in df.columns if c != "_ingested_at")
    return sorted(map(str, df.select(columns).collect()))


def landing(spark, folder):
    path = f"{folder}/landing"
    shop.shop_events_dirty(spark, SMALL).select(*shop.RAW_TEXT_COLUMNS).write.option("header", True).csv(path)
    return path


def test_ingest_twice_changes_nothing(spark, folder):
    source, target = landing(spark, folder), f"{folder}/bronze"
    first = ingest.ingest(spark, source, target, "2024-01-31")
    before = snapshot(spark, target)
    again = ingest.ingest(spark, source, target, "2024-01-31")
    assert snapshot(spark, target) == before
    assert first.written_rows == again.written_rows == len(before)
    assert first.metrics.first().total_rows == 1020


def test_missing_source_fails_before_any_job(spark, folder):
    with pytest.raises(FileNotFoundError):
        ingest.ingest(spark, f"{folder}/none/*.csv", f"{folder}/bronze", "2024-01-31")


def test_corrupt_lines_can_be_kept(spark, folder):
    rows = raw.read_raw_csv(spark, landing(spark, folder), keep_corrupt=True).cache()
    assert rows.filter(F.col(raw.CORRUPT).isNotNull() & F.col("price").isNotNull()).count() == 0
    assert rows.filter(F.col(raw.CORRUPT).isNotNull()).count() > 0


def test_write_replaces_only_its_partitions(spark, folder):
    path = f"{folder}/t"
    rows = spark.createDataFrame([("m", "2024-01-01", 1), ("m", "2024-01-02", 2)], "event_month string, event_date string, v int")
    tables.write_partitioned(rows, path, bronze.PARTITIONS)
    tables.write_partitioned(rows.filter("v = 2").withColumn("v", F.lit(9)), path, bronze.PARTITIONS)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 9]


def silver_events(spark):
    return tables.materialise(catalog._as_bronze(spark, SMALL), "test-bronze")


def test_late_rows_arrive(spark, folder):
    path, config = f"{folder}/silver", SilverConfig(bot_limit=500)
    events = silver_events(spark)
    known = events.filter("event_date <= date'2024-01-20'")
    late = (F.col("event_date") == F.lit("2024-01-20").cast("date")) & (F.col("product_id") % 2 == 0)
    ingest.refresh_silver(known.filter(~late), path, config)
    missing = known.count() - spark.read.parquet(path).count()
    assert missing > 0
    ingest.refresh_silver(events, path, config)
    assert spark.read.parquet(path).count() == events.count()


def test_refresh_twice_and_in_steps_equals_once(spark, folder):
    config = SilverConfig(bot_limit=5)
    events = silver_events(spark)
    ingest.refresh_silver(events, f"{folder}/once", config)
    for cut in ("2024-01-10", "2024-01-20", "2024-01-20", "2024-02-01"):
        ingest.refresh_silver(events.filter(F.col("event_date") < F.lit(cut).cast("date")), f"{folder}/steps", config)
    assert snapshot(spark, f"{folder}/once") == snapshot(spark, f"{folder}/steps")


def event_rows(spark, day, session, products):
    rows = [(f"{day} 10:00:{p % 60:02d}", "view", p, None, "a.b", "x", 1.0, 1.0, 1, session) for p in products]
    schema = "event_time string, event_type string, product_id long, category_id long, category_code string, brand string, price_raw double, price double, user_id long, user_session string"
    df = spark.createDataFrame(rows, schema)
    return bronze.with_category_parts(bronze.with_time_parts(df.withColumn("event_time", df.event_time.cast("timestamp"))))


def test_a_later_batch_with_late_rows_keeps_the_day(spark, folder):
    path = f"{folder}/bronze"
    first = event_rows(spark, "2019-11-01", "s", range(50))
    second = event_rows(spark, "2019-11-02", "s", range(30)).union(event_rows(spark, "2019-11-01", "late", [99]))
    for name, batch in (("a", first), ("b", second), ("b", second)):
        bronze.write_bronze(bronze.with_ingestion_columns(batch, "2019-11-03", name), path)
    counts = {str(r.event_date): r["count"] for r in spark.read.parquet(path).groupBy("event_date").count().collect()}
    assert counts == {"2019-11-01": 51, "2019-11-02": 30}


def test_silver_in_steps_equals_a_rebuild(spark, folder):
    """A session that grows past the limit, one across a day border, rows long late, a day that empties."""
    config, path = SilverConfig(bot_limit=5), f"{folder}/silver"
    steps = [event_rows(spark, "2019-11-05", "grows", range(5))]
    steps.append(steps[-1].union(event_rows(spark, "2019-11-09", "border", range(4))).union(event_rows(spark, "2019-11-10", "fine", range(3))))
    steps.append(steps[-1].union(event_rows(spark, "2019-11-05", "grows", range(5, 8))).union(event_rows(spark, "2019-11-10", "border", range(4))))
    steps.append(steps[-1].union(event_rows(spark, "2019-11-01", "old", range(2))).union(event_rows(spark, "2019-11-10", "fine", range(3))))
    for i, events in enumerate(steps):
        ingest.refresh_silver(events, path, config)
        ingest.refresh_silver(events, f"{folder}/once{i}", config)
        assert snapshot(spark, path) == snapshot(spark, f"{folder}/once{i}")
    assert {r.user_session for r in spark.read.parquet(path).collect()} == {"fine", "old"}


def test_gold_and_panels_are_written(spark, folder):
    events = catalog._events(spark, SMALL)
    ingest.build_gold(events, f"{folder}/gold", churn_config=catalog.EVENTS_CHURN)
    dashboard.write_panels(events, f"{folder}/panels")
    assert spark.read.parquet(f"{folder}/gold/customer_rfm").count() == 15
    assert {"churned", "segment"} <= set(spark.read.parquet(f"{folder}/gold/churn_features").columns)
    assert spark.read.parquet(f"{folder}/panels/weekday_hour_heatmap").count() == 336


def test_hash_sample_ignores_layout(spark):
    ids = spark.range(2000)
    one = raw.hash_sample(ids, F.col("id"), 10)
    other = raw.hash_sample(ids.repartition(13), F.col("id"), 10)
    assert sorted(one.collect()) == sorted(other.collect()) and 120 < one.count() < 280


def test_periods_are_tagged(spark):
    out = raw.union_periods({"october": spark.range(2), "november": spark.range(3)})
    assert {r.month: r["count"] for r in out.groupBy("month").count().collect()} == {"october": 2, "november": 3}


def test_scratch_copies_can_be_released(spark):
    copy = tables.materialise(spark.range(3), "released")
    path = copy.inputFiles()[0].rsplit("/", 1)[0]
    assert tables.path_exists(spark, path)
    kept = tables._written.pop(spark.sparkContext.applicationId)
    tables._written[spark.sparkContext.applicationId] = [kept.pop()]
    tables.release(spark)
    tables._written[spark.sparkContext.applicationId] = kept
    assert not tables.path_exists(spark, path)
