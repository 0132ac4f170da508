"""Streams over files that arrive in several batches."""

import time

from conftest import SMALL
from pyspark.sql import functions as F

from shopsight.operators import bronze
from shopsight.sources import shop
from shopsight.streaming import jobs


def arriving(spark, folder, repeat=False):
    """The events as six files in time order, optionally with every third file sent twice."""
    source = f"{folder}/incoming"
    events = spark.read.schema(shop.TABLE_SCHEMAS["events"]).parquet(f"{SMALL}/events.parquet")
    for i in range(6):
        part = events.filter((F.col("event_id") >= i * 170) & (F.col("event_id") < (i + 1) * 170)).coalesce(1)
        part.write.mode("append").parquet(source)
        time.sleep(1.1)  # file age orders the batches, in seconds
        if repeat and i % 3 == 0:
            part.write.mode("append").parquet(source)
            time.sleep(1.1)
    return shop.from_event_rows(jobs.event_stream(spark, source, shop.TABLE_SCHEMAS["events"], files_per_trigger=1))


def test_repeats_in_later_batches_are_dropped(spark, folder):
    stream = jobs.stream_bronze(shop.with_products(arriving(spark, folder, repeat=True), spark, SMALL))
    jobs.run_to_table(stream, f"{folder}/out", f"{folder}/state", bronze.PARTITIONS)
    got = spark.read.parquet(f"{folder}/out")
    want = shop.shop_events(spark, SMALL)
    keys = ["user_id", "event_time", "event_type", "product_id", "category_code", "brand"]
    assert sorted(map(str, got.select(keys).collect())) == sorted(map(str, want.select(keys).collect()))


def test_a_second_run_adds_nothing(spark, folder):
    source = arriving(spark, folder)
    for _ in range(2):
        jobs.run_to_table(jobs.stream_daily(source), f"{folder}/out", f"{folder}/state")
    out = spark.read.parquet(f"{folder}/out")
    assert out.count() == out.select("event_date").distinct().count() == 28


def test_closed_days_equal_the_batch(spark, folder):
    jobs.run_to_table(jobs.stream_daily(arriving(spark, folder)), f"{folder}/out", f"{folder}/state")
    got = {r.event_date: (r.views, r.carts, r.purchases) for r in spark.read.parquet(f"{folder}/out").collect()}
    events = shop.all_shop_events(spark, SMALL).withColumn("event_date", F.to_date("event_time"))
    daily = events.groupBy("event_date").pivot("event_type", ["view", "cart", "purchase"]).count().fillna(0)
    want = {r.event_date: (r["view"], r["cart"], r["purchase"]) for r in daily.collect()}
    assert got and all(want[d] == v for d, v in got.items())


def test_closed_and_open_sessions_are_all_sessions(spark, folder):
    jobs.run_to_table(jobs.stream_sessions(arriving(spark, folder)), f"{folder}/out", f"{folder}/state")
    closed = spark.read.parquet(f"{folder}/out")
    events = shop.all_shop_events(spark, SMALL)
    still_open = jobs.open_sessions(events, closed)
    assert closed.count() and still_open.count()
    assert sorted(closed.unionByName(still_open).collect()) == sorted(jobs.stream_sessions(events).collect())


def test_with_nothing_closed_everything_is_open(spark):
    events = shop.all_shop_events(spark, SMALL)
    days, sessions = jobs.stream_daily(events), jobs.stream_sessions(events)
    assert sorted(jobs.open_days(events, days.limit(0)).collect()) == sorted(days.collect())
    assert sorted(jobs.open_sessions(events, sessions.limit(0)).collect()) == sorted(sessions.collect())
