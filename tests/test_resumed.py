"""Streams that stop and resume; look-ups; tables in one order; one-pass ingestion."""

import random
import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from test_tables import landing

from shopsight.operators import bronze, quality
from shopsight.plans import ingest
from shopsight.sources import lookup, ordered, raw, versions
from shopsight.streaming import jobs, resumable

EVENTS = "event_time timestamp, event_type string, price double, user_id long"


def rows_at(spark, rows):
    text = [(t, kind, price, user) for t, kind, price, user in rows]
    df = spark.createDataFrame(text, EVENTS.replace("event_time timestamp", "event_time string"))
    return df.withColumn("event_time", df.event_time.cast("timestamp"))


def some_rows(n, seed):
    rng = random.Random(seed)
    kinds = ["view", "cart", "purchase"]
    return [(f"2024-01-{rng.randrange(1, 6):02d} {rng.randrange(10, 14)}:{rng.choice(['00', '30', '07', '59'])}:00", rng.choice(kinds), rng.choice([1.25, 3.0]), rng.choice([1, 2, None])) for _ in range(n)]


def run(spark, folder, name, reduce, delay="10 days"):
    stream = jobs.event_stream(spark, f"{folder}/in", EVENTS)
    return resumable.resume(stream, reduce, f"{folder}/{name}", f"{folder}/{name}-checkpoint", delay)


def as_set(df, columns):
    return sorted(map(str, df.select(*columns).collect()))


def test_three_runs_equal_one_pass(spark, folder):
    days, sessions = ["event_date", *resumable.DAY_MEASURES], ["user_id", "session_start_us", "session_end_us", *resumable.SESSION_MEASURES]
    rows = []
    for k in range(3):
        rows += (more := some_rows(60, k))
        rows_at(spark, more).repartition(2).write.mode("append").parquet(f"{folder}/in")
        run(spark, folder, "days", resumable.day_parts)
        run(spark, folder, "sessions", resumable.session_parts())
        if k == 1:
            resumable.compact(spark, f"{folder}/days", resumable.daily)
            resumable.compact(spark, f"{folder}/sessions", resumable.sessions)
        every = rows_at(spark, rows)
        assert as_set(resumable.daily(spark, f"{folder}/days"), days) == as_set(jobs.stream_daily(every), days)
        assert as_set(resumable.sessions(spark, f"{folder}/sessions"), sessions) == as_set(jobs.stream_sessions(every), sessions)
    before = as_set(resumable.daily(spark, f"{folder}/days"), days)
    run(spark, folder, "days", resumable.day_parts)  # nothing new
    assert as_set(resumable.daily(spark, f"{folder}/days"), days) == before


def test_a_batch_that_runs_again_counts_once(spark, folder):
    body = resumable.upsert(resumable.day_parts, f"{folder}/days", "1 day")
    first, second = rows_at(spark, some_rows(40, 1)), rows_at(spark, some_rows(40, 2))
    for batch, rows in ((0, first), (1, second), (1, second), (0, first)):
        body(rows, batch)
    total = resumable.daily(spark, f"{folder}/days").agg(F.sum(F.col("views") + F.col("carts") + F.col("purchases"))).first()[0]
    assert total + resumable.late_rows(spark, f"{folder}/days", EVENTS).count() == 80


def test_late_rows_go_aside(spark, folder):
    body = resumable.upsert(resumable.day_parts, f"{folder}/days", "1 day")
    body(rows_at(spark, [("2024-01-05 12:00:00", "view", 1.0, 1), ("2024-01-01 00:00:00", "view", 1.0, 1)]), 0)
    body(rows_at(spark, [("2024-01-04 12:00:00", "view", 1.0, 1), ("2024-01-04 11:59:59", "cart", 1.0, 2)]), 1)
    late = resumable.late_rows(spark, f"{folder}/days", EVENTS).collect()
    assert [(r.event_type, r.batch) for r in late] == [("cart", 1)]
    assert resumable.daily(spark, f"{folder}/days").agg(F.sum("views"), F.sum("carts")).first()[0:2] == (3, 0)


def test_an_empty_batch(spark, folder):
    body = resumable.upsert(resumable.session_parts(), f"{folder}/sessions", "1 day")
    for batch in (0, 1):
        body(rows_at(spark, []), batch)
    assert resumable.sessions(spark, f"{folder}/sessions").count() == 0


def test_point_lookup_reads_one_bucket(spark, folder):
    scores = spark.range(5000).select(F.col("id").alias("user_id"), (F.col("id") % 7).alias("score"))
    lookup.publish_lookup(scores.unionAll(scores.where("user_id = 17")), f"{folder}/scores", "user_id", buckets=16)
    found = lookup.lookup(spark, f"{folder}/scores", 17)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket#\d+ = \d+", plan) and "EqualTo(user_id,17)" in plan
    assert len({f.rsplit("/", 2)[1] for f in spark.read.parquet(versions.current(spark, f"{folder}/scores")).inputFiles()}) == 16
    assert found.selectExpr("score", "_metadata.file_path AS f").select("f").distinct().count() == 1
    assert [tuple(r) for r in found.collect()] == [(17, 3)] * 2
    assert lookup.lookup(spark, f"{folder}/scores", 99999).count() == 0
    with pytest.raises(FileNotFoundError):
        lookup.lookup(spark, f"{folder}/none", 1)


def test_files_follow_each_other(spark, folder):
    rows = spark.range(3000).select("id", (F.col("id") * 7919 % 100).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered.write_ordered(rows, f"{folder}/ordered", F.col("v").desc(), F.col("id").asc())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = ordered.read_ordered(spark, f"{folder}/ordered").orderBy("position").collect()
    assert [r.position for r in got] == list(range(1, 3001))
    assert [(r.v, r.id) for r in got] == sorted(((r.v, r.id) for r in got), key=lambda x: (-x[0], x[1]))
    assert len({r.file_number for r in got}) > 1


def test_ingestion_parses_text_once(spark, folder, monkeypatch):
    plans, clean = [], bronze.clean_events

    def recorded(events, month=None):
        plans.append(events._jdf.queryExecution().executedPlan().toString())
        return clean(events, month)

    monkeypatch.setattr(bronze, "clean_events", recorded)
    source = landing(spark, folder)
    report = ingest.ingest(spark, source, f"{folder}/bronze", "2024-01-31")
    assert len(plans) == 1 and "csv" not in plans[0].lower() and "parquet" in plans[0].lower()
    assert report.metrics.collect() == quality.dq_metrics(raw.read_checked_csv(spark, source)).collect()
    assert report.written_rows == spark.read.parquet(f"{folder}/bronze").count()


def test_gold_is_stamped(spark):
    from shopsight.plans import job_catalog

    rows = {r.table: (r.rows, r.stamped) for r in job_catalog.gold_tables(spark, SMALL).collect()}
    assert set(rows) == set(ingest.GOLD) and all(a == b > 0 for a, b in rows.values())
