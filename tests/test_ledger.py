"""Silver kept up to date by its ledger: equal to a rebuild, reading only what is concerned. Versions of tables."""

import re

import pytest
from pyspark.sql import functions as F
from test_tables import event_rows, snapshot

from shopsight.config import SilverConfig
from shopsight.operators import bronze
from shopsight.operators.silver import build_silver
from shopsight.plans import ledger
from shopsight.sources import tables, versions

CONFIG = SilverConfig(bot_limit=5)


def land(folder, name, rows):
    bronze.write_bronze(bronze.with_ingestion_columns(rows, "2019-11-20", name), f"{folder}/bronze")


def rebuilt(spark, folder):
    events = bronze.dedup_events(spark.read.parquet(f"{folder}/bronze"))
    path = f"{folder}/rebuilt"
    tables.write_table(build_silver(events, CONFIG), path)
    return snapshot(spark, path)


def refresh(spark, folder, config=CONFIG):
    return ledger.refresh_silver(spark, f"{folder}/bronze", f"{folder}/silver", config)


def test_silver_by_ledger_equals_a_rebuild(spark, folder):
    """A session that grows past the limit, one across a day border, one that shrinks again, late rows, copies, days that empty."""
    steps = [
        ("a", event_rows(spark, "2019-11-05", "grows", range(5)).union(event_rows(spark, "2019-11-06", "calm", range(2)))),
        ("b", event_rows(spark, "2019-11-09", "border", range(4)).union(event_rows(spark, "2019-11-10", "fine", range(3)))),
        ("c", event_rows(spark, "2019-11-05", "grows", range(3, 8)).union(event_rows(spark, "2019-11-10", "border", range(4)))),
        ("d", event_rows(spark, "2019-11-01", "old", range(2)).union(event_rows(spark, "2019-11-10", "fine", range(3)))),
        ("c", event_rows(spark, "2019-11-05", "grows", range(3, 4)).union(event_rows(spark, "2019-11-10", "border", range(1)))),
        ("e", event_rows(spark, "2019-11-06", None, range(9))),
    ]
    days = []
    for name, rows in steps:
        land(folder, name, rows)
        days.append(refresh(spark, folder))
        assert snapshot(spark, f"{folder}/silver") == rebuilt(spark, folder)
    assert days == [
        ["2019-11-05", "2019-11-06"], ["2019-11-09", "2019-11-10"], ["2019-11-05", "2019-11-09", "2019-11-10"], ["2019-11-01"],
        ["2019-11-05", "2019-11-09", "2019-11-10"], ["2019-11-06"],
    ]
    assert refresh(spark, folder) == []
    tables.drop_partition(spark, f"{folder}/bronze", event_month="2019-11", event_date="2019-11-01")
    assert refresh(spark, folder) == ["2019-11-01"]
    assert snapshot(spark, f"{folder}/silver") == rebuilt(spark, folder)


def test_a_batch_of_known_events_writes_nothing(spark, folder):
    rows = event_rows(spark, "2019-11-05", "s", range(3))
    for name, days in (("a", ["2019-11-05"]), ("b", []), ("a", []), ("b", [])):
        land(folder, name, rows)
        assert refresh(spark, folder) == days


def test_another_limit_rebuilds(spark, folder):
    land(folder, "a", event_rows(spark, "2019-11-05", "s", range(6)).union(event_rows(spark, "2019-11-06", "t", range(2))))
    refresh(spark, folder)
    assert {r.user_session for r in spark.read.parquet(f"{folder}/silver").collect()} == {"t"}
    assert refresh(spark, folder, SilverConfig(bot_limit=6)) == ["2019-11-05", "2019-11-06"]
    assert {r.user_session for r in spark.read.parquet(f"{folder}/silver").collect()} == {"s", "t"}


def test_a_refresh_that_dies_is_done_again(spark, folder, monkeypatch):
    land(folder, "a", event_rows(spark, "2019-11-05", "s", range(3)))
    refresh(spark, folder)
    land(folder, "b", event_rows(spark, "2019-11-05", "s", range(3, 7)).union(event_rows(spark, "2019-11-07", "t", range(2))))

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", dies)
        with pytest.raises(RuntimeError):
            refresh(spark, folder)
    assert refresh(spark, folder) == ["2019-11-05", "2019-11-07"]
    assert snapshot(spark, f"{folder}/silver") == rebuilt(spark, folder)


def test_bronze_is_read_by_days(spark, folder, monkeypatch):
    """Every scan of bronze has a filter on its partitions, and the days of a session that turned are the only others read."""
    rows = event_rows(spark, "2019-11-01", "long", range(4))
    for day in range(2, 9):
        rows = rows.union(event_rows(spark, f"2019-11-0{day}", f"s{day}", range(3)))
    land(folder, "a", rows)
    refresh(spark, folder)
    plans, dedup = [], bronze.dedup_events

    def recorded(events):
        plans.append(events._jdf.queryExecution().executedPlan().toString())
        return dedup(events)

    monkeypatch.setattr(bronze, "dedup_events", recorded)
    land(folder, "b", event_rows(spark, "2019-11-09", "long", range(4)))
    assert refresh(spark, folder) == ["2019-11-01", "2019-11-09"]
    filters = [re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", p).group(1) for p in plans]
    assert [re.findall(r"\d{4}-\d\d-\d\d", f) or re.findall(r"\d{5}", f) for f in filters] in ([["2019-11-09"], ["2019-11-01"]], [["18209"], ["18201"]])


def test_day_filter_passes_the_dedup(spark, folder):
    land(folder, "a", event_rows(spark, "2019-11-01", "s", range(4)))
    day = F.col("event_date") == F.lit("2019-11-01").cast("date")
    plan = bronze.dedup_events(spark.read.parquet(f"{folder}/bronze")).where(day)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*event_date", plan)


def test_a_failed_publish_leaves_the_old_version(spark, folder):
    path = f"{folder}/scores"
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path)
    versions.publish(spark.range(3), path)
    broken = spark.range(100, numPartitions=4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("half-way"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="half-way"):
        versions.publish(broken, path)
    assert versions.read(spark, path).count() == 3
    reader = versions.read(spark, path)
    versions.publish(spark.range(5), path)
    assert versions.read(spark, path).count() == 5 and reader.count() == 3
    versions.publish(spark.range(6), path)
    versions.publish(spark.range(7), path)
    fs, root = tables._file_system(spark, path)
    kept = [s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().startswith("v-")]
    assert len(kept) == 3 and versions.read(spark, path).count() == 7  # two versions and what the failed run left


def test_jobs_leave_no_scratch_copies(spark, folder):
    from shopsight.plans import ingest
    from test_tables import landing

    def kept():
        return [p for p in tables._written.get(spark.sparkContext.applicationId, []) if tables.path_exists(spark, p)]

    source = landing(spark, folder)
    before = kept()
    report = ingest.ingest(spark, source, f"{folder}/bronze", "2024-01-31")
    ledger.refresh_silver(spark, f"{folder}/bronze", f"{folder}/silver", CONFIG)
    assert kept() == before
    assert report.metrics.first().total_rows == 1020 and spark.read.parquet(f"{folder}/silver").count() > 0
