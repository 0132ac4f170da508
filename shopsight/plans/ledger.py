"""Silver from bronze, kept up to date by a ledger: a refresh reads the days that have new files, and what depends on them.

The ledger of a silver table lies beside it, in `<path>_ledger`:

- a manifest per version: for every day its files by batch, its number of events, a sum over their contents and the run that
  counted its sessions;
- `sessions/run=...`: events per session and day, written once, sorted by day, read where the manifest names them;
- `bots` in the version's folder: the sessions over the limit, counted over all days.

Events are de-duplicated by keys that include their time, so copies never span days, and a day can be rebuilt on its own. A day
matters beyond itself only through the sizes of its sessions: one that passes the limit, or falls below it, changes the days on which it
has other events. So bronze is read for days with new, replaced or vanished files, and for the days of sessions that turned; both by
partition. Sizes come from the ledger, which has a row per session and day, not from bronze. Where a new batch only repeats
known events nothing is written.

Silver is written before the ledger is committed: a refresh that dies is done again by the next. The driver holds a line per bronze
file and a row per day.
"""

from __future__ import annotations

import datetime
import hashlib
import json
import operator
import re
import uuid
from collections import defaultdict
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.config import DEDUP_KEYS, SilverConfig
from shopsight.operators import bronze
from shopsight.operators.silver import silver_without
from shopsight.sources import tables, versions

_PLACE = re.compile(r"/event_month=([^/]*)/event_date=([^/]*)/(?:_batch=([^/]*)/)?([^/]+)$")
SESSION_SCHEMA = "event_date date, user_session string, n long, content decimal(38,0)"


def _files(spark: SparkSession, path: str) -> list[tuple[str, ...]]:
    """Month, day, batch and name of every file of a table, from its listing."""
    return [_PLACE.search(f).groups(default="") for f in spark.read.parquet(path).inputFiles()]


def _days_of(spark: SparkSession, bronze_path: str) -> dict[str, dict]:
    """Of every day its month, and a digest of the file names of every batch. A batch that is written again has other names."""
    names: dict = defaultdict(list)
    for month, day, batch, name in _files(spark, bronze_path):
        names[day, month, batch].append(name)
    days: dict[str, dict] = {}
    for (day, month, batch), files in names.items():
        digest = hashlib.md5(" ".join(sorted(files)).encode()).hexdigest()
        days.setdefault(day, {"month": month, "files": {}})["files"][batch] = digest
    return days


def _on(days: list[str]):
    return F.col("event_date").isin([datetime.date.fromisoformat(d) for d in days])


def _sessions(spark: SparkSession, ledger: str, days: dict[str, dict]) -> DataFrame:
    """Counted sessions of the given days of a manifest."""
    if not days:
        return spark.createDataFrame([], SESSION_SCHEMA)
    by_run: dict[str, list[str]] = defaultdict(list)
    for day, x in days.items():
        by_run[x["run"]].append(day)
    root = f"{ledger}/sessions"
    counted = spark.read.schema(f"{SESSION_SCHEMA}, run string").option("basePath", root).parquet(*[f"{root}/run={r}" for r in by_run])
    return counted.where(reduce(operator.or_, [(F.col("run") == r) & _on(own) for r, own in by_run.items()])).drop("run")


def _silver_files(spark: SparkSession, path: str) -> dict[str, set[str]]:
    """Names of the files of every day of silver."""
    found: dict[str, set[str]] = defaultdict(set)
    if tables.path_exists(spark, path):
        for _, day, _, name in _files(spark, path):
            found[day].add(name)
    return found


def _sizes(changed: DataFrame, others: DataFrame | None, limit: int) -> DataFrame:
    """Sessions whose size has changed, with their sizes before and now; `others` are their events on unchanged days."""
    moved = changed.groupBy("user_session").agg(F.sum("before").alias("before"), F.sum("now").alias("now")).where("before <> now")
    rest = F.lit(0)
    if others is not None:
        more = others.join(moved.select("user_session"), "user_session", "left_semi").groupBy("user_session").agg(F.sum("n").alias("rest"))
        moved, rest = moved.join(more, "user_session", "left"), F.coalesce("rest", F.lit(0))
    both = moved.select("user_session", (F.col("before") + rest).alias("before"), (F.col("now") + rest).alias("now"))
    return tables.materialise(both.withColumn("turned", (F.col("before") > limit) != (F.col("now") > limit)), "session-sizes")


def refresh_silver(spark: SparkSession, bronze_path: str, path: str, config: SilverConfig = SilverConfig()) -> list[str]:
    """Bring silver to what a rebuild from all of bronze would give; returns the days that were written or removed."""
    with tables.temporary(spark):
        return _refresh(spark, bronze_path, path, config)


def _refresh(spark: SparkSession, bronze_path: str, path: str, config: SilverConfig) -> list[str]:
    ledger = f"{path.rstrip('/')}_ledger"
    now = _days_of(spark, bronze_path)
    version = versions.current(spark, ledger)
    known = json.loads(versions.read_text(spark, f"{version}/manifest.json")) if version else None
    if known is None or known["bot_limit"] != config.bot_limit:
        known, version = {"days": {}, "bot_limit": config.bot_limit}, None
    old = known["days"]
    touched = sorted(d for d in {*now, *old} if now.get(d, {}).get("files") != old.get(d, {}).get("files"))
    if not touched:
        return []

    events = spark.read.parquet(bronze_path)
    read = events if len(touched) >= len(now) else events.where(_on(touched))
    fresh = tables.materialise(bronze.dedup_events(read), "fresh")
    run = uuid.uuid4().hex
    content = F.sum(F.xxhash64(*DEDUP_KEYS, "price_raw").cast("decimal(38,0)")).cast("decimal(38,0)")
    counts = fresh.groupBy("event_date", "user_session").agg(F.count("*").alias("n"), content.alias("content"))
    counts.sortWithinPartitions("event_date").write.parquet(f"{ledger}/sessions/run={run}")
    counted = spark.read.schema(SESSION_SCHEMA).parquet(f"{ledger}/sessions/run={run}")
    sums = counted.groupBy("event_date").agg(F.sum("n").alias("n"), F.sum("content").cast("string").alias("content"))
    found = {d: {"n": 0, "content": None, "run": run} for d in touched if d in now}
    found |= {r["event_date"].isoformat(): {"n": r["n"], "content": r["content"], "run": run} for r in sums.collect()}
    changed = sorted(d for d in touched if any(found.get(d, {}).get(k) != old.get(d, {}).get(k) for k in ("n", "content")))

    days = {d: x for d, x in old.items() if d not in touched}
    for d in touched:
        if d in now:
            days[d] = {**(found[d] if d in changed or d not in old else old[d]), "files": now[d]["files"], "month": now[d]["month"]}
    written: list[str] = []
    folder = versions.new_version(ledger)
    bots = spark.read.parquet(f"{version}/bots") if version else spark.createDataFrame([], "user_session string")
    if changed:
        unchanged = {d: x for d, x in days.items() if d not in changed}
        others = _sessions(spark, ledger, unchanged).where("user_session IS NOT NULL") if unchanged else None
        after = _sessions(spark, ledger, {d: days[d] for d in changed if d in days})
        before = _sessions(spark, ledger, {d: old[d] for d in changed if d in old})
        pairs = after.selectExpr("user_session", "0L AS before", "n AS now").unionAll(before.selectExpr("user_session", "n AS before", "0L AS now"))
        sizes = _sizes(pairs.where("user_session IS NOT NULL"), others, config.bot_limit)
        reach: list[str] = []
        if others is not None:
            turned = others.join(sizes.where("turned").select("user_session"), "user_session", "left_semi")
            reach = [r[0].isoformat() for r in turned.select("event_date").distinct().collect()]
        over = sizes.where(F.col("now") > config.bot_limit).select("user_session")
        bots.join(sizes.select("user_session"), "user_session", "left_anti").unionAll(over).write.parquet(f"{folder}/bots")
        bots = spark.read.parquet(f"{folder}/bots")

        written = sorted({*changed, *reach})
        again = [d for d in reach if d not in touched]
        part = fresh.where(_on([d for d in written if d in touched]))
        if again:
            part = part.unionByName(bronze.dedup_events(events.where(_on(again))))
        stood = _silver_files(spark, path)
        tables.write_partitioned(silver_without(part, bots), path, bronze.PARTITIONS)
        stands = _silver_files(spark, path) if stood else {}
        for d in written:
            if d in stood and stands.get(d) == stood[d]:  # no row was left to replace the day
                tables.drop_partition(spark, path, event_month=d[:7], event_date=d)
    else:
        bots.write.parquet(f"{folder}/bots")
    versions.write_text(spark, f"{folder}/manifest.json", json.dumps({"bot_limit": config.bot_limit, "days": days}))
    versions.commit(spark, ledger, folder)
    _drop_stale(spark, ledger, days, old)
    return written


def _drop_stale(spark: SparkSession, ledger: str, days: dict, old: dict) -> None:
    """Session counts of runs that neither this manifest nor the one before names."""
    named = {x["run"] for x in (*days.values(), *old.values())}
    fs, root = tables._file_system(spark, f"{ledger}/sessions")
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("run=") and name[4:] not in named:
            fs.delete(status.getPath(), True)
