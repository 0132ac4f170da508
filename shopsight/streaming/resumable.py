"""Daily activity and sessions from streams that stop and resume, open days and open sessions included.

Every micro-batch is reduced to what it adds (counts per day, fragments of sessions) and written to a partition of its own,
`batch=<id>`. A batch that runs again after a failure replaces its partition, so nothing counts twice; a later run
over the same checkpoint goes on with the next number. Readers add up the batches: counts by sums, sessions by joining
fragments that are no further apart than the gap, which gives what one pass over all events gives.

A row is late if it is older than the latest event of all earlier batches, less the delay. Late rows go to a side table, whole,
and are in no sum; the bound of a batch follows from earlier batches alone, so running it again routes the same rows.

`compact` folds finished batches into one partition, so that readers don't meet ever more of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from shopsight.sources import tables, versions
from shopsight.streaming.jobs import stream_daily, stream_sessions

DAY_MEASURES = ("views", "carts", "purchases", "revenue_cents")
SESSION_MEASURES = ("session_events", "session_purchases", "revenue_cents")
_PARTS, _LATE, _SEEN, _FOLDED = "parts", "late", "seen", "folded"


def _latest_before(spark: SparkSession, path: str, batch: int) -> int | None:
    """Microseconds of the latest event in the batches before this one."""
    if not tables.path_exists(spark, f"{path}/{_SEEN}"):
        return None
    seen = spark.read.schema("latest_us long, batch long").parquet(f"{path}/{_SEEN}")
    return seen.where(F.col("batch") < batch).agg(F.max("latest_us")).first()[0]


def _replace(df: DataFrame, path: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def upsert(reduce: Callable[[DataFrame], DataFrame], path: str, delay: str) -> Callable[[DataFrame, int], None]:
    """Body of foreachBatch: late rows aside, the rest reduced, both in partitions of this batch."""

    def run(events: DataFrame, batch: int) -> None:
        spark = events.sparkSession
        latest = _latest_before(spark, path, batch)
        events = events.persist()
        try:
            on_time = events
            if latest is not None:
                bound = F.timestamp_micros(F.lit(latest)) - F.expr(f"INTERVAL {delay}")
                late = F.coalesce(F.col("event_time") < bound, F.lit(False))
                _replace(events.where(late), f"{path}/{_LATE}", batch)
                on_time = events.where(~late)
            _replace(reduce(on_time), f"{path}/{_PARTS}", batch)
            # last, as it moves the bound of all that follows
            _replace(events.agg(F.unix_micros(F.max("event_time")).alias("latest_us")), f"{path}/{_SEEN}", batch)
        finally:
            events.unpersist()

    return run


def resume(stream: DataFrame, reduce: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, delay: str = "1 day") -> StreamingQuery:
    """Process what has arrived since the last run over this checkpoint, and stop."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = writer.foreachBatch(upsert(reduce, path, delay)).start()
    query.awaitTermination()
    return query


def day_parts(events: DataFrame) -> DataFrame:
    return stream_daily(events)


def session_parts(gap: str = "30 minutes") -> Callable[[DataFrame], DataFrame]:
    return lambda events: stream_sessions(events, gap)


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the batches that have a partition: at most those since the last `compact`."""
    fs, folder = tables._file_system(spark, root)
    return sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(folder) if s.getPath().getName().startswith("batch="))


def _folded(spark: SparkSession, path: str) -> tuple[str | None, int]:
    """Folder of the folded batches and the last of them."""
    folder = versions.current(spark, f"{path}/{_FOLDED}")
    return (folder, int(versions.read_text(spark, f"{folder}/_upto"))) if folder else (None, -1)


def _parts(spark: SparkSession, path: str) -> DataFrame:
    folder, upto = _folded(spark, path)
    root = f"{path}/{_PARTS}"
    later = [f"{root}/batch={n}" for n in _numbers(spark, root) if n > upto]
    return spark.read.parquet(*([folder] if folder else []), *later)


def daily(spark: SparkSession, path: str) -> DataFrame:
    """All days so far, the open ones too."""
    return _parts(spark, path).groupBy("event_date").agg(*[F.sum(c).alias(c) for c in DAY_MEASURES])


def sessions(spark: SparkSession, path: str, gap: str = "30 minutes") -> DataFrame:
    """All sessions so far, the open ones too."""
    return merged_sessions(_parts(spark, path), gap)


def merged_sessions(parts: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Fragments of a user's sessions joined where they lie no further apart than the gap, as a session window joins events."""
    order = Window.partitionBy("user_id").orderBy("session_start_us", "session_end_us")
    reached = F.max("session_end_us").over(order.rowsBetween(Window.unboundedPreceding, -1))
    width = F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {gap}"))
    begins = F.coalesce(F.col("session_start_us") > reached + width, F.lit(True)).cast("long")
    numbered = parts.withColumn("_begins", begins).withColumn("_session", F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("user_id", "_session").agg(
        F.min("session_start_us").alias("session_start_us"), F.max("session_end_us").alias("session_end_us"),
        *[F.sum(c).alias(c) for c in SESSION_MEASURES],
    ).drop("_session")


def late_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows that came too late, with the batch they came in."""
    if not tables.path_exists(spark, f"{path}/{_LATE}"):
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(None).cast("long"))
    return spark.read.schema(schema).parquet(f"{path}/{_LATE}").withColumn("batch", F.regexp_extract("_metadata.file_path", r"/batch=(\d+)/", 1).cast("long"))


def compact(spark: SparkSession, path: str, merge: Callable[[SparkSession, str], DataFrame]) -> None:
    """Fold all batches so far into one table, a new version of it; call it between runs, with `daily` or `sessions`.

    Folded batches are removed after the switch, and ignored if that fails.
    """
    root, folder = f"{path}/{_PARTS}", versions.new_version(f"{path}/{_FOLDED}")
    numbers = _numbers(spark, root)
    merge(spark, path).write.parquet(folder)
    versions.write_text(spark, f"{folder}/_upto", str(max([_folded(spark, path)[1], *numbers])))
    versions.commit(spark, f"{path}/{_FOLDED}", folder)
    for n in numbers:
        fs, old = tables._file_system(spark, f"{root}/batch={n}")
        fs.delete(old, True)
