"""Streaming twins of bronze, daily activity and session features.

Queries run on any streaming source with the shop event columns; state is bounded by the
watermark. Checkpoints and sinks live in the cluster's shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopsight.config import DEDUP_KEYS
from shopsight.functions.events import is_type
from shopsight.functions.numbers import cents
from shopsight.operators.bronze import clean_events
from shopsight.sources.tables import materialise


def event_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """Rows of files as they arrive."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def stream_bronze(raw: DataFrame, delay: str = "1 day") -> DataFrame:
    """Clean events and drop repeats that arrive within the delay of the first copy."""
    return clean_events(raw).withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(DEDUP_KEYS))


def stream_daily(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """Counts per type and purchase revenue per day, emitted once a day is closed."""
    bought = is_type("purchase")
    return (
        events.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", "1 day"))
        .agg(
            F.count_if(is_type("view")).alias("views"),
            F.count_if(is_type("cart")).alias("carts"),
            F.count_if(bought).alias("purchases"),
            F.coalesce(F.sum(F.when(bought, cents(F.col("price")))), F.lit(0)).alias("revenue_cents"),
        )
        .select(F.to_date("window.start").alias("event_date"), "views", "carts", "purchases", "revenue_cents")
    )


def open_days(events: DataFrame, closed: DataFrame) -> DataFrame:
    """The days after the last one in `closed`, from the stored events: a batch pass over the end of the table.

    With `closed` empty, all days. Rows that came too late for a closed day are in neither.
    """
    last = closed.agg(F.max("event_date").alias("day")).first()["day"]  # a literal, so that it reaches the scan
    rest = events if last is None else events.filter(F.col("event_time") >= F.date_add(F.lit(last), 1).cast("timestamp"))
    return stream_daily(rest)


def stream_sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "1 day") -> DataFrame:
    """Sessions of a user, closed after a gap without events.

    Merging sessions inside each task before the shuffle keeps a very active user small.
    """
    events.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    bought = is_type("purchase")
    return (
        events.withWatermark("event_time", delay)
        .groupBy("user_id", F.session_window("event_time", gap))
        .agg(
            F.count("*").alias("session_events"),
            F.count_if(bought).alias("session_purchases"),
            F.coalesce(F.sum(F.when(bought, cents(F.col("price")))), F.lit(0)).alias("revenue_cents"),
            F.min("event_time").alias("_start"),
            F.max("event_time").alias("_end"),
        )
        .select(
            "user_id",
            F.unix_micros("_start").alias("session_start_us"),
            F.unix_micros("_end").alias("session_end_us"),
            "session_events",
            "session_purchases",
            "revenue_cents",
        )
    )


def open_sessions(events: DataFrame, closed: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions that are not in `closed` yet: a batch pass over what each user did after the last closed one.

    The last ends are written first: Spark then knows their size, and splits a hot user of the events.
    """
    ends = closed.groupBy(F.col("user_id").alias("_user")).agg(F.max("session_end_us").alias("_closed_us"))
    joined = events.join(materialise(ends, "session-ends"), F.col("user_id").eqNullSafe(F.col("_user")), "left")
    rest = joined.filter(F.col("_closed_us").isNull() | (F.unix_micros("event_time") > F.col("_closed_us")))
    return stream_sessions(rest.drop("_user", "_closed_us"), gap)


def run_to_table(stream: DataFrame, path: str, checkpoint: str, partitions: tuple[str, ...] = ()) -> StreamingQuery:
    """Process what has arrived, append to a Parquet table exactly once, and stop."""
    writer = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if partitions:
        writer = writer.partitionBy(*partitions)
    query = writer.start()
    query.awaitTermination()
    return query

