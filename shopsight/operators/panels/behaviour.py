"""Behaviour panels: time of day, weekday, session depth, conversion per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsight.config import WEEKDAYS
from shopsight.functions.events import with_time_parts
from shopsight.functions.numbers import from_cents, panel_number
from shopsight.operators.panels.common import ALL, bought, count_of, sliced, slices_of, viewed


def _hours() -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(23)))


def _dense_hours(facts: DataFrame) -> DataFrame:
    return slices_of(facts).withColumn("event_hour", _hours())


def _dense_days(facts: DataFrame) -> DataFrame:
    return slices_of(facts).select("slice", F.posexplode(F.array(*[F.lit(d) for d in WEEKDAYS])).alias("day_index", "event_weekday"))


def weekday_hour_heatmap(facts: DataFrame) -> DataFrame:
    """Purchases per weekday and hour, all 168 cells of every slice."""
    counts = sliced(facts.filter(bought()), ["event_weekday", "event_hour"], {"purchases": F.sum("n")})
    grid = _dense_days(facts).withColumn("event_hour", _hours())
    return grid.join(counts, ["slice", "event_weekday", "event_hour"], "left").fillna(0, ["purchases"])


def hourly_purchases(facts: DataFrame) -> DataFrame:
    counts = sliced(facts.filter(bought()), ["event_hour"], {"purchases": F.sum("n")})
    return _dense_hours(facts).join(counts, ["slice", "event_hour"], "left").fillna(0, ["purchases"])


def weekday_purchases(facts: DataFrame) -> DataFrame:
    counts = sliced(facts.filter(bought()), ["event_weekday"], {"purchases": F.sum("n")})
    return _dense_days(facts).join(counts, ["slice", "event_weekday"], "left").fillna(0, ["purchases"])


def cumulative_revenue(facts: DataFrame) -> DataFrame:
    """Running revenue over the 24 hours of the day, per slice."""
    counts = sliced(facts.filter(bought()), ["event_hour"], {"cents": F.sum("cents")})
    dense = _dense_hours(facts).join(counts, ["slice", "event_hour"], "left").fillna(0, ["cents"])
    so_far = Window.partitionBy("slice").orderBy("event_hour").rowsBetween(Window.unboundedPreceding, 0)
    running = from_cents(F.sum("cents").over(so_far))
    return dense.select("slice", "event_hour", panel_number(running).alias("cumulative_revenue"))


def session_depth(events: DataFrame, cap: int = 20) -> DataFrame:
    """Number of sessions by events per session, depths above the cap counted at the cap."""
    timed = with_time_parts(events).filter(F.col("user_session").isNotNull())
    monthly = timed.groupBy("event_month", "user_session").agg(F.count("*").alias("n"))
    whole = monthly.groupBy("user_session").agg(F.sum("n").alias("n")).select(F.lit(ALL).alias("slice"), "n")
    sizes = monthly.select(F.col("event_month").alias("slice"), "n").unionByName(whole)
    depth = F.least("n", F.lit(cap)).alias("depth")
    return sizes.groupBy("slice", depth).agg(F.count("*").alias("sessions"))


def daily_view_purchase_ratio(facts: DataFrame) -> DataFrame:
    """Purchases per 100 views and day; 0 on days without views."""
    daily = sliced(facts, ["event_date"], {"views": count_of(viewed()), "purchases": count_of(bought())})
    active = daily.filter((F.col("views") > 0) | (F.col("purchases") > 0))
    rate = F.try_divide(F.lit(100.0) * F.col("purchases"), F.col("views"))
    return active.select("slice", "event_date", "views", "purchases", panel_number(rate).alias("ratio"))
