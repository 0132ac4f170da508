"""Shared pieces of the panels.

Panels read *facts*: events with their dimensions and the additive measures `n` and `cents`
(functions.events.as_facts), or the cube built from them, which has the same columns.
Each result is given for every month and for `all`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.functions.events import is_type

DIMENSIONS = (
    "event_month",
    "event_date",
    "event_hour",
    "event_weekday",
    "category",
    "brand",
    "product_id",
    "event_type",
)
ALL = "all"


def bought() -> Column:
    return is_type("purchase")


def viewed() -> Column:
    return is_type("view")


def carted() -> Column:
    return is_type("cart")


def build_cube(facts: DataFrame) -> DataFrame:
    """Facts pre-aggregated over all panel dimensions; one scan then serves every panel."""
    return facts.groupBy(*DIMENSIONS).agg(F.sum("n").alias("n"), F.sum("cents").alias("cents"))


def count_of(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("n")).otherwise(0))


def cents_of(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("cents")).otherwise(0))


def sliced(facts: DataFrame, keys: list[str], measures: dict[str, Column]) -> DataFrame:
    """Sum measures by (slice, keys), slice being each month and `all`.

    The facts are aggregated by month once; only that small result is repeated for `all`.
    """
    monthly = facts.groupBy("event_month", *keys).agg(*[m.alias(name) for name, m in measures.items()])
    repeated = monthly.withColumn("slice", F.explode(F.array(F.lit(ALL), F.col("event_month"))))
    return repeated.groupBy("slice", *keys).agg(*[F.sum(name).alias(name) for name in measures])


def slices_of(facts: DataFrame) -> DataFrame:
    """The slice names present, one row each."""
    months = facts.select("event_month").distinct()
    return months.select(F.explode(F.array(F.lit(ALL), F.col("event_month"))).alias("slice")).distinct()
