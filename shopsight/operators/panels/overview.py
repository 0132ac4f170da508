"""Overview panels: KPIs, daily activity, funnel, revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.functions.events import UNKNOWN, with_time_parts
from shopsight.functions.numbers import from_cents, panel_number, percent_of_at_least_one
from shopsight.operators.panels.common import ALL, bought, carted, cents_of, count_of, sliced, viewed
from shopsight.operators.ranking import top_per_group


def _type_counts(facts: DataFrame, keys: list[str]) -> DataFrame:
    return sliced(
        facts,
        keys,
        {"views": count_of(viewed()), "carts": count_of(carted()), "purchases": count_of(bought()), "cents": cents_of(bought())},
    )


def customers(events: DataFrame) -> DataFrame:
    """Distinct users per slice. Users are made distinct per month before they are counted."""
    monthly = with_time_parts(events).select("event_month", "user_id").distinct()
    by_month = monthly.groupBy(F.col("event_month").alias("slice")).agg(F.count("user_id").alias("total_customers"))
    overall = monthly.select("user_id").distinct().agg(F.count("user_id").alias("total_customers"))
    return by_month.unionByName(overall.select(F.lit(ALL).alias("slice"), "total_customers"))


def overview_kpis(facts: DataFrame, events: DataFrame) -> DataFrame:
    counts = _type_counts(facts, [])
    return counts.join(customers(events), "slice").select(
        "slice",
        panel_number(from_cents(F.col("cents"))).alias("total_revenue"),
        F.col("purchases").alias("total_orders"),
        "total_customers",
        panel_number(F.try_divide(from_cents(F.col("cents")), F.col("purchases"))).alias("avg_order_value"),
        panel_number(percent_of_at_least_one(F.col("purchases"), F.col("views"))).alias("conversion_rate"),
        panel_number(percent_of_at_least_one(F.col("carts"), F.col("views"))).alias("cart_rate"),
    )


def daily_events(facts: DataFrame) -> DataFrame:
    """Date x event type as columns; types that did not occur are 0."""
    return _type_counts(facts, ["event_date"]).select("slice", "event_date", "views", "carts", "purchases")


def funnel(facts: DataFrame) -> DataFrame:
    counts = _type_counts(facts, [])
    stages = [
        (1, "Views", F.col("views"), F.lit(100.0)),
        (2, "Cart Adds", F.col("carts"), percent_of_at_least_one(F.col("carts"), F.col("views"))),
        (3, "Purchases", F.col("purchases"), percent_of_at_least_one(F.col("purchases"), F.col("views"))),
    ]
    rows = [
        F.struct(
            F.lit(i).alias("position"), F.lit(name).alias("stage"), n.alias("events"), panel_number(pct).alias("percentage")
        )
        for i, name, n, pct in stages
    ]
    return counts.select("slice", F.inline(F.array(*rows)))


def event_split(facts: DataFrame) -> DataFrame:
    return sliced(facts, ["event_type"], {"events": F.sum("n")})


def category_revenue(facts: DataFrame) -> DataFrame:
    """Revenue per category."""
    totals = sliced(facts.filter(bought()), ["category"], {"cents": F.sum("cents")})
    return totals.select("slice", "category", panel_number(from_cents(F.col("cents"))).alias("revenue"))


def category_revenue_top(facts: DataFrame, n: int = 10) -> DataFrame:
    order = [F.col("revenue").desc(), F.col("category")]
    return top_per_group(category_revenue(facts), ["slice"], order, n)


def daily_revenue(facts: DataFrame) -> DataFrame:
    totals = sliced(facts.filter(bought()), ["event_date"], {"cents": F.sum("cents")})
    return totals.select("slice", "event_date", panel_number(from_cents(F.col("cents"))).alias("revenue"))


def category_list(facts: DataFrame) -> DataFrame:
    """Categories bought, without the placeholder."""
    return facts.filter(bought() & (F.col("category") != UNKNOWN)).select("category").distinct()


def run_metadata(events: DataFrame) -> DataFrame:
    """Number of events and users, first and last day present in the data."""
    per_user = events.groupBy("user_id").agg(
        F.count("*").alias("n"), F.min("event_time").alias("first"), F.max("event_time").alias("last")
    )
    return per_user.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_events"),
        F.count("user_id").alias("total_users"),
        F.to_date(F.min("first")).alias("first_date"),
        F.to_date(F.max("last")).alias("last_date"),
    )
