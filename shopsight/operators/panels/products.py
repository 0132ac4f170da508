"""Product and category panels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.functions.numbers import from_cents, panel_number
from shopsight.operators.panels.common import bought, carted, cents_of, count_of, sliced, viewed
from shopsight.operators.ranking import top_per_group


def _revenue(facts: DataFrame, keys: list[str]) -> DataFrame:
    totals = sliced(facts.filter(bought()), keys, {"orders": F.sum("n"), "cents": F.sum("cents")})
    revenue = from_cents(F.col("cents"))
    return totals.select(
        "slice",
        *keys,
        panel_number(revenue).alias("revenue"),
        "orders",
        panel_number(F.try_divide(revenue, F.col("orders"))).alias("avg_price"),
    )


def top_brands(facts: DataFrame, n: int = 20) -> DataFrame:
    ranked = top_per_group(_revenue(facts, ["brand"]), ["slice"], [F.col("revenue").desc(), F.col("brand")], n)
    return ranked.select("slice", "rank", "brand", "revenue")


def top_brands_by_category(facts: DataFrame, n: int = 10) -> DataFrame:
    order = [F.col("revenue").desc(), F.col("brand")]
    ranked = top_per_group(_revenue(facts, ["category", "brand"]), ["slice", "category"], order, n)
    return ranked.select("slice", "category", "rank", "brand", "revenue")


def _category_counts(facts: DataFrame) -> DataFrame:
    return sliced(
        facts,
        ["category"],
        {"views": count_of(viewed()), "carts": count_of(carted()), "purchases": count_of(bought()), "cents": cents_of(bought())},
    )


def category_funnel(facts: DataFrame, n: int = 8) -> DataFrame:
    """Views, carts and purchases of the categories with most revenue.

    Revenue and counts come from one aggregate, so the top list needs no second pass.
    """
    sold = _category_counts(facts).filter(F.col("purchases") > 0)
    ranked = top_per_group(sold, ["slice"], [F.col("cents").desc(), F.col("category")], n)
    return ranked.select("slice", "rank", "category", "views", "carts", "purchases")


def category_avg_price(facts: DataFrame, n: int = 8) -> DataFrame:
    order = [F.col("avg_price").desc(), F.col("category")]
    ranked = top_per_group(_revenue(facts, ["category"]), ["slice"], order, n)
    return ranked.select("slice", "rank", "category", "avg_price")


def category_conversion(facts: DataFrame, min_views: int = 50, n: int = 10) -> DataFrame:
    """Purchases per 100 views of categories with more than `min_views` views."""
    viewed = _category_counts(facts).filter(F.col("views") > min_views)
    rate = panel_number(F.lit(100) * F.col("purchases") / F.col("views"))
    ranked = top_per_group(
        viewed.withColumn("rate", rate), ["slice"], [F.col("rate").desc(), F.col("category")], n
    )
    return ranked.select("slice", "rank", "category", "rate")


def top_products(facts: DataFrame, n: int = 20) -> DataFrame:
    keys = ["product_id", "category", "brand"]
    order = [F.col("revenue").desc(), *[F.col(k) for k in keys]]
    ranked = top_per_group(_revenue(facts, keys), ["slice"], order, n)
    return ranked.select("slice", "rank", *keys, "revenue", "orders", "avg_price")
