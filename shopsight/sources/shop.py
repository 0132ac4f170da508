"""Shop events derived from the given tables (FIXTURES.md, section 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.config import EVENT_TYPES
from shopsight.session import prepare

# Columns of the given tables that are used here. Declared, so that reading
# starts no job to infer them.
TABLE_SCHEMAS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string",
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey long, l_partkey long, l_extendedprice double",
    "customer": "c_custkey long",
}
RAW_TEXT_COLUMNS = (
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per product. The grouping tells Spark so: where no product column is used, it drops the join.

    Dealing the products out once more, by a hash, leaves the join an exchange of its own on both sides; adaptive execution
    splits a hot product only then. Events are not shuffled for it.
    """
    last_word = F.element_at(F.split("p_name", " "), -1)
    products = _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat_ws(".", F.lower("p_type"), last_word).alias("category_code"),
        F.lower("p_brand").alias("brand"),
    )
    one = products.groupBy("product_id").agg(F.min(F.struct("category_code", "brand")).alias("p"))
    return one.select("product_id", "p.category_code", "p.brand").repartition(F.xxhash64("product_id"))


def with_products(events: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category and brand of each event's product; works on streams too."""
    joined = events.join(_products(spark, sf_dir), "product_id", "left")
    return joined.withColumn("category_id", F.lit(None).cast("long"))


def from_event_rows(events: DataFrame) -> DataFrame:
    """Shop event columns that need only the event row itself; works on streams too."""
    event_time = F.col("ts").cast("timestamp")
    return events.select(
        "event_id",
        event_time.alias("event_time"),
        F.when(F.col("event_type") == "click", "cart").otherwise(F.col("event_type")).alias("event_type"),
        F.get_json_object("props", "$.k").cast("long").alias("product_id"),
        F.col("value").alias("price"),
        "user_id",
        F.concat_ws("-", F.col("user_id").cast("string"), F.to_date(event_time).cast("string")).alias("user_session"),
    )


def all_shop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event row, including the types a shop does not know."""
    return with_products(from_event_rows(_table(spark, sf_dir, "events")), spark, sf_dir)


def shop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View, cart and purchase events."""
    return all_shop_events(spark, sf_dir).filter(F.col("event_type").isin(*EVENT_TYPES))


def shop_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One purchase event per order line."""
    lines = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders")
    purchases = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
        F.lit("purchase").alias("event_type"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderkey").cast("string").alias("user_session"),
    )
    return purchases.join(_products(spark, sf_dir), "product_id", "left")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def shop_events_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as CSV-like text with planted faults, by event_id."""
    clean = all_shop_events(spark, sf_dir)
    time_text = F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return clean.select(
        F.when(_every(101), "not-a-time").otherwise(F.concat(time_text, F.lit(" UTC"))).alias("event_time"),
        F.when(_every(11), F.concat(F.lit(" "), F.upper("event_type"), F.lit(" ")))
        .otherwise(F.col("event_type"))
        .alias("event_type"),
        F.col("product_id").cast("string").alias("product_id"),
        F.col("category_id").cast("string").alias("category_id"),
        F.when(_every(7), F.lit(None))
        .when(_every(5), F.substring_index("category_code", ".", 1))
        .otherwise(F.col("category_code"))
        .alias("category_code"),
        F.when(_every(13), " ").otherwise(F.col("brand")).alias("brand"),
        F.when(_every(53), F.lit(None))
        .when(_every(59), F.concat(F.lit("-"), F.col("price").cast("string")))
        .when(_every(61), "abc")
        .otherwise(F.col("price").cast("string"))
        .alias("price"),
        F.when(_every(97), F.lit(None)).otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(_every(89), F.lit(None)).otherwise(F.col("user_session")).alias("user_session"),
        F.explode(F.array_repeat(F.lit(1), F.when(_every(50), 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")
