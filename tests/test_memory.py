"""What one task holds: shuffle partitions are merged to a bounded size only, slices of panels are summed from months."""

from collections import Counter

from pyspark.sql import functions as F

from shopsight.operators.panels.common import ALL, sliced
from shopsight.session import prepare
from shopsight.sources import shop

ROWS = [("2024-01", "a", 1), ("2024-01", "a", 2), ("2024-02", "a", 4), ("2024-02", None, 8), (None, "b", 16)]


def _facts(spark, rows):
    return spark.createDataFrame(rows, "event_month string, brand string, n long")


def test_slices_are_the_months_and_their_sum(spark):
    wanted = Counter()
    for month, brand, n in ROWS:
        wanted[month, brand] += n
        wanted[ALL, brand] += n
    found = sliced(_facts(spark, ROWS), ["brand"], {"n": F.sum("n")})
    assert found.columns == ["slice", "brand", "n"]
    assert Counter({(r.slice, r.brand): r.n for r in found.collect()}) == wanted
    whole = {r.slice: r.n for r in sliced(_facts(spark, ROWS), [], {"n": F.sum("n")}).collect()}
    assert whole == {ALL: 31, "2024-01": 3, "2024-02": 12, None: 16}
    assert sliced(_facts(spark, []), [], {"n": F.sum("n")}).count() == 0


def test_partitions_are_merged_up_to_a_quarter_of_the_default(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        assert prepare(spark).conf.get(key) == "16m"
        spark.conf.set(key, "20KB")  # what a user has set stays
        assert prepare(spark).conf.get(key) == "20KB"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_lines_meet_their_orders_without_a_sort(spark, folder):
    spark.createDataFrame([(k % 50, k % 7, 1.0) for k in range(400)] + [(None, 1, 1.0)], shop.TABLE_SCHEMAS["lineitem"]).write.parquet(f"{folder}/lineitem.parquet")
    orders = spark.range(40).selectExpr("id AS o_orderkey", "id % 5 AS o_custkey", "timestamp_ntz '1996-01-01' + make_interval(id % 3) AS o_orderdate")
    orders.union(orders.where("o_orderkey = 3")).union(orders.selectExpr("NULL", "9", "o_orderdate").limit(1)).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(k, "a b", "B", "T") for k in range(7)], shop.TABLE_SCHEMAS["part"]).write.parquet(f"{folder}/part.parquet")
    broadcast, limit = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    try:
        spark.conf.set(broadcast, "-1")
        spark.conf.unset(limit)
        found = shop.shop_purchases(spark, folder).groupBy("user_id").count()
        assert Counter({r["user_id"]: r["count"] for r in found.collect()}) == {u: 64 + 8 * (u == 3) for u in range(5)}
        assert "ShuffledHashJoin" in found._jdf.queryExecution().executedPlan().toString()
        spark.conf.set(limit, "0")  # what a user has set stays
        assert prepare(spark).conf.get(limit) == "0"
    finally:
        spark.conf.unset(broadcast), spark.conf.unset(limit)
