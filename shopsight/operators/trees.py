"""Tree ensembles as tables: the nodes of a fitted model, a scorer that walks them by joins, importances from their gains.

A node table has at most trees * 2 ** (depth + 1) rows, whatever the training data. It explains a score without the library that
fitted the model, and any SQL engine can score from it.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.config import CHURN_FEATURES
from shopsight.sources.tables import materialise, scratch_path

NODE_COLUMNS = ("tree", "weight", "node", "feature", "threshold", "left", "right", "prediction", "share", "rows", "gain")


def node_table(model: PipelineModel, columns: tuple[str, ...] = CHURN_FEATURES) -> DataFrame:
    """One row per node of a fitted forest or boosting (NODE_COLUMNS); leaves have no feature, threshold and children.

    `share` is the weighted share of churners among a forest node's training rows, `rows` the weighted number of rows.
    """
    learner, spark = model.stages[-1], SparkSession.getActiveSession()
    path = scratch_path(spark, "trees")
    learner.write().save(path)
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "_about", "weight").drop("_about")
    n = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    stats = F.col("impurityStats")
    boosted = _is_boosted(model)
    rows = stats[0] if boosted else F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    inner = F.col("leftChild") >= 0
    names = F.array(*[F.lit(c) for c in columns])
    nodes = n.join(weights, "tree").select(
        "tree", "weight", F.col("id").alias("node"),
        F.when(inner, names[F.col("split.featureIndex")]).alias("feature"),
        F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        "prediction", (F.lit(None).cast("double") if boosted else stats[1] / rows).alias("share"), rows.alias("rows"),
        F.when(inner, F.col("gain")).alias("gain"),
    )
    return materialise(nodes, "nodes")


def _is_boosted(model: PipelineModel) -> bool:
    return type(model.stages[-1]).__name__.startswith("GBT")


def prepared_rows(model: PipelineModel, rows: DataFrame, key: str = "user_id", columns: tuple[str, ...] = CHURN_FEATURES) -> DataFrame:
    """(key, one column per feature), as the learner of the pipeline sees them."""
    values = PipelineModel(model.stages[:-1]).transform(rows).select(key, vector_to_array("features").alias("_v"))
    return values.select(key, *[F.col("_v")[i].alias(c) for i, c in enumerate(columns)])


def walk(rows: DataFrame, nodes: DataFrame, depth: int, key: str = "user_id", columns: tuple[str, ...] = CHURN_FEATURES) -> DataFrame:
    """(key, tree, weight, prediction, share) of the leaf that every row reaches in every tree.

    A join per level. The node table is stored, so Spark knows its size and sends it to the rows; these are not shuffled. A row's
    features travel as one array and a node names a place in it: a comparison with every column, level by level, makes code that
    the JVM does not compile.
    """
    names = F.array(*[F.lit(c) for c in columns])
    steps = nodes.select("tree", "node", (F.array_position(names, F.col("feature")) - 1).cast("int").alias("place"), "threshold", "left", "right")
    value = F.get("_values", F.col("place"))
    further = F.when(F.col("left").isNull(), F.col("node")).when(value <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
    last = nodes.agg(F.max("tree")).first()[0]
    held = rows.select(key, F.array(*columns).alias("_values"))
    at = held.select("*", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("tree"), F.lit(0).alias("node"))
    for _ in range(depth):
        at = at.join(steps, ["tree", "node"]).select(key, "_values", "tree", further.alias("node"))
    return at.join(nodes.select("tree", "node", "weight", "prediction", "share"), ["tree", "node"]).select(key, "tree", "weight", "prediction", "share")


def walked_scores(model: PipelineModel, rows: DataFrame, nodes: DataFrame | None = None, key: str = "user_id") -> DataFrame:
    """(key, score): the churn probability from the node table alone."""
    nodes = node_table(model) if nodes is None else nodes
    leaves = walk(prepared_rows(model, rows, key), nodes, model.stages[-1].getOrDefault("maxDepth"), key).groupBy(key)
    if _is_boosted(model):
        margin = leaves.agg(F.sum(F.col("weight") * F.col("prediction")).alias("margin"))
        return margin.select(key, (F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * F.col("margin")))).alias("score"))
    return leaves.agg(F.avg("share").alias("score"))


def importances(nodes: DataFrame, boosted: bool, columns: tuple[str, ...] = CHURN_FEATURES) -> DataFrame:
    """(feature, importance), summing to 1: gains weighted by rows; every tree of a forest counts alike."""
    gains = nodes.where("feature IS NOT NULL").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("gain"))
    if not boosted:
        totals = gains.groupBy("tree").agg(F.sum("gain").alias("total"))
        gains = gains.join(totals, "tree").select("feature", F.try_divide("gain", "total").alias("gain"))
    sums = gains.groupBy("feature").agg(F.sum("gain").alias("gain"))
    whole = sums.agg(F.sum("gain").alias("whole")).scalar()
    every = nodes.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    share = F.coalesce(F.try_divide(F.col("gain"), whole), F.lit(0.0))
    return every.join(sums, "feature", "left").select("feature", share.alias("importance"))
