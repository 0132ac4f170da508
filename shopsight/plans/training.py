"""Train, gate, publish, score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopsight.config import ModelConfig, UpsellConfig
from shopsight.operators import metrics as measures
from shopsight.operators import modeling, trees
from shopsight.operators.metrics import binary_metrics
from shopsight.operators.upsell import as_demand, upsell_top_k
from shopsight.sources import lookup, tables


@dataclass
class Trained:
    """`scores` (model, user_id, label, is_test, score) is the one source of metrics, gate, curves and tiers."""

    models: dict[str, PipelineModel]
    metrics: DataFrame
    data: modeling.Training
    scores: DataFrame | None = None

    def held_out(self) -> DataFrame:
        return self.scores.where("is_test")


def train(features: DataFrame, config: ModelConfig = ModelConfig(), names: tuple[str, ...] = modeling.MODELS) -> Trained:
    """All models fitted beside each other, their scores of all users stored, and the metrics of the test rows."""
    return train_on(modeling.prepare(features, config), config, names)


def train_on(data: modeling.Training, config: ModelConfig = ModelConfig(), names: tuple[str, ...] = modeling.MODELS) -> Trained:
    """`train` from rows that are split and stored already."""
    models = modeling.fit_all(names, data, config)
    scores = modeling.score_table(models, data)
    metrics = tables.materialise(binary_metrics(scores.where("is_test"), group=("model",)), "metrics")
    return Trained(models, metrics, data, scores)


def promote(trained: Trained, path: str, config: ModelConfig = ModelConfig()) -> DataFrame:
    """Store the champion if it passes the gate; returns the comparison table (one row per model)."""
    table = modeling.choose_champion(trained.metrics, config.min_auc)
    winner = table.filter("is_champion").select("model").first()
    if winner is not None:
        modeling.save_champion(trained.models[winner["model"]], path)
    return table


def model_summary(trained: Trained, config: ModelConfig = ModelConfig(), validated: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Hold-out and cross-validated metrics per model, four decimals; cross-validates unless that has been done."""
    spark = trained.metrics.sparkSession
    validated = validated or modeling.cross_validate_all(tuple(trained.models), trained.data, config)
    rows = [(name, *found) for name, found in validated.items()]
    cv = spark.createDataFrame(rows, "model string, cv_auc_mean double, cv_auc_std double")
    columns = ["auc_roc", "auc_pr", "f1", "cv_auc_mean", "cv_auc_std"]
    return trained.metrics.join(F.broadcast(cv), "model").select("model", *[F.round(c, 4).alias(c) for c in columns])


def checks(trained: Trained) -> DataFrame:
    """Rows (model, check, ok): what is derived from the stored scores, derived once more by other means.

    auc: the area from ranks instead of the curve. curve: ends at 1 for every class that the test rows have. histogram: counts
    every user. every_user_once: one score per user and model. Ranks are windows over the test rows of a model: a check for
    tests and small runs, not for production.
    """
    scores, held = trained.scores, trained.held_out()
    ranks = held.withColumn("r", F.rank().over(Window.partitionBy("model").orderBy("score")) + (F.count("*").over(Window.partitionBy("model", "score")) - 1) / 2)
    pos, neg = F.sum("label"), F.sum(1 - F.col("label"))
    by_rank = ranks.groupBy("model").agg(F.round(F.try_divide(F.sum(F.col("r") * F.col("label")) - pos * (pos + 1) / 2, pos * neg), 6).alias("auc"))
    auc = by_rank.join(trained.metrics, "model").select("model", F.lit("auc").alias("check"), (F.abs(F.coalesce("auc", F.lit(0.0)) - F.col("auc_roc")) < 2e-6).alias("ok"))
    ends = measures.roc_curve(held, group=("model",)).groupBy("model").agg(*[F.coalesce(F.max(c), F.lit(0.0)).alias(c) for c in ("fpr", "tpr")])
    classes = held.groupBy("model").agg(F.max("label").alias("any_pos"), F.max(1 - F.col("label")).alias("any_neg"))
    at_end = (F.abs(F.col("tpr") - F.col("any_pos")) < 1e-9) & (F.abs(F.col("fpr") - F.col("any_neg")) < 1e-9)
    curve = ends.join(classes, "model").select("model", F.lit("curve").alias("check"), at_end.alias("ok"))
    users = trained.data.users.select(F.count("*")).scalar()
    once = scores.groupBy("model").agg(((F.countDistinct("user_id") == users) & (F.count("*") == users)).alias("ok")).select("model", F.lit("every_user_once").alias("check"), "ok")
    found = auc.unionByName(curve).unionByName(once)
    for name in trained.models:
        counted = measures.score_histogram(scores.where(F.col("model") == name)).agg((F.sum("count") == users).alias("ok"))
        found = found.unionByName(counted.select(F.lit(name).alias("model"), F.lit("histogram").alias("check"), "ok"))
    return found


def tree_differences(trained: Trained) -> DataFrame:
    """(model, user_id, difference): scores of the tree models from their node tables, less the stored ones."""
    found = None
    for name in (n for n in trained.models if n != modeling.LOGISTIC):
        walked = trees.walked_scores(trained.models[name], trained.data.users).withColumnRenamed("score", "walked")
        both = trained.scores.where(F.col("model") == name).join(walked, "user_id", "left")
        part = both.select("model", "user_id", (F.round(F.abs(F.col("walked") - F.col("score")), 9) + 0.0).alias("difference"))
        found = part if found is None else found.unionByName(part)
    return found


def importance_differences(trained: Trained) -> DataFrame:
    """(model, feature, difference): importances from the node tables, less those of the fitted models."""
    found = None
    for name, model in trained.models.items():
        if name == modeling.LOGISTIC:
            continue
        own = trees.importances(trees.node_table(model), name == modeling.BOOSTING)
        told = modeling.feature_importance(model, trained.scores.sparkSession).withColumnRenamed("importance", "told")
        part = own.join(told, "feature").select(F.lit(name).alias("model"), "feature", (F.round(F.abs(F.col("importance") - F.col("told")), 9) + 0.0).alias("difference"))
        found = part if found is None else found.unionByName(part)
    return found


CHURN, UPSELL = "churn_scores", "upsell_scores"


def score_and_publish(
    features: DataFrame, champion_path: str, events: DataFrame, rfm: DataFrame, folder: str,
    config: UpsellConfig = UpsellConfig(), buckets: int = 64,
) -> None:
    """Daily scoring with the stored champion: churn scores of all users and their recommendations, as look-up tables."""
    for name, scores in ((CHURN, modeling.score_users(features, champion_path)), (UPSELL, upsell_top_k(as_demand(events), rfm, config))):
        lookup.publish_lookup(scores.withColumn("scored_at", F.current_timestamp()), f"{folder}/{name}", "user_id", buckets)


def answer(spark: SparkSession, folder: str, user_id: int) -> DataFrame:
    """What is published about one user: a row with churn score, risk and recommendations, best first; found flags as nulls say."""
    churn = lookup.lookup(spark, f"{folder}/{CHURN}", user_id)
    best = F.sort_array(F.collect_list(F.struct("rank", "category")))
    offers = lookup.lookup(spark, f"{folder}/{UPSELL}", user_id).agg(F.transform(best, lambda x: x["category"]).alias("recommendations"))
    asked = spark.range(1).select(F.lit(user_id).cast("long").alias("user_id"))
    known = asked.join(churn.select("user_id", "churn_score", "churn_risk"), "user_id", "left")
    return known.select("*", offers.scalar().alias("recommendations"))
