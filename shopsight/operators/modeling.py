"""Churn classifiers on Spark ML: split, weights, training, evaluation, champion."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial
from statistics import fmean, pstdev

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.config import CHURN_FEATURES, ModelConfig
from shopsight.functions.labels import risk_tier
from shopsight.functions.numbers import hash_bucket
from shopsight.operators.metrics import binary_metrics
from shopsight.operators.quality import require_columns
from shopsight.sources import versions
from shopsight.sources.tables import materialise

# Model names of the panels.
LOGISTIC, FOREST, BOOSTING = "Logistic Regression", "Random Forest", "Gradient Boosting"
MODELS = (LOGISTIC, FOREST, BOOSTING)


def with_split(features: DataFrame, config: ModelConfig = ModelConfig()) -> DataFrame:
    """Add `is_test`. The hash of user and label puts the same share of each class in the test set in expectation."""
    key = F.concat_ws("-", F.col("churned").cast("string"), F.col("user_id").cast("string"))
    return features.withColumn("is_test", hash_bucket(key, config.seed, 100) < config.test_percent)


def class_weights(features: DataFrame) -> DataFrame:
    """(churned, n, weight): n_all / (2 * n_class), two rows."""
    counts = features.groupBy("churned").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("t"))
    return counts.withColumn("weight", total.scalar() / (F.lit(2.0) * F.col("n")))


def with_weights(features: DataFrame) -> DataFrame:
    return features.join(F.broadcast(class_weights(features).select("churned", "weight")), "churned")  # two rows


def standardised(features: DataFrame, columns: tuple[str, ...] = CHURN_FEATURES) -> DataFrame:
    """Long form (user_id, feature, value) of centred columns in units of their sample deviation.

    A constant column becomes 0, as the scaler in the model pipelines does.
    """
    moments = features.agg(
        F.array(*[F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")) for c in columns]).alias("m")
    )
    scaled = features.withColumn("_m", moments.scalar())
    pairs = []
    for i, c in enumerate(columns):
        m = F.col("_m")[i]
        value = F.when(m["std"] > 0, (F.col(c) - m["mean"]) / m["std"]).otherwise(F.lit(0.0))
        pairs.append(F.struct(F.lit(c).alias("feature"), value.alias("value")))
    return scaled.select("user_id", F.inline(F.array(*pairs)))


def build_pipeline(name: str, train_rows: int, config: ModelConfig = ModelConfig()) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(CHURN_FEATURES), outputCol="raw_features")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    common = {"labelCol": "churned", "featuresCol": "features"}
    if name == LOGISTIC:
        # An L2 strength of 1 on the summed loss is 1 / rows on Spark's mean loss.
        learner = LogisticRegression(
            **common, weightCol="weight", maxIter=config.lr_iterations, tol=config.lr_tolerance,
            regParam=1.0 / max(train_rows, 1), standardization=False,
        )
    elif name == FOREST:
        learner = RandomForestClassifier(
            **common, weightCol="weight", numTrees=config.rf_trees, maxDepth=config.rf_depth, seed=config.seed
        )
    elif name == BOOSTING:
        learner = GBTClassifier(
            **common, maxIter=config.gbt_iterations, maxDepth=config.gbt_depth, stepSize=config.gbt_step,
            subsamplingRate=config.gbt_subsample, seed=config.seed,
        )
    else:
        raise ValueError(f"unknown model: {name}")
    return Pipeline(stages=[assembler, scaler, learner])


def churn_probability() -> Column:
    return vector_to_array("probability")[1]


@dataclass
class Training:
    """Split features, written once so that every model sees the same rows."""

    train: DataFrame
    test: DataFrame
    train_rows: int
    users: DataFrame


def prepare(features: DataFrame, config: ModelConfig = ModelConfig()) -> Training:
    # Sampling in the tree learners follows row order, so the order must not vary between runs.
    ordered = with_split(features, config).repartition("user_id").sortWithinPartitions("user_id")
    split = materialise(ordered, "split")
    train = with_weights(split.filter(~F.col("is_test")))
    return Training(train, split.filter("is_test"), split.filter(~F.col("is_test")).count(), split)


def fit(name: str, data: Training, config: ModelConfig = ModelConfig()) -> PipelineModel:
    return fit_all((name,), data, config)[name]


def at_once(spark: SparkSession, tasks: dict[Hashable, Callable[[], object]]) -> dict:
    """Results of tasks that run beside each other, each in a scheduler pool of its own.

    The rounds of one fit wait for each other and leave a cluster idle; another fit fills the gaps. Pools share out the
    executors where spark.scheduler.mode is FAIR.
    """

    def run(name: Hashable):
        label = name if isinstance(name, str) else " ".join(map(str, name))
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", label.replace(" ", "-").lower())
        return tasks[name]()

    with ThreadPoolExecutor(len(tasks)) as pool:
        started = {name: pool.submit(inheritable_thread_target(spark)(run), name) for name in tasks}
        return {name: x.result() for name, x in started.items()}


def fit_all(names: tuple[str, ...], data: Training, config: ModelConfig = ModelConfig()) -> dict[str, PipelineModel]:
    """Fitted models by name, from training rows that are read once."""
    train = data.train.persist()
    try:
        return at_once(train.sparkSession, {n: partial(build_pipeline(n, data.train_rows, config).fit, train) for n in names})
    finally:
        train.unpersist()


def standard_features(model: PipelineModel) -> list[Column]:
    """The features as the learner sees them, in order."""
    scaler = model.stages[1]
    return [
        (F.col(c) - F.lit(float(m))) / F.lit(float(s)) if s > 0 else F.lit(0.0)
        for c, m, s in zip(CHURN_FEATURES, scaler.mean.toArray(), scaler.std.toArray())
    ]


def logistic_gradient(model: PipelineModel, data: Training) -> DataFrame:
    """(coordinate, gradient) of the weighted mean loss with its L2 term at the fitted coefficients: 0 at the optimum.

    One pass over the training rows, one sum per coordinate.
    """
    learner = model.stages[-1]
    values = standard_features(model)
    margin = F.lit(float(learner.intercept))
    for value, c in zip(values, learner.coefficients.toArray()):
        margin = margin + value * F.lit(float(c))
    error = F.col("weight") * (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)) - F.col("churned"))
    strength = learner.getOrDefault("regParam")
    total = F.sum("weight")
    entries = [
        F.struct(F.lit(name).alias("coordinate"), (F.sum(error * value) / total + F.lit(strength * float(c))).alias("gradient"))
        for name, value, c in zip(CHURN_FEATURES, values, learner.coefficients.toArray())
    ]
    entries.append(F.struct(F.lit("intercept").alias("coordinate"), (F.sum(error) / total).alias("gradient")))
    return data.train.agg(F.array(*entries).alias("g")).select(F.inline("g"))


def scaling(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """(coordinate, mean, std) of the training rows: one row per feature."""
    scaler = model.stages[1]
    rows = [(c, float(m), float(s)) for c, m, s in zip(CHURN_FEATURES, scaler.mean.toArray(), scaler.std.toArray())]
    return spark.createDataFrame(rows, "coordinate string, mean double, std double")


def test_scores(model: PipelineModel, data: Training) -> DataFrame:
    return model.transform(data.test).select("user_id", F.col("churned").alias("label"), churn_probability().alias("score"))


def evaluate(models: dict[str, PipelineModel], data: Training) -> DataFrame:
    """One metric row per model, all models evaluated in one pass over their stacked test scores."""
    return binary_metrics(stacked_scores(models, data), group=("model",))


def stacked_scores(models: dict[str, PipelineModel], data: Training) -> DataFrame:
    """(model, user_id, label, score) of the test rows, written once."""
    return score_table(models, data).where("is_test").drop("is_test")


def score_table(models: dict[str, PipelineModel], data: Training) -> DataFrame:
    """(model, user_id, label, is_test, score) of all users, written once: what metrics, gate, curves and tiers are read from."""
    stacked = None
    for name, model in models.items():
        part = model.transform(data.users).select(
            F.lit(name).alias("model"), "user_id", F.col("churned").alias("label"), "is_test", churn_probability().alias("score")
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    return materialise(stacked, "scores")


def cross_validate(name: str, data: Training, config: ModelConfig = ModelConfig()) -> tuple[float, float]:
    """Mean and standard deviation of the AUC over the folds."""
    return cross_validate_all((name,), data, config)[name]


def cross_validate_all(names: tuple[str, ...], data: Training, config: ModelConfig = ModelConfig()) -> dict[str, tuple[float, float]]:
    """Mean and standard deviation of each model's AUC over hash folds of the training rows; user and label are hashed, as in the split.

    All folds of all models are fitted beside each other over one stored table of folds, and each fit once: Spark's CrossValidator
    takes the folds in turn and fits a last model on all rows, which nothing here reads.
    """
    key = F.concat_ws("-", F.col("churned").cast("string"), F.col("user_id").cast("string"))
    folded = materialise(data.train.withColumn("fold", hash_bucket(key, config.seed + 1, config.folds)), "folds").persist()
    evaluator = BinaryClassificationEvaluator(labelCol="churned", metricName="areaUnderROC")

    def validate(name: str, fold: int) -> float:
        model = build_pipeline(name, data.train_rows, config).fit(folded.filter(F.col("fold") != fold))
        return evaluator.evaluate(model.transform(folded.filter(F.col("fold") == fold)))

    try:
        filled = {row["fold"] for row in folded.select("fold").distinct().collect()}
        for fold in range(config.folds):
            if not filled - {fold} or fold not in filled:
                raise ValueError(f"fold {fold} has no rows to train on or to validate with")
        found = at_once(folded.sparkSession, {(n, i): partial(validate, n, i) for n in names for i in range(config.folds)})
    finally:
        folded.unpersist()
    areas = {name: [found[name, i] for i in range(config.folds)] for name in names}
    return {name: (fmean(x), pstdev(x)) for name, x in areas.items()}


def feature_importance(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """Ranked importances of a tree model: ten rows."""
    weights = model.stages[-1].featureImportances.toArray()
    ranked = sorted(zip(CHURN_FEATURES, (float(w) for w in weights)), key=lambda p: (-p[1], p[0]))
    rows = [(i + 1, name, weight) for i, (name, weight) in enumerate(ranked)]
    return spark.createDataFrame(rows, "rank int, feature string, importance double")


def choose_champion(metrics: DataFrame, min_auc: float = ModelConfig.min_auc) -> DataFrame:
    """Metric rows with `is_champion`: the best AUC, if it passes the gate."""
    best = metrics.agg(F.max_by("model", F.struct("auc_roc", "model")).alias("m")).scalar()
    passed = F.col("auc_roc") >= min_auc
    return metrics.withColumns({"passed_gate": passed, "is_champion": passed & (F.col("model") == best)})


def save_champion(model: PipelineModel, path: str) -> None:
    """A new version of the champion; scoring goes on with the former one until it is whole."""
    spark, folder = SparkSession.getActiveSession(), versions.new_version(path)
    model.write().save(folder)
    versions.commit(spark, path, folder)


def load_champion(spark: SparkSession, path: str) -> PipelineModel:
    folder = versions.current(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no champion at {path}")
    return PipelineModel.load(folder)


def score_users(features: DataFrame, champion_path: str) -> DataFrame:
    """Churn score and risk of every user with the stored champion."""
    require_columns(features, CHURN_FEATURES)
    scored = load_champion(features.sparkSession, champion_path).transform(features)
    return scored.select("user_id", churn_probability().alias("churn_score")).withColumn(
        "churn_risk", risk_tier(F.col("churn_score"))
    )
