"""Learners by property; gate, storage and scoring by behaviour."""

import pytest
from pyspark.sql import functions as F

from shopsight.config import CHURN_FEATURES, ModelConfig
from shopsight.operators import metrics, modeling, trees
from shopsight.plans import training
from shopsight.sources import versions

CONFIG = ModelConfig(rf_trees=10, rf_depth=3, gbt_iterations=5, gbt_depth=2, folds=3)


@pytest.fixture(scope="module")
def users(spark):
    """400 users whose churn follows recency."""
    base = spark.range(400).withColumnRenamed("id", "user_id")
    features = {c: (F.xxhash64("user_id", F.lit(c)) % 50 + 50).cast("double") for c in CHURN_FEATURES}
    churned = (F.col("recency") + F.xxhash64("user_id", F.lit("noise")) % 15 > 55).cast("int")
    return base.withColumns(features).withColumn("churned", churned)


@pytest.fixture(scope="module")
def trained(users):
    return training.train(users, CONFIG)


def test_split_is_stable_and_near_its_share(users):
    first = modeling.with_split(users, CONFIG)
    assert 50 < first.filter("is_test").count() < 110
    assert sorted(first.filter("is_test").select("user_id").collect()) == sorted(
        modeling.with_split(users.repartition(9), CONFIG).filter("is_test").select("user_id").collect())


def test_weights_balance_the_classes(users):
    weighted = modeling.with_weights(users).groupBy("churned").agg(F.sum("weight").alias("w")).collect()
    assert all(r.w == pytest.approx(200.0) for r in weighted)


def test_constant_column_standardises_to_zero(spark):
    df = spark.createDataFrame([(1, 4.0), (2, 4.0)], "user_id long, f double")
    assert {r.value for r in modeling.standardised(df, ("f",)).collect()} == {0.0}


def test_every_model_learns(trained):
    rows = {r.model: r for r in trained.metrics.collect()}
    assert set(rows) == set(modeling.MODELS)
    assert all(0.75 < r.auc_roc <= 1 for r in rows.values())


def test_best_model_is_promoted_and_scores_everyone(spark, users, trained, folder):
    table = training.promote(trained, f"{folder}/champion", CONFIG).collect()
    winners = [r for r in table if r.is_champion]
    assert len(winners) == 1 and winners[0].auc_roc == max(r.auc_roc for r in table)
    scored = modeling.score_users(users, f"{folder}/champion")
    assert scored.filter("churn_score between 0 and 1 and churn_risk is not null").count() == 400


def test_gate_can_refuse_all(trained, folder, spark):
    from shopsight.sources.tables import path_exists

    table = training.promote(trained, f"{folder}/none", ModelConfig(min_auc=1.01)).collect()
    assert not any(r.is_champion for r in table)
    assert not path_exists(spark, f"{folder}/none")


def test_a_refused_model_leaves_the_champion(spark, users, trained, folder):
    training.promote(trained, f"{folder}/champion", CONFIG)
    first = versions.current(spark, f"{folder}/champion")
    training.promote(trained, f"{folder}/champion", ModelConfig(min_auc=1.01))
    assert versions.current(spark, f"{folder}/champion") == first
    training.promote(trained, f"{folder}/champion", CONFIG)
    assert versions.current(spark, f"{folder}/champion") != first
    with pytest.raises(FileNotFoundError):
        modeling.score_users(users, f"{folder}/nobody")


def test_published_scores_answer_for_one_user(spark, trained, folder):
    from conftest import SMALL

    from shopsight.functions.events import with_category
    from shopsight.plans import catalog

    features = catalog._churn_features(spark, SMALL)
    training.promote(trained, f"{folder}/champion", CONFIG)
    events, segments = with_category(catalog._events(spark, SMALL), "full"), catalog._event_rfm(spark, SMALL)
    training.score_and_publish(features, f"{folder}/champion", events, segments, f"{folder}/scores", catalog.UPSELL, buckets=4)
    scores = {r.user_id: r.churn_score for r in modeling.score_users(features, f"{folder}/champion").collect()}
    user = min(scores)
    row = training.answer(spark, f"{folder}/scores", user).first()
    want = catalog._recommend(spark, SMALL, catalog.upsell.upsell_top_k).where(F.col("user_id") == user).orderBy("rank").collect()
    assert row.churn_score == pytest.approx(scores[user]) and row.recommendations == [r.category for r in want] != []
    nobody = training.answer(spark, f"{folder}/scores", -5).first()
    assert nobody.churn_score is None and nobody.recommendations == []


def test_scoring_needs_its_features(spark, users):
    with pytest.raises(ValueError, match="n_carts"):
        modeling.score_users(users.drop("n_carts"), "/nowhere")


def test_importances(spark, trained):
    rows = modeling.feature_importance(trained.models[modeling.FOREST], spark).orderBy("rank").collect()
    assert rows[0].feature == "recency" and len(rows) == 10
    assert sum(r.importance for r in rows) == pytest.approx(1.0)


def test_summary_has_cross_validation(spark, trained):
    only = training.Trained({modeling.LOGISTIC: trained.models[modeling.LOGISTIC]}, trained.metrics, trained.data)
    row = training.model_summary(only, CONFIG).first()
    assert 0.5 < row.cv_auc_mean <= 1 and row.cv_auc_std >= 0


def test_every_model_has_a_curve(trained):
    curves = metrics.roc_curve(modeling.stacked_scores(trained.models, trained.data), group=("model",))
    ends = curves.groupBy("model").agg(F.max("fpr").alias("fpr"), F.max("tpr").alias("tpr")).collect()
    assert {r.model for r in ends} == set(modeling.MODELS) and all(r.fpr == r.tpr == 1.0 for r in ends)


def test_gradient_vanishes_at_the_optimum_only(spark, users):
    data = modeling.prepare(users, CONFIG)
    model = modeling.fit(modeling.LOGISTIC, data, CONFIG)
    found = {r.coordinate: r.gradient for r in modeling.logistic_gradient(model, data).collect()}
    assert set(found) == {*CHURN_FEATURES, "intercept"} and max(map(abs, found.values())) < 5e-4
    early = modeling.fit(modeling.LOGISTIC, data, ModelConfig(lr_iterations=1))
    assert max(abs(r.gradient) for r in modeling.logistic_gradient(early, data).collect()) > 5e-3


@pytest.mark.parametrize("name", [modeling.FOREST, modeling.BOOSTING])
def test_node_tables_score_like_the_models(spark, trained, folder, name):
    """Also walked by a recursive SQL statement over the stored tables."""
    import math

    import duckdb

    model = trained.models[name]
    nodes, rows = trees.node_table(model), trees.prepared_rows(model, trained.data.users)
    want = {r.user_id: r.score for r in trained.scores.where(F.col("model") == name).collect()}
    got = {r.user_id: r.score for r in trees.walked_scores(model, trained.data.users, nodes).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)

    values = rows.unpivot("user_id", list(CHURN_FEATURES), "feature", "value")
    nodes.write.parquet(f"{folder}/nodes")
    values.write.parquet(f"{folder}/values")
    walked = duckdb.sql(f"""
        WITH RECURSIVE nodes AS (FROM '{folder}/nodes/*.parquet'), vals AS (FROM '{folder}/values/*.parquet'),
            steps AS (
                SELECT DISTINCT user_id, tree, 0 AS node FROM vals, nodes
                UNION ALL
                SELECT s.user_id, s.tree, CASE WHEN v.value <= n.threshold THEN n."left" ELSE n."right" END
                FROM steps s JOIN nodes n USING (tree, node) JOIN vals v ON v.user_id = s.user_id AND v.feature = n.feature)
        SELECT user_id, avg(share), sum(weight * prediction) FROM steps JOIN nodes USING (tree, node) WHERE feature IS NULL GROUP BY user_id
    """).fetchall()
    assert len(walked) == len(want)
    for user, share, margin in walked:
        assert want[user] == pytest.approx(share if name == modeling.FOREST else 1 / (1 + math.exp(-2 * margin)), abs=1e-9)


def test_importances_follow_from_the_node_table(trained):
    assert all(r.difference == 0.0 for r in training.importance_differences(trained).collect())
    assert training.importance_differences(trained).count() == 20
    assert all(r.difference == 0.0 for r in training.tree_differences(trained).collect())


def test_checks_hold_and_notice_a_wrong_metric(trained):
    assert all(r.ok for r in training.checks(trained).collect())
    wrong = training.Trained(trained.models, trained.metrics.withColumn("auc_roc", F.lit(0.5)), trained.data, trained.scores)
    assert not any(r.ok for r in training.checks(wrong).where("check = 'auc'").collect())
    less = training.Trained(trained.models, trained.metrics, trained.data, trained.scores.where("user_id > 0"))
    assert not any(r.ok for r in training.checks(less).where("check IN ('histogram', 'every_user_once')").collect())


def test_all_folds_of_all_models(trained):
    found = modeling.cross_validate_all(modeling.MODELS, trained.data, CONFIG)
    assert set(found) == set(modeling.MODELS) and all(0.5 < mean <= 1 and std >= 0 for mean, std in found.values())
    alone = modeling.cross_validate(modeling.LOGISTIC, trained.data, CONFIG)
    assert alone == pytest.approx(found[modeling.LOGISTIC], abs=1e-6)


def test_model_panels(trained):
    from shopsight.plans import dashboard

    panels = dashboard.model_panels(trained)
    assert {name: df.count() for name, df in panels.items()} == dashboard.MODEL_MINIMUM
    for row in panels["roc_curves"].collect():
        assert 1 < len(row.points) <= dashboard.CURVE_STEPS + 1 and row.points == sorted(row.points)


def test_stored_scores_give_the_same_in_duckdb(trained, folder):
    """Metrics, gate, curves and histogram, by plain SQL over the stored scores."""
    import duckdb

    trained.scores.write.parquet(f"{folder}/scores")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW scores AS FROM '{folder}/scores/*.parquet'")
    con.execute("CREATE VIEW held AS SELECT * FROM scores WHERE is_test")
    rows = con.execute("""
        WITH pairs AS (
            SELECT p.model, avg(CASE WHEN p.score > q.score THEN 1.0 WHEN p.score = q.score THEN 0.5 ELSE 0 END) AS auc
            FROM held p JOIN held q ON p.model = q.model AND p.label = 1 AND q.label = 0 GROUP BY 1),
        cells AS (
            SELECT model, count(*) FILTER (score > 0.5 AND label = 1) AS tp, count(*) FILTER (score > 0.5 AND label = 0) AS fp,
                   count(*) FILTER (score <= 0.5 AND label = 1) AS fn, count(*) AS n, count(*) FILTER ((score > 0.5) = (label = 1)) AS good
            FROM held GROUP BY 1),
        hits AS (
            SELECT model, score, label, sum(label) OVER w AS tp, count(*) OVER w AS seen FROM held
            WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
        precision_sums AS (SELECT model, sum(tp / seen) FILTER (label = 1) / sum(label) AS auc_pr FROM hits GROUP BY 1)
        SELECT model, auc, auc_pr, 2 * tp / (2 * tp + fp + fn), CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, tp / (tp + fn), good / n,
               auc >= 0.6 AND auc = max(auc) OVER () AS champion
        FROM pairs JOIN cells USING (model) JOIN precision_sums USING (model)""").fetchall()
    names = ("auc_roc", "auc_pr", "f1", "precision", "recall", "accuracy")
    table = {r.model: r for r in modeling.choose_champion(trained.metrics, 0.6).collect()}
    assert len(rows) == len(table) == 3
    for model, *values, champion in rows:
        assert [float(v) for v in values] == pytest.approx([table[model][c] for c in names], abs=2e-6), model
        assert table[model].is_champion == champion

    curve = con.execute("""
        SELECT model, score, count(*) FILTER (label = 0) OVER w / count(*) FILTER (label = 0) OVER m, sum(label) OVER w / sum(label) OVER m
        FROM held WINDOW w AS (PARTITION BY model ORDER BY score DESC), m AS (PARTITION BY model)""").fetchall()
    got = {(r.model, r.threshold): (r.fpr, r.tpr) for r in metrics.roc_curve(trained.held_out(), group=("model",)).collect()}
    assert got.keys() == {(m, s) for m, s, *_ in curve}
    assert all(got[m, s] == pytest.approx((float(f), float(t))) for m, s, f, t in curve)

    for name in modeling.MODELS:
        counts = dict(con.execute(f"SELECT least(floor(score * 20), 19)::INT, count(*) FROM scores WHERE model = '{name}' GROUP BY 1").fetchall())
        own = {r.bin: r["count"] for r in metrics.score_histogram(trained.scores.where(F.col("model") == name)).collect()}
        assert own == {i: counts.get(i, 0) for i in range(20)}


def test_folds_are_fitted_beside_each_other_and_once(spark, trained, monkeypatch):
    """Every fit waits until all folds are being fitted; the areas are those of Spark's CrossValidator."""
    from threading import Barrier

    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    config, fits = ModelConfig(folds=3), []
    build, together = modeling.build_pipeline, Barrier(config.folds, timeout=120)
    folded = trained.data.train.withColumn("fold", modeling.hash_bucket(F.concat_ws("-", "churned", "user_id"), config.seed + 1, config.folds))
    told = CrossValidator(
        estimator=build(modeling.LOGISTIC, trained.data.train_rows, config), estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=BinaryClassificationEvaluator(labelCol="churned"), numFolds=config.folds, foldCol="fold",
    ).fit(folded)

    class Waiting:
        def __init__(self, *args):
            self.learner = build(*args)

        def fit(self, rows):
            fits.append(rows)
            together.wait()
            return self.learner.fit(rows)

    monkeypatch.setattr(modeling, "build_pipeline", Waiting)
    mean, deviation = modeling.cross_validate(modeling.LOGISTIC, trained.data, config)
    assert len(fits) == config.folds
    assert mean == pytest.approx(told.avgMetrics[0], abs=1e-12) and deviation == pytest.approx(told.stdMetrics[0], abs=1e-12)


def test_empty_fold_is_an_error(trained):
    with pytest.raises(ValueError):
        modeling.cross_validate(modeling.LOGISTIC, trained.data, ModelConfig(folds=5000))


def test_walk_takes_a_feature_by_its_place(trained, users):
    """A level's step reads one entry of an array, whatever the number of features: no comparison per feature and level."""
    model = trained.models[modeling.FOREST]
    leaves = trees.walk(trees.prepared_rows(model, users), trees.node_table(model), CONFIG.rf_depth)
    plan = leaves._jdf.queryExecution().optimizedPlan().toString()
    assert not any(f"= {name})" in plan for name in CHURN_FEATURES)
    assert leaves.count() == 400 * CONFIG.rf_trees
