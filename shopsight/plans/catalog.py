"""The registered queries: every operator run over the given tables.

Each entry takes (spark, sf_dir). Parameters that differ from the defaults are those of
FIXTURES.md, section 4.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.config import ChurnConfig, ModelConfig, RfmConfig, SilverConfig, UpsellConfig
from shopsight.functions.events import as_facts, event_key, with_category, with_category_parts, with_time_parts
from shopsight.operators import bronze, churn, features, metrics, modeling, quality, rfm, scoring, silver, upsell
from shopsight.operators.panels import behaviour, overview, products, tiers
from shopsight.plans import dashboard, ledger, training
from shopsight.session import prepare
from shopsight.sources import raw, shop, tables, versions
from shopsight.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

EVENTS_CHURN = ChurnConfig("2024-01-01", "2024-01-28", "2024-01-31")
ORDER_COHORT = ChurnConfig("2000-01-01", "2001-01-01", "2002-01-01")
EVENTS_RFM = RfmConfig(ref_date="2024-01-31")
SILVER = SilverConfig(bot_limit=5)
SILVER_CUT = "2024-01-20"
UPSELL = UpsellConfig(alpha=1.0)
PANEL_SAMPLE = (3000, 7)  # size and seed of the second scatter plot


def order_rfm_config(method: str = "percent_rank") -> RfmConfig:
    return RfmConfig(ref_date="2001-08-02", method=method)


# Inputs ---------------------------------------------------------------------------------


def _events(spark: SparkSession, d: str, level: str | None = None) -> DataFrame:
    events = shop.shop_events(spark, d)
    return events if level is None else with_category(events, level)


def _event_facts(spark, d, level="root"):
    return as_facts(_events(spark, d), level)


def _purchase_facts(spark, d, level="root"):
    return as_facts(shop.shop_purchases(spark, d), level)


def _bronze(spark, d):
    return bronze.clean_events(shop.shop_events_dirty(spark, d))


def _demand(spark, d, include_unknown=False):
    return upsell.as_demand(_events(spark, d, "full"), include_unknown)


def _as_bronze(spark, d):
    """Clean events in bronze form."""
    return with_time_parts(_events(spark, d)).withColumn("price_raw", F.col("price")).drop("event_id")


def _churn_features(spark, d):
    return churn.churn_features(_events(spark, d), EVENTS_CHURN)


def _rule_scores(spark, d):
    return scoring.with_risk(scoring.rule_score(_churn_features(spark, d)))


def _labelled_rule_scores(spark, d):
    return _rule_scores(spark, d).select(F.col("churned").alias("label"), F.col("churn_score").alias("score"))


def _order_rfm(spark, d, method="percent_rank", breadth=False):
    return rfm.customer_rfm(shop.shop_purchases(spark, d), order_rfm_config(method), breadth)


def _event_rfm(spark, d):
    return rfm.customer_rfm(_events(spark, d), EVENTS_RFM, breadth=False)


# Sources, bronze, silver, quality -------------------------------------------------------

BRONZE_COLUMNS = ["event_type", "product_id", "category_code", "brand", "price", "user_id", "user_session", "event_date"]


def bronze_clean(spark, d):
    return _bronze(spark, d).select(F.unix_micros("event_time").alias("event_us"), *BRONZE_COLUMNS)


def category_split(spark, d):
    return with_category_parts(shop.shop_events_dirty(spark, d)).select("category_code", "category_root", "category_sub")


def time_parts(spark, d):
    timed = with_time_parts(shop.all_shop_events(spark, d))
    return timed.select("event_id", "event_date", "event_month", "event_hour", "event_weekday")


def event_surrogate_key(spark, d):
    return _events(spark, d).select(F.col("event_id").alias("source_id"), event_key().alias("event_key"))


def event_dedup(spark, d):
    events = bronze.dedup_events(_bronze(spark, d))
    return events.select(F.unix_micros("event_time").alias("event_us"), *BRONZE_COLUMNS)


def bot_session_filter(spark, d):
    return silver.drop_bot_sessions(_events(spark, d), SILVER.bot_limit).select(
        "event_id", "user_session", "event_type", "price"
    )


def csv_roundtrip(spark, d):
    path = tables.scratch_path(prepare(spark), "landing")
    shop.shop_events_dirty(spark, d).select(*shop.RAW_TEXT_COLUMNS).write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return raw.read_checked_csv(spark, path)


def month_union(spark, d):
    """Yearly inputs, tagged and concatenated."""
    purchases = shop.shop_purchases(spark, d)
    frames = {str(y): purchases.filter(churn.in_period(f"{y}-01-01", f"{y + 1}-01-01")) for y in range(1995, 2002)}
    tagged = raw.union_periods(frames, "period")
    return tagged.groupBy("period").agg(F.count("*").alias("events"), F.countDistinct("user_id").alias("users"))


def bronze_partition_counts(spark, d):
    """Two batches that share days and rows, late rows in the second, which arrives twice."""
    path = tables.scratch_path(prepare(spark), "bronze")
    events = tables.materialise(bronze.dedup_events(_bronze(spark, d)), "batches")
    early = events.filter((F.col("event_date") < F.lit(SILVER_CUT).cast("date")) & (F.col("product_id") % 3 > 0))
    for source, batch in (("early", early), ("late", events), ("late", events)):
        bronze.write_bronze(bronze.with_ingestion_columns(batch, "2024-01-31", source), path)
    table = bronze.dedup_events(spark.read.parquet(path).drop("_ingested_at", "_source", "_run_date", bronze.BATCH))
    return table.groupBy("event_month", "event_date").agg(F.count("*").alias("events"))


def silver_incremental_merge(spark, d):
    """Two batches, silver refreshed after each: a first period with rows missing, then those rows, the rest, and a known day once more."""
    landed, path = tables.scratch_path(prepare(spark), "bronze"), tables.scratch_path(spark, "silver")
    events = tables.materialise(_as_bronze(spark, d), "events")
    cut = F.lit(SILVER_CUT).cast("date")
    early = (F.col("event_date") < cut) & F.coalesce(F.col("product_id") % 2 == 0, F.lit(False))
    again = F.col("event_date") == F.date_sub(cut, 1)
    for source, batch in (("early", events.filter(early)), ("late", events.filter(~early | again))):
        bronze.write_bronze(bronze.with_ingestion_columns(batch, "2024-01-31", source), landed)
        ledger.refresh_silver(spark, landed, path, SILVER)
    return spark.read.parquet(path).select("event_id", "event_date", "event_type", "user_session", "price", "brand")


def dq_metrics(spark, d):
    return quality.dq_metrics(shop.shop_events_dirty(spark, d))


def dq_rule_report(spark, d):
    return quality.rule_report(shop.shop_events_dirty(spark, d))


def feature_contract(spark, d):
    return quality.feature_contract(_order_rfm(spark, d))


# Features and RFM -----------------------------------------------------------------------


def rfm_base(spark, d):
    return rfm.rfm_base(shop.shop_purchases(spark, d), order_rfm_config()).drop("monetary_cents")


def customer_rfm(spark, d):
    return _order_rfm(spark, d, breadth=True)


def _scores_only(df):
    return df.select("user_id", "recency", "frequency", "monetary", "r_score", "f_score", "m_score", "rfm_score")


def segment_counts(spark, d):
    return rfm.segment_counts(_order_rfm(spark, d))


def churned_buyers(spark, d):
    return churn.churned_buyers(shop.shop_purchases(spark, d), ORDER_COHORT)


def retained_buyers(spark, d):
    return churn.retained_buyers(shop.shop_purchases(spark, d), ORDER_COHORT)


def new_buyers(spark, d):
    return churn.new_buyers(shop.shop_purchases(spark, d), ORDER_COHORT)


def cohort_retention(spark, d):
    return churn.cohort_retention(shop.shop_purchases(spark, d), ORDER_COHORT)


# Scores, metrics ------------------------------------------------------------------------


def churn_risk_tiers(spark, d):
    return _rule_scores(spark, d).select("user_id", "churn_score", "churn_risk")


def score_overview(spark, d):
    return scoring.score_overview(_event_rfm(spark, d), _rule_scores(spark, d))


def score_lookup_batch(spark, d):
    """Every customer asks; those without events are answered as not found."""
    requested = shop.customers(spark, d)
    scores = tables.materialise(_event_rfm(spark, d), "event-rfm")
    recommended = upsell.upsell_top_k(_demand(spark, d), scores, UPSELL)
    return scoring.lookup_scores(requested, _rule_scores(spark, d), scores, recommended)


def upsell_lookup_batch(spark, d):
    """Every customer asks for recommendations with their scores."""
    return scoring.lookup_upsell(shop.customers(spark, d), _recommend(spark, d, upsell.upsell_top_k))


def stratified_split(spark, d):
    return modeling.with_split(_churn_features(spark, d)).select("user_id", "churned", "is_test")


def feature_standardised(spark, d):
    scaled = modeling.standardised(_churn_features(spark, d))
    return scaled.select("user_id", "feature", F.round("value", 6).alias("value"))


def hash_sample(spark, d):
    return raw.hash_sample(_events(spark, d), F.col("event_id"), percent=10).select("event_id", "user_id", "event_type")


# Upsell ---------------------------------------------------------------------------------


def _recommend(spark, d, build):
    return build(_demand(spark, d), _event_rfm(spark, d), UPSELL)


def upsell_scores_published(spark, d):
    path = tables.scratch_path(prepare(spark), "upsell-scores")
    versions.publish_scores(_recommend(spark, d, upsell.upsell_top_k), path)
    return versions.read(spark, path).drop("scored_at")


# Panels ---------------------------------------------------------------------------------


def panel_tiers(spark, d):
    return tiers.panel_tiers(
        products.category_conversion(_event_facts(spark, d, "full")),
        behaviour.session_depth(_events(spark, d)),
        churn.cohort_retention(shop.shop_purchases(spark, d), ORDER_COHORT),
        metrics.score_histogram(_labelled_rule_scores(spark, d)),
    )


PANEL_MINIMUM = {"weekday_hour_heatmap": 168, "affinity_matrix": 64, "segments": 4}


def _panels(spark, d):
    panels = dashboard.build_panels(_events(spark, d), "full")
    panels["affinity_matrix"] = upsell.affinity_matrix(_demand(spark, d), 8, 1)
    scored = tables.materialise(_order_rfm(spark, d), "rfm")
    return panels | {"segments": rfm.segment_counts(scored), "rfm_sample": rfm.rfm_sample(scored), "rfm_panel_sample": rfm.rfm_sample(scored, *PANEL_SAMPLE)}


def panel_contract(spark, d):
    panels = _panels(spark, d)
    return quality.panel_contract(panels, PANEL_MINIMUM, panels["overview_kpis"].select("slice"))


def run_contract(spark, d):
    """The contract over all tables of a run: panels of events, and those of a training run at full parameters."""
    panels = _panels(spark, d)
    slices = panels["overview_kpis"].select("slice")
    models = dashboard.model_panels(_trained(spark, d))
    return quality.panel_contract(panels | models, PANEL_MINIMUM | dashboard.MODEL_MINIMUM, slices)


# Models ---------------------------------------------------------------------------------

MODELS = ModelConfig()


def _fit_one(name: str) -> Query:
    def run(spark, d):
        return training.train(_churn_features(spark, d), MODELS, (name,)).metrics

    return run


_runs: dict[tuple, object] = {}


def _once(spark, d, what, make):
    """A training run is made once per application and folder; what it has stored serves all queries that read it."""
    key = (spark.sparkContext.applicationId, d, what)
    if key not in _runs:
        _runs[key] = make()
    return _runs[key]


def _split(spark, d):
    """Split features, stored once for training and validation."""
    return _once(spark, d, "split", lambda: modeling.prepare(_churn_features(spark, d), MODELS))


def _trained(spark, d):
    data = _split(spark, d)
    return _once(spark, d, "models", lambda: training.train_on(data, MODELS))


def _validated(spark, d):
    """All folds of all three models at full parameters."""
    data = _split(spark, d)
    return _once(spark, d, "folds", lambda: modeling.cross_validate_all(modeling.MODELS, data, MODELS))


def churn_lr_optimum(spark, d):
    """Gradient at the fitted coefficients, to three decimals, beside the scaling of each feature."""
    data = modeling.prepare(_churn_features(spark, d), MODELS)
    model = modeling.fit(modeling.LOGISTIC, data, MODELS)
    scaling = modeling.scaling(model, spark).withColumns({c: F.round(c, 6) for c in ("mean", "std")})
    gradient = modeling.logistic_gradient(model, data).withColumn("gradient", F.round("gradient", 3) + 0.0)
    return gradient.join(scaling, "coordinate", "left")


def churn_cv(spark, d):
    rows = [(name, *found) for name, found in _validated(spark, d).items()]
    return spark.createDataFrame(rows, "model string, cv_auc_mean double, cv_auc_std double")


def feature_importance(spark, d):
    return modeling.feature_importance(_trained(spark, d).models[modeling.FOREST], spark)


def tree_scores(spark, d):
    return training.tree_differences(_trained(spark, d))


def tree_importances(spark, d):
    return training.importance_differences(_trained(spark, d))


def model_checks(spark, d):
    return training.checks(_trained(spark, d))


def champion_gate(spark, d):
    return training.promote(_trained(spark, d), tables.scratch_path(spark, "champion"), MODELS)


def model_roc_curves(spark, d):
    """Hold-out curves of all three models."""
    return metrics.roc_curve(_trained(spark, d).held_out(), group=("model",))


def model_score_histogram(spark, d):
    """Scores that boosting gives to all users."""
    return metrics.score_histogram(_trained(spark, d).scores.where(F.col("model") == modeling.BOOSTING))


def model_summary(spark, d):
    """The folds are fitted beside the models that they validate."""
    _split(spark, d)
    made = modeling.at_once(spark, {"models": lambda: _trained(spark, d), "folds": lambda: _validated(spark, d)})
    return training.model_summary(made["models"], MODELS, made["folds"])


def churn_scores(spark, d):
    """All users scored by a stored champion; the gate is open, as the data carry no signal."""
    path, published = tables.scratch_path(spark, "champion"), tables.scratch_path(spark, "churn-scores")
    trained = _trained(spark, d)
    training.promote(trained, path, ModelConfig(min_auc=0.0))
    versions.publish_scores(modeling.score_users(trained.data.users, path), published)
    return versions.read(spark, published)


# Streams --------------------------------------------------------------------------------


def _stream(spark, d):
    """The event table as a stream; the pattern lets the table be one file or a folder of files."""
    return shop.from_event_rows(jobs.event_stream(prepare(spark), f"{d}/events.parque[t]", shop.TABLE_SCHEMAS["events"]))


def _finished(spark, stream, label, partitions=()):
    path = tables.scratch_path(spark, label)
    jobs.run_to_table(stream, path, tables.scratch_path(spark, f"{label}-state"), partitions)
    return spark.read.parquet(path)


def stream_bronze(spark, d):
    rows = shop.with_products(_stream(spark, d), spark, d)
    table = _finished(spark, jobs.stream_bronze(rows), "stream-bronze", bronze.PARTITIONS)
    return table.select(
        F.unix_micros("event_time").alias("event_us"), "event_type", "product_id", "category_code", "brand", "price",
        "user_id", "user_session", F.col("event_date").cast("date").alias("event_date"),
    )


def stream_daily_events(spark, d):
    """Days that the stream has closed, and those still open."""
    closed = _finished(spark, jobs.stream_daily(_stream(spark, d)), "stream-daily")
    return closed.unionByName(jobs.open_days(shop.all_shop_events(spark, d), closed))


def stream_sessions(spark, d):
    """Sessions that the stream has closed, and those still open."""
    closed = _finished(spark, jobs.stream_sessions(_stream(spark, d)), "stream-sessions")
    return closed.unionByName(jobs.open_sessions(shop.all_shop_events(spark, d), closed))


def queries() -> dict[str, Query]:
    return {
        "bronze_partition_counts": bronze_partition_counts,
        "silver_incremental_merge": silver_incremental_merge,
        "month_union": month_union,
        "csv_roundtrip": csv_roundtrip,
        "dq_metrics": dq_metrics,
        "dq_rule_report": dq_rule_report,
        "feature_contract": feature_contract,
        "bronze_clean": bronze_clean,
        "category_split": category_split,
        "time_parts": time_parts,
        "event_surrogate_key": event_surrogate_key,
        "event_dedup": event_dedup,
        "bot_session_filter": bot_session_filter,
        "rfm_base": rfm_base,
        "user_features": lambda s, d: features.user_features(_events(s, d), EVENTS_RFM.ref_date),
        "product_features": lambda s, d: features.product_features(_events(s, d)),
        "session_features": lambda s, d: features.session_features(_events(s, d)),
        "category_stats": lambda s, d: features.category_stats(_events(s, d, "full")),
        "distinct_counts": lambda s, d: features.distinct_counts(_events(s, d)),
        "churn_features": _churn_features,
        "churn_features_gold": lambda s, d: churn.churn_features_gold(_events(s, d), EVENTS_CHURN),
        "customer_rfm": customer_rfm,
        "rfm_percent_rank": lambda s, d: _scores_only(_order_rfm(s, d)),
        "rfm_qcut": lambda s, d: _scores_only(_order_rfm(s, d, "qcut")),
        "rfm_ntile": lambda s, d: _scores_only(_order_rfm(s, d, "ntile")),
        "segment_counts": segment_counts,
        "segment_actions": lambda s, d: rfm.segment_actions(_order_rfm(s, d)),
        "rfm_sample": lambda s, d: rfm.rfm_sample(_order_rfm(s, d)),
        "rfm_panel_sample": lambda s, d: rfm.rfm_sample(_order_rfm(s, d), *PANEL_SAMPLE),
        "churned_buyers": churned_buyers,
        "retained_buyers": retained_buyers,
        "new_buyers": new_buyers,
        "cohort_retention": cohort_retention,
        "churn_labels": lambda s, d: churn.churn_labels(_events(s, d), EVENTS_CHURN),
        "user_category_bought": lambda s, d: features.user_categories(_events(s, d, "full")),
        "upsell_features": lambda s, d: upsell.upsell_features(_events(s, d, "root"), 1.0, 300),
        "category_opportunity_scaled": lambda s, d: upsell.category_opportunity(_demand(s, d), UPSELL),
        "upsell_panel": lambda s, d: upsell.opportunity_panel(_demand(s, d, include_unknown=True), 1.0),
        "affinity_counts": lambda s, d: upsell.affinity_counts(_demand(s, d), 10),
        "category_affinity": lambda s, d: upsell.affinity_matrix(_demand(s, d), 10, 2),
        "category_copurchase_pairs": lambda s, d: upsell.copurchase_pairs(_demand(s, d)),
        "category_copurchase_support": lambda s, d: upsell.copurchase_support(_demand(s, d)),
        "upsell_candidates": lambda s, d: _recommend(s, d, upsell.upsell_candidates),
        "upsell_scores": lambda s, d: _recommend(s, d, upsell.user_scores),
        "upsell_top_k": lambda s, d: _recommend(s, d, upsell.upsell_top_k),
        "upsell_scores_published": upsell_scores_published,
        "overview_kpis": lambda s, d: overview.overview_kpis(_event_facts(s, d), _events(s, d)),
        "daily_events": lambda s, d: overview.daily_events(_event_facts(s, d)),
        "funnel": lambda s, d: overview.funnel(_event_facts(s, d)),
        "event_split": lambda s, d: overview.event_split(_event_facts(s, d)),
        "category_revenue_top10": lambda s, d: overview.category_revenue_top(_purchase_facts(s, d, "full")),
        "daily_revenue": lambda s, d: overview.daily_revenue(_purchase_facts(s, d)),
        "category_revenue": lambda s, d: overview.category_revenue(_purchase_facts(s, d)),
        "top_brands": lambda s, d: products.top_brands(_purchase_facts(s, d)),
        "top_brands_by_category": lambda s, d: products.top_brands_by_category(_purchase_facts(s, d, "full")),
        "category_funnel": lambda s, d: products.category_funnel(_event_facts(s, d, "full")),
        "category_avg_price": lambda s, d: products.category_avg_price(_purchase_facts(s, d, "full")),
        "category_conversion": lambda s, d: products.category_conversion(_event_facts(s, d, "full")),
        "top_products": lambda s, d: products.top_products(_purchase_facts(s, d)),
        "weekday_hour_heatmap": lambda s, d: behaviour.weekday_hour_heatmap(_event_facts(s, d)),
        "hourly_purchases": lambda s, d: behaviour.hourly_purchases(_event_facts(s, d)),
        "weekday_purchases": lambda s, d: behaviour.weekday_purchases(_event_facts(s, d)),
        "session_depth": lambda s, d: behaviour.session_depth(_events(s, d)),
        "cumulative_revenue": lambda s, d: behaviour.cumulative_revenue(_event_facts(s, d)),
        "daily_view_purchase_ratio": lambda s, d: behaviour.daily_view_purchase_ratio(_event_facts(s, d)),
        "category_list": lambda s, d: overview.category_list(_purchase_facts(s, d, "full")),
        "run_metadata": lambda s, d: overview.run_metadata(_events(s, d)),
        "panel_tiers": panel_tiers,
        "panel_contract": panel_contract,
        "run_contract": run_contract,
        "churn_risk_tiers": churn_risk_tiers,
        "top_churn": lambda s, d: scoring.top_churn(_rule_scores(s, d)),
        "score_histogram": lambda s, d: metrics.score_histogram(_labelled_rule_scores(s, d)),
        "score_overview": score_overview,
        "score_lookup_batch": score_lookup_batch,
        "upsell_lookup_batch": upsell_lookup_batch,
        "binary_metrics": lambda s, d: metrics.binary_metrics(_labelled_rule_scores(s, d)),
        "roc_curve": lambda s, d: metrics.roc_curve(_labelled_rule_scores(s, d)),
        "class_weights": lambda s, d: modeling.class_weights(_churn_features(s, d)),
        "stratified_split": stratified_split,
        "feature_standardised": feature_standardised,
        "hash_sample": hash_sample,
        "churn_lr": _fit_one(modeling.LOGISTIC),
        "churn_rf": _fit_one(modeling.FOREST),
        "churn_gbt": _fit_one(modeling.BOOSTING),
        "churn_lr_optimum": churn_lr_optimum,
        "tree_scores": tree_scores,
        "tree_importances": tree_importances,
        "model_checks": model_checks,
        "churn_cv": churn_cv,
        "feature_importance": feature_importance,
        "champion_gate": champion_gate,
        "model_summary": model_summary,
        "model_roc_curves": model_roc_curves,
        "model_score_histogram": model_score_histogram,
        "churn_scores": churn_scores,
        "stream_bronze": stream_bronze,
        "stream_daily_events": stream_daily_events,
        "stream_sessions": stream_sessions,
    }

