"""All panels of a run from one materialised cube."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.functions.events import as_facts
from shopsight.operators import metrics, modeling
from shopsight.operators.panels import behaviour, overview, products
from shopsight.operators.panels.common import build_cube
from shopsight.plans.training import Trained
from shopsight.sources.tables import materialise, temporary, write_table


def build_panels(events: DataFrame, level: str = "root") -> dict[str, DataFrame]:
    """Events are scanned once for the cube and once each for the two distinct-count panels."""
    cube = materialise(build_cube(as_facts(events, level)), "cube")
    return {
        "overview_kpis": overview.overview_kpis(cube, events),
        "daily_events": overview.daily_events(cube),
        "funnel": overview.funnel(cube),
        "event_split": overview.event_split(cube),
        "category_revenue_top10": overview.category_revenue_top(cube),
        "daily_revenue": overview.daily_revenue(cube),
        "category_revenue": overview.category_revenue(cube),
        "top_brands": products.top_brands(cube),
        "top_brands_by_category": products.top_brands_by_category(cube),
        "category_funnel": products.category_funnel(cube),
        "category_avg_price": products.category_avg_price(cube),
        "category_conversion": products.category_conversion(cube),
        "top_products": products.top_products(cube),
        "weekday_hour_heatmap": behaviour.weekday_hour_heatmap(cube),
        "hourly_purchases": behaviour.hourly_purchases(cube),
        "weekday_purchases": behaviour.weekday_purchases(cube),
        "session_depth": behaviour.session_depth(events),
        "cumulative_revenue": behaviour.cumulative_revenue(cube),
        "daily_view_purchase_ratio": behaviour.daily_view_purchase_ratio(cube),
        "category_list": overview.category_list(cube),
        "run_metadata": overview.run_metadata(events),
    }


CURVE_STEPS = 100  # a drawn curve has a point per hundredth of the false positive rate at most


def model_panels(trained: Trained) -> dict[str, DataFrame]:
    """Panels of a training run, read from its stored scores: a curve per model, importances, the distribution of the scores."""
    spark = trained.scores.sparkSession
    point = F.struct(F.floor(F.col("fpr") * CURVE_STEPS).alias("step"), "fpr", "tpr")
    points = metrics.roc_curve(trained.held_out(), group=("model",)).select("model", point.alias("p"))
    thinned = points.groupBy("model", F.col("p.step").alias("step")).agg(F.max("p.fpr").alias("fpr"), F.max("p.tpr").alias("tpr"))
    curves = thinned.groupBy("model").agg(F.sort_array(F.collect_list(F.struct("fpr", "tpr"))).alias("points"))
    auc = trained.metrics.select("model", "auc_roc")
    panels = {"roc_curves": auc.join(curves, "model"), "model_metrics": trained.metrics}
    if modeling.FOREST in trained.models:
        panels["feature_importance"] = modeling.feature_importance(trained.models[modeling.FOREST], spark)
    best = trained.metrics.agg(F.max_by("model", F.struct("auc_roc", "model"))).scalar()
    panels["score_histogram"] = metrics.score_histogram(trained.scores.where(F.col("model") == best))
    return panels


MODEL_MINIMUM = {"roc_curves": 3, "model_metrics": 3, "feature_importance": 10, "score_histogram": 20}


def write_panels(events: DataFrame, folder: str, level: str = "root") -> None:
    with temporary(events.sparkSession):
        for name, panel in build_panels(events, level).items():
            write_table(panel, f"{folder}/{name}")
