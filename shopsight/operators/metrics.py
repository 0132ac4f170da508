"""Evaluation of scored labels: (label 0/1, score) rows in, metric rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.functions.numbers import ratio
from shopsight.operators.ranking import running_totals


def _by_score(scored: DataFrame, group: tuple[str, ...] = ()) -> DataFrame:
    """Distinct scores, highest first, with positives and negatives at and above each."""
    counts = scored.groupBy(*group, "score").agg(
        F.sum("label").cast("long").alias("pos"), F.sum(1 - F.col("label")).cast("long").alias("neg")
    )
    return running_totals(counts, ["score"], ["pos", "neg"], group=group, descending=True)


def _sum_where(condition: Column, column: str) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0))


def binary_metrics(scored: DataFrame, threshold: float = 0.5, group: tuple[str, ...] = ()) -> DataFrame:
    """AUC-ROC (ties count half), average precision, and threshold metrics; 0 where undefined.

    Area is summed in exact decimals: for each score, negatives there meet the positives
    above, plus half of those beside them. The cells at the threshold are sums over the same scores, so that the
    scored rows are read once.
    """
    wide = "decimal(38,0)"
    pos, neg, above = (F.col(c).cast("decimal(18,0)") for c in ("pos", "neg", "pos_before"))
    pairs = (neg * (above * 2 + pos)).cast(wide)
    tp = F.col("pos_before") + F.col("pos")
    seen = tp + F.col("neg_before") + F.col("neg")
    if not group:
        whole = scored.withColumn("_all", F.lit(0))
        return binary_metrics(whole, threshold, ("_all",)).drop("_all")
    curves = _by_score(scored, group).groupBy(*group).agg(
        F.sum(pairs).cast("double").alias("_area"),
        F.sum(F.col("pos") * (tp / seen)).alias("_precision_sum"),
        F.max("pos_total").alias("_pos"),
        F.max("neg_total").alias("_neg"),
        _sum_where(F.col("score") > threshold, "pos").alias("tp"),
        _sum_where(F.col("score") > threshold, "neg").alias("fp"),
        _sum_where(F.col("score") <= threshold, "pos").alias("fn"),
        _sum_where(F.col("score") <= threshold, "neg").alias("tn"),
    )
    precision = ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    metrics = {
        "auc_roc": ratio(F.col("_area"), F.lit(2.0) * F.col("_pos") * F.col("_neg")),
        "auc_pr": ratio(F.col("_precision_sum"), F.col("_pos")),
        "f1": ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")),
        "precision": precision,
        "recall": recall,
        "accuracy": ratio(F.col("tp") + F.col("tn"), total),
    }
    return curves.select(*group, *[F.round(v, 6).alias(k) for k, v in metrics.items()])


def roc_curve(scored: DataFrame, group: tuple[str, ...] = ()) -> DataFrame:
    """One (threshold, fpr, tpr) point per distinct score; the origin is implied."""
    tp = F.col("pos_before") + F.col("pos")
    fp = F.col("neg_before") + F.col("neg")
    return _by_score(scored, group).select(
        *group,
        F.col("score").alias("threshold"),
        ratio(fp, F.col("neg_total")).alias("fpr"),
        ratio(tp, F.col("pos_total")).alias("tpr"),
    )


def score_histogram(scored: DataFrame, bins: int = 20) -> DataFrame:
    """Counts in equal bins of [0, 1]; the last bin is closed, empty bins are kept."""
    inside = scored.filter((F.col("score") >= 0) & (F.col("score") <= 1))
    index = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("long")
    counts = inside.groupBy(index.alias("bin")).agg(F.count("*").alias("n"))
    grid = scored.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return grid.join(counts, "bin", "left").select(
        "bin", (F.col("bin") / F.lit(float(bins))).alias("bin_start"), F.coalesce("n", F.lit(0)).alias("count")
    )
