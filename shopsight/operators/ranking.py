"""Exact global ranks, quantiles and running totals without a single-partition window.

A window without a partition key moves every row to one task. Here rows are range-partitioned
by the ordering, written once with the number of their slice, and summed twice: inside each
slice, and over the slice totals (one row per slice, so a small table). The written copy makes
slice numbers and offsets agree even when tasks are re-run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsight.sources.tables import materialise


def running_totals(
    rows: DataFrame, order: list[str], sums: list[str], group: tuple[str, ...] = (), descending: bool = False
) -> DataFrame:
    """Add `<s>_before` (sum over all earlier rows) and `<s>_total` for every s in `sums`.

    `rows` must hold one row per (group, order) value: pre-aggregate ties first, which also
    takes the weight out of a value shared by many rows. `group` is for a handful of groups,
    such as metrics or models.
    """
    by = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    sliced = materialise(
        rows.repartitionByRange(*group, *by).withColumn("_slice", F.spark_partition_id()), "slices"
    )
    whole = list(group) or [F.lit(0)]
    earlier_slices = Window.partitionBy(*whole).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    all_slices = Window.partitionBy(*whole)
    per_slice = sliced.groupBy(*group, "_slice").agg(*[F.sum(s).alias(f"_{s}") for s in sums])
    offsets = per_slice.select(
        *group,
        "_slice",
        *[F.coalesce(F.sum(f"_{s}").over(earlier_slices), F.lit(0)).alias(f"_{s}_offset") for s in sums],
        *[F.sum(f"_{s}").over(all_slices).alias(f"{s}_total") for s in sums],
    )
    earlier_rows = Window.partitionBy(*group, "_slice").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    inside = sliced.withColumns(
        {f"_{s}_inside": F.coalesce(F.sum(s).over(earlier_rows), F.lit(0)) for s in sums}
    )
    # Bounded: one row per range slice and group.
    joined = inside.join(F.broadcast(offsets), [*group, "_slice"])
    return joined.select(
        *rows.columns,
        *[(F.col(f"_{s}_offset") + F.col(f"_{s}_inside")).alias(f"{s}_before") for s in sums],
        *[f"{s}_total" for s in sums],
    )


def _long_form(rows: DataFrame, metrics: list[str], *keys: str) -> DataFrame:
    pairs = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("long").alias("value")) for m in metrics]
    return rows.select(*keys, F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())


def _value_counts(rows: DataFrame, metrics: list[str]) -> DataFrame:
    counts = _long_form(rows, metrics).groupBy("metric", "value").agg(F.count("*").alias("n"))
    return running_totals(counts, ["value"], ["n"], group=("metric",))


def _collect_cuts(per_metric: DataFrame, bins: int) -> dict[str, list]:
    """bins - 1 values per metric, one row per metric."""
    return {row["metric"]: [row[f"cut_{k}"] for k in range(1, bins)] for row in per_metric.collect()}


def percent_rank_cuts(rows: DataFrame, metrics: list[str], bins: int) -> dict[str, list[int | None]]:
    """Least value whose average rank r satisfies ceil(bins * r / n) > k, for k = 1 .. bins - 1.

    With b rows before a value and c rows at it, r = b + (c + 1) / 2; compared in integers.
    """
    counts = _value_counts(rows, metrics)
    position = (2 * F.col("n_before") + F.col("n") + 1) * bins
    cuts = [
        F.min(F.when(position > 2 * k * F.col("n_total"), F.col("value"))).alias(f"cut_{k}") for k in range(1, bins)
    ]
    return _collect_cuts(counts.groupBy("metric").agg(*cuts), bins)


def quantile_cuts(rows: DataFrame, metrics: list[str], bins: int) -> dict[str, list[int | None]]:
    """Least integer above each linearly interpolated k / bins quantile (right-closed bins).

    Raises when two bin edges coincide, as they do when one value fills a whole bin.
    """
    counts = _value_counts(rows, metrics)

    def at(position: Column) -> Column:
        here = (F.col("n_before") <= position) & (position < F.col("n_before") + F.col("n"))
        return F.max(F.when(here, F.col("value")))

    last = F.col("n_total") - 1
    fields = [F.min("value").alias("low"), F.max("value").alias("high")]
    for k in range(1, bins):
        below = F.floor(last * k / bins)
        fields += [
            at(below).alias(f"lo_{k}"),
            at(F.least(below + 1, last)).alias(f"hi_{k}"),
            F.max((last * k) % bins).alias(f"rem_{k}"),
        ]
    cuts = {}
    for row in counts.groupBy("metric").agg(*fields).collect():
        # Edges times `bins`, so that they are whole numbers.
        inner = [row[f"lo_{k}"] * bins + (row[f"hi_{k}"] - row[f"lo_{k}"]) * row[f"rem_{k}"] for k in range(1, bins)]
        edges = [row["low"] * bins, *inner, row["high"] * bins]
        if len(set(edges)) < len(edges):
            raise ValueError(
                f"quantile edges of '{row['metric']}' repeat: too many equal values for {bins} bins; use percent_rank"
            )
        cuts[row["metric"]] = [edge // bins + 1 for edge in inner]
    return cuts


def value_score(value: Column, cuts: list[int | None], bins: int, descending: bool = False) -> Column:
    """1 + number of cuts at or below the value; null values get the middle score."""
    reached = [F.when(value >= F.lit(cut), 1).otherwise(0) for cut in cuts if cut is not None]
    score = sum(reached, F.lit(1))
    if descending:
        score = F.lit(bins + 1) - score
    return F.when(value.isNull(), F.lit(bins // 2 + 1)).otherwise(score).cast("int")


def ntile_cuts(rows: DataFrame, metrics: list[str], key: str, bins: int) -> dict[str, list[tuple | None]]:
    """(value, key) of the first row of tiles 2 .. bins under the order (value, key)."""
    long_rows = _long_form(rows, metrics, key).withColumn("n", F.lit(1).cast("long"))
    ranked = running_totals(long_rows, ["value", key], ["n"], group=("metric",))
    total = F.col("n_total")
    cuts = []
    for k in range(1, bins):
        start = F.floor(total / bins) * k + F.least(F.lit(k), total % bins)
        here = F.when(F.col("n_before") == start, F.struct("value", F.col(key).alias("key")))
        cuts.append(F.max(here).alias(f"cut_{k}"))
    return _collect_cuts(ranked.groupBy("metric").agg(*cuts), bins)


def ntile_score(value: Column, key: Column, cuts: list[tuple | None]) -> Column:
    reached = [
        F.when((value > cut["value"]) | ((value == cut["value"]) & (key >= cut["key"])), 1).otherwise(0)
        for cut in cuts
        if cut is not None
    ]
    return sum(reached, F.lit(1)).cast("int")


def top_per_group(rows: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """First k rows of every group. Spark filters to k per group and task before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)
