"""Data quality: one-pass metrics and rule tables that are really evaluated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.config import DEDUP_KEYS, EVENT_TYPES
from shopsight.functions.events import parse_time


SESSION_KEYS = ("user_id", "event_time", "user_session")


def row_counters() -> dict[str, Column]:
    """Counters of each rule that a row decides by itself."""
    price = F.col("price").try_cast("double")
    known = F.coalesce(F.lower(F.trim("event_type")).isin(*EVENT_TYPES), F.lit(False))
    user = F.col("user_id").try_cast("long")
    valid = known & user.isNotNull() & parse_time(F.col("event_time").cast("string")).isNotNull()
    return {
        "n": F.count(F.lit(1)),
        "null_user_id": F.count_if(user.isNull()),
        "null_price": F.count_if(price.isNull()),
        "negative_price": F.count_if(price < 0),
        "invalid_event_type": F.count_if(~known),
        "valid_rows": F.count_if(valid),
    }


def _counted(raw: DataFrame, session_keys: tuple[str, ...], event_keys: tuple[str, ...]) -> DataFrame:
    """Distinct full keys with their number of rows and the counters of each rule."""
    return raw.groupBy(*dict.fromkeys(event_keys + session_keys)).agg(*[c.alias(name) for name, c in row_counters().items()])


def dq_metrics(raw: DataFrame) -> DataFrame:
    """One row of counters from one scan.

    The rows are first reduced to distinct event keys with their counters, then to distinct
    session keys; both steps combine before they shuffle, so repeated rows cost nothing.
    """
    counters = tuple(row_counters())
    by_session = (
        _counted(raw, SESSION_KEYS, DEDUP_KEYS)
        .groupBy(*SESSION_KEYS)
        .agg(F.count("*").alias("event_keys"), *[F.sum(c).alias(c) for c in counters])
    )
    totals = by_session.agg(
        F.count("*").alias("session_keys"),
        F.coalesce(F.sum("event_keys"), F.lit(0)).alias("event_keys"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counters],
    )
    return totals.select(
        F.col("n").alias("total_rows"),
        "null_user_id",
        "null_price",
        "negative_price",
        "invalid_event_type",
        (F.col("n") - F.col("session_keys")).alias("duplicate_session_events"),
        (F.col("n") - F.col("event_keys")).alias("duplicate_events"),
        "valid_rows",
        F.round(F.lit(100) * F.col("null_user_id") / F.greatest("n", F.lit(1)), 2).alias("null_user_pct"),
    )


def rule_report(events: DataFrame) -> DataFrame:
    """Rows (check, observed, status) for the expectations on an event table."""
    price = F.col("price").try_cast("double")
    known = F.coalesce(F.lower(F.trim("event_type")).isin(*EVENT_TYPES), F.lit(False))
    observed = events.agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("user_id").isNull()).alias("null_users"),
        F.count_if(~known).alias("unknown_types"),
        F.count_if(F.coalesce(price < 0, F.lit(False))).alias("negative_prices"),
    )
    rules = [
        ("row_count_positive", "row_count", F.col("row_count") > 0),
        ("user_id_not_null", "null_users", F.col("null_users") == 0),
        ("event_type_in_set", "unknown_types", F.col("unknown_types") == 0),
        ("price_not_negative", "negative_prices", F.col("negative_prices") == 0),
    ]
    return _as_rows(observed, rules)


def feature_contract(features: DataFrame, min_rows: int = 100, required: str = "segment") -> DataFrame:
    """The feature table must exceed `min_rows` rows and carry the required column, filled."""
    present = required in features.columns
    filled = F.count(F.col(required)) if present else F.lit(0).cast("long")
    observed = features.agg(F.count("*").alias("n"), filled.alias("filled"))
    rules = [
        ("row_count", "n", F.col("n") > min_rows),
        (f"{required}_present", "filled", F.lit(present) & (F.col("filled") == F.col("n"))),
    ]
    return _as_rows(observed, rules)


def _as_rows(observed: DataFrame, rules: list[tuple[str, str, Column]]) -> DataFrame:
    entries = [
        F.struct(
            F.lit(name).alias("check"),
            F.col(column).cast("long").alias("observed"),
            F.when(passed, "passed").otherwise("failed").alias("status"),
        )
        for name, column, passed in rules
    ]
    return observed.select(F.inline(F.array(*entries)))


def require_passed(report: DataFrame) -> None:
    """Gate: raise if any rule failed. A report has a handful of rows."""
    failed = [r["check"] for r in report.filter(F.col("status") == "failed").collect()]
    if failed:
        raise ValueError(f"failed checks: {', '.join(failed)}")


def require_columns(features: DataFrame, columns: tuple[str, ...], fill_missing: bool = False) -> DataFrame:
    """Model inputs must be there; only on request are absent ones added as 0."""
    missing = [c for c in columns if c not in features.columns]
    if missing and not fill_missing:
        raise ValueError(f"missing feature columns: {', '.join(missing)}")
    return features.withColumns({c: F.lit(0.0) for c in missing})


def panel_contract(panels: dict[str, DataFrame], minimum: dict[str, int], slices: DataFrame) -> DataFrame:
    """Rows (panel, slice, rows, ok): every panel has its minimum of rows in every one of `slices`.

    A slice that a panel lacks has 0 rows; panels without slices count as a whole, under `all`.
    """
    counts = None
    for name, df in panels.items():
        key = F.col("slice") if "slice" in df.columns else F.lit("all")
        part = df.groupBy(F.lit(name).alias("panel"), key.alias("slice")).agg(F.count("*").alias("rows"))
        counts = part if counts is None else counts.unionByName(part)

    def wanted(names: list[str]) -> Column:
        return F.inline(F.array(*[F.struct(F.lit(n).alias("panel"), F.lit(minimum.get(n, 1)).alias("least")) for n in names]))

    by_slice = [n for n, df in panels.items() if "slice" in df.columns]
    whole = [n for n in panels if n not in by_slice]
    one = slices.sparkSession.range(1).select(F.lit("all").alias("slice"))
    parts = [rows.select("slice", wanted(names)) for rows, names in ((slices, by_slice), (one, whole)) if names]
    expected = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    rows = F.coalesce("rows", F.lit(0))
    return expected.join(counts, ["panel", "slice"], "left").select("panel", "slice", rows.alias("rows"), (rows >= F.col("least")).alias("ok"))
