"""Money and ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(price: Column, scale: int = 2) -> Column:
    """Price in whole minor units, so that a sum does not depend on the order of addition."""
    return F.round(price * F.lit(10**scale)).cast("long")


def from_cents(amount: Column, scale: int = 2) -> Column:
    return amount / F.lit(float(10**scale))


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double, 0 where the denominator is 0 or either is null."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def percent_of_at_least_one(numerator: Column, denominator: Column) -> Column:
    """100 * numerator / max(denominator, 1)."""
    return numerator * F.lit(100) / F.greatest(denominator, F.lit(1))


def panel_number(value: Column) -> Column:
    """NaN, infinity and null become 0; six decimals."""
    value = value.cast("double")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
    return F.round(F.when(finite, value).otherwise(F.lit(0.0)), 6)


def hash_bucket(key: Column, seed: int, buckets: int) -> Column:
    """Reproducible bucket in [0, buckets) from the md5 of a key and a seed."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def hash_order(key: Column, seed: int) -> Column:
    """Pseudo-random but reproducible sort key."""
    return F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))
