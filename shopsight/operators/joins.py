"""Joins against a key list of unknown size."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shopsight.sources.tables import materialise


def exclude_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in `keys`; null keys stay.

    The list is written first: Spark then knows its size, and splits a hot key of the rows, which it does not
    where the other side of the join is itself an aggregate.
    """
    return rows.join(materialise(keys.select(key), "keys"), key, "left_anti")
