"""Tables between steps, in the folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


_listed: ContextVar[list[str] | None] = ContextVar("listed", default=None)


def folder(spark: SparkSession) -> str:
    """A new folder that all executors share; below the warehouse where no folder is named."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once and read back: lineage ends here and survives lost executors."""
    path = f"{folder(df.sparkSession)}/{label}"
    if (listed := _listed.get()) is not None:
        listed.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def listing() -> Iterator[list[str]]:
    """The paths that are written inside, for `remove`."""
    token = _listed.set([])
    try:
        yield _listed.get()
    finally:
        _listed.reset(token)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that nothing will read again."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
