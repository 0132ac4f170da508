"""Tables: scratch copies that cut lineage, partitioned writes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_written: dict[str, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder of the cluster (spark.checkpoint.dir), else one below the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/") + "/shopsight"
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shopsight"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path, removed by `release`."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write once, read many: later plans start from the files and survive lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete the scratch copies this application has written, once its results are stored."""
    for path in _written.pop(spark.sparkContext.applicationId, []):
        fs, hadoop_path = _file_system(spark, path)
        fs.delete(hadoop_path, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Scratch copies made inside are deleted at the end: for jobs whose results are stored elsewhere by then."""
    app = spark.sparkContext.applicationId
    before = set(_written.setdefault(app, []))
    try:
        yield
    finally:
        for path in [p for p in _written.get(app, []) if p not in before]:
            fs, hadoop_path = _file_system(spark, path)
            fs.delete(hadoop_path, True)
            _written[app].remove(path)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def require_sources(spark: SparkSession, *patterns: str) -> None:
    """Fail before any job starts if a source pattern matches no file."""
    missing = []
    for pattern in patterns:
        fs, hadoop_path = _file_system(spark, pattern)
        if not fs.globStatus(hadoop_path):
            missing.append(pattern)
    if missing:
        raise FileNotFoundError(f"no input for: {', '.join(missing)}")


def source_report(spark: SparkSession, sources: dict[str, str]) -> DataFrame:
    """(source, present) for named path patterns."""
    found = []
    for name, pattern in sources.items():
        fs, hadoop_path = _file_system(spark, pattern)
        found.append((name, bool(fs.globStatus(hadoop_path))))
    return spark.createDataFrame(found, "source string, present boolean")


def write_partitioned(df: DataFrame, path: str, partitions: tuple[str, ...]) -> None:
    """Replace exactly the partitions present in `df`, so a re-run leaves the table unchanged.

    The rebalance hint lets adaptive execution merge small days and split a hot one into
    several tasks and files, where a plain repartition by date would send it to one task.
    """
    (
        df.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_table(df: DataFrame, path: str) -> None:
    """Full refresh."""
    df.write.mode("overwrite").parquet(path)


def drop_partition(spark: SparkSession, path: str, **values: str) -> None:
    """Remove one partition folder, if there is one."""
    fs, folder = _file_system(spark, "/".join([path.rstrip("/"), *(f"{k}={v}" for k, v in values.items())]))
    fs.delete(folder, True)
