"""Tables in versions: a reader finds a whole one at any time, also while the next is written or after a failed run.

A version is a folder `v-...` below the table's folder. It counts once there is an empty file `_versions/<number>-<folder>`, which is
made in one step and needs no rename; the highest number is the current version. A run that dies leaves a folder that nobody
reads. Versions before the last `keep` are removed, so that readers of the previous one may finish.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.sources.tables import _file_system

MARKERS = "_versions"


def _committed(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """Number and folder of every version, oldest first; as many as are kept."""
    fs, folder = _file_system(spark, f"{root.rstrip('/')}/{MARKERS}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted((int(n.split("-", 1)[0]), n.split("-", 1)[1]) for n in names if n[:1].isdigit())


def new_version(root: str) -> str:
    """Folder for a version that nobody sees before it is committed."""
    return f"{root.rstrip('/')}/v-{uuid.uuid4().hex}"


def current(spark: SparkSession, root: str) -> str | None:
    """Folder of the current version, None if there is none."""
    found = _committed(spark, root)
    return f"{root.rstrip('/')}/{found[-1][1]}" if found else None


def commit(spark: SparkSession, root: str, folder: str, keep: int = 2) -> None:
    """Make a written folder the current version."""
    before = _committed(spark, root)
    number = before[-1][0] + 1 if before else 1
    fs, marker = _file_system(spark, f"{root.rstrip('/')}/{MARKERS}/{number:010d}-{folder.rsplit('/', 1)[1]}")
    if not fs.createNewFile(marker):
        raise FileExistsError(marker.toString())
    for old_number, old in before[: max(0, len(before) + 1 - keep)]:
        for path in (f"{root.rstrip('/')}/{MARKERS}/{old_number:010d}-{old}", f"{root.rstrip('/')}/{old}"):
            fs.delete(_file_system(spark, path)[1], True)


def publish(df: DataFrame, root: str, keep: int = 2) -> None:
    """Write a whole new version, then switch to it."""
    folder = new_version(root)
    df.write.parquet(folder)
    commit(df.sparkSession, root, folder, keep)


def publish_scores(df: DataFrame, root: str) -> None:
    """Full refresh with the time of scoring."""
    publish(df.withColumn("scored_at", F.current_timestamp()), root)


def read(spark: SparkSession, root: str) -> DataFrame:
    """The current version; fails if nothing has been published."""
    folder = current(spark, root)
    if folder is None:
        raise FileNotFoundError(f"no version of {root}")
    return spark.read.parquet(folder)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, for what describes a table."""
    fs, target = _file_system(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, source = _file_system(spark, path)
    stream = fs.open(source)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
