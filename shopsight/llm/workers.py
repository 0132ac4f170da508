"""Let Python workers on the driver's machine import this package when it runs from a checkout."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> SparkSession:
    """On a cluster the package is installed or shipped with --py-files; there this changes nothing of use."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
    return spark
