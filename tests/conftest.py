from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="shopsight-test-")


EVENT_SCHEMA = (
    "event_time timestamp, event_type string, product_id long, category_id long, category_code string, "
    "brand string, price double, user_id long, user_session string"
)


@pytest.fixture(scope="session")
def events_from(spark):
    """Event frame from (time, type, product, code, brand, price, user, session) rows."""

    def build(rows):
        text = EVENT_SCHEMA.replace("event_time timestamp", "event_time string")
        full = [(r[0], r[1], r[2], None, *r[3:]) for r in rows]
        df = spark.createDataFrame(full, text)
        return df.withColumn("event_time", df.event_time.cast("timestamp"))

    return build
