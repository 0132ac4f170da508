"""Tables in one global order without one final task: files follow each other, rows follow each other within a file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def write_ordered(df: DataFrame, path: str, *order: Column) -> None:
    """Range-partitioned and sorted; `order` should tell all rows apart, as equal rows share a file."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """The rows with `file_number`, `row_number` (in the file) and `position` (in the table), all from 1.

    Positions come from the counts of the files, a row per file; no row is sorted or moved.
    """
    table = spark.read.parquet(path)
    placed = table.select("*", F.col("_metadata.file_name").alias("_file"), (F.col("_metadata.row_index") + 1).alias("row_number"))
    counts = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("_file")).groupBy("_file").agg(F.count("*").alias("_n"))
    by_name = Window.orderBy("_file")  # part-00000, part-00001, ...
    starts = counts.select(
        "_file", F.row_number().over(by_name).alias("file_number"),
        F.coalesce(F.sum("_n").over(by_name.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
    )
    joined = placed.join(F.broadcast(starts), "_file")  # a row per file
    return joined.withColumn("position", F.col("_before") + F.col("row_number")).drop("_file", "_before")
