"""Training-corpus pipeline: quality rules, near-duplicates, repeated passages, mixing, packing.

Each stage takes all that its predecessor kept. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopsight.llm import jaccard, mixing, packing, quality, scratch, substring, workers

# Counts of the mixture: 4 + copies (3 at most, the mix's cap) in three bits a row.
LANES, SLOTS = 16, 21
PRESENT = sum(4 << 3 * i for i in range(SLOTS))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the perplexity bands reject."""
    workers.importable(spark)
    return quality.judge(docs, by_words=True).where("kept").select("row.*").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: that with the smallest id; null ids are groups of their own."""
    workers.importable(spark)
    found = jaccard.jaccard_components(docs).where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(found, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.union(docs.where("doc_id IS NULL")).select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the words that an earlier one has in windows of 13; untouched texts stay as they are."""
    workers.importable(spark)
    found = substring.remove_repeats(docs)
    # a document of which nothing is left goes
    found = found.where("n_removed < n_words OR n_words = 0")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    columns = [{"text": text.alias("text"), "n_chars": F.char_length(text).cast("long").alias("n_chars")}.get(c, F.col(f"row.{c}")) for c in docs.columns]
    return found.select(columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; those that it leaves out go.

    Rows are told apart by their contents, so equal or null ids share no count. What the mix takes of equal rows is dealt out among them.
    The counts go to the places of the rows in their files, three bits a row (`LANES` words of `SLOTS` rows in a block): half a byte a
    document is broadcast up to far larger inputs than counts by key, and the texts then stay where they are. Rows that are not read from
    files of their own are written first.
    """
    workers.importable(spark)
    try:
        placed = docs.select("*", F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        return mixture(spark, scratch.written(docs, "rows"), sf_dir)
    keyed = placed.withColumn("_key", F.xxhash64(*docs.columns)).withColumn("_block", F.floor(F.col("_row") / (LANES * SLOTS)))
    taken = mixing.mix(keyed, id_column="_key").groupBy(F.col("doc_id").alias("_key")).agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows"))
    shared = keyed.select("_key", "_file", "_block", "_row").join(taken, "_key")
    rank = F.row_number().over(Window.partitionBy("_key").orderBy("_file", "_row")) - 1
    own = F.floor(F.col("_copies") / F.col("_rows")) + (rank < F.col("_copies") % F.col("_rows")).cast("long")
    shared = shared.withColumn("_code", F.call_function("shiftleft", 4 + own, (F.col("_row") % SLOTS * 3).cast("int")))
    lane = F.floor(F.col("_row") / SLOTS) % LANES
    words = [F.bit_or(F.when(lane == i, F.col("_code"))).alias(f"_word{i}") for i in range(LANES)]
    blocks = scratch.written(shared.groupBy("_file", "_block").agg(F.count("*").alias("_n"), *words), "blocks")
    present = [F.bit_count(F.coalesce(F.col(f"_word{i}"), F.lit(0)).bitwiseAND(F.lit(PRESENT))) for i in range(LANES)]
    if not blocks.where(F.col("_n") > sum(present[1:], present[0])).isEmpty():  # a place that several rows come from, as after a join
        return mixture(spark, scratch.written(docs, "rows"), sf_dir)
    repeated = keyed.join(blocks, ["_file", "_block"])
    word = F.array(*[F.col(f"_word{i}") for i in range(LANES)])[lane.cast("int")]
    copies = F.call_function("shiftright", word, (F.col("_row") % SLOTS * 3).cast("int")).bitwiseAND(F.lit(3)).cast("int")
    return repeated.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies))).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths, each a sequence of its own."""
    workers.importable(spark)
    pieces = packing.pack(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing", mixture),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; every stage's result is written and read again.

    Once it is, what the stage has read and written on its way is deleted; the last stage's result still reads that of the one before.
    """
    docs, old = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        with scratch.listing() as paths:
            docs = scratch.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        scratch.remove(spark, old + paths[:-1])
        old = paths[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None  # perplexity and tokens are beyond SQL; the pipeline as a whole is not compared with a plain version
