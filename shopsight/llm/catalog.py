"""Registered queries: every operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import chat, decontaminate, fingerprint, hardneg, html, jaccard, merkle, mixing, packing, quality, statements, substring, suffixdedup, warc, workers


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return workers.importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixdedup.remove_copied_bytes(docs).select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages")).select("row.page_id", "visible_text")


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(_table(spark, sf_dir, "conversations"))


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_next(_table(spark, sf_dir, "documents"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def op7_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs).select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = quality.judge(docs, by_words=True)
    return judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_warc_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.convert(_table(spark, sf_dir, "pages"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents; where 7 divides the checksum of the id, the proof is tried with one more character claimed."""
    docs = _table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    claimed = [F.try_add(F.col(f), F.lit(1)) if f == "n_chars" else F.col(f) for f in fields]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    shown = F.when(tampered, merkle.leaf_digest(*claimed)).alias("shown")
    found = merkle.verified(merkle.manifest(docs, fields, [F.col("doc_id"), shown]), F.coalesce("row.shown", "leaf"))
    return found.select("row.doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified")


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, _table(spark, sf_dir, "benchmark"))
    items = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("row.doc_id", "n_words", "n_hit", "n_items", items, (F.col("n_hit") > 0).alias("contaminated"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_html_extraction": op2_html_extraction,
        "op3_chat_formatting": op3_chat_formatting,
        "op4_document_fingerprints": op4_document_fingerprints,
        "op5_mix_sources": op5_mix_sources,
        "op6_jaccard_join": op6_jaccard_join,
        "op7_pack_sequences": op7_pack_sequences,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_quality_rules": op9_quality_rules,
        "op10_warc_conversion": op10_warc_conversion,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_decontamination": op12_decontamination,
        "op13_hard_negatives": op13_hard_negatives,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return statements.oracle_sql()
