"""Texts packed into compressed chunks, and a compact question-and-answer exchange between them.

Finding what occurs in several documents needs every window of the corpus to meet its equals. A chunk
(about a megabyte of whole texts) asks about its distinct window hashes, dealt out by hash into buckets;
a bucket compares what all chunks ask and answers one bit per hash, in the order asked. A hash that a third of
all documents hold is thus asked once per chunk. The chunks themselves are shuffled once: later steps of
the same plan reuse that exchange.

Recovery: every step is a deterministic function of its input partition, so Spark can recompute lost parts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import spans

CHUNK_SCHEMA = "chunk long, ids binary, nulls binary, ends binary, body binary, rest binary"
ASK_SCHEMA = "bucket int, chunk long, keys binary, lows binary, many binary"
LAST_ID = np.iinfo(np.int64).max  # stands for a null id: after all others


def bucket_count(spark: SparkSession) -> int:
    """Buckets of an exchange; follows the shuffle partitions, which a cluster sets by its data."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def rest_schema(docs: DataFrame, text_column: str) -> T.StructType:
    return T.StructType([f for f in docs.schema.fields if f.name != text_column])


def chunked(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Whole texts with their ids and all other columns, in chunks dealt out by chunk number."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, squeeze = TaskContext.get().partitionId() << 33, zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for rows, data, offsets in spans.slices(batch, text_column):
                ids = rows.column(rows.schema.get_field_index(id_column))
                nulls = np.asarray(ids.is_null(), dtype=bool)
                numbers = np.where(nulls, LAST_ID, ids.fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64)
                rest = rows.drop_columns([text_column])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rest.schema) as writer:
                    writer.write_batch(rest)
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": pa.array([first], pa.int64()),
                        "ids": pa.array([numbers.tobytes()], pa.binary()),
                        "nulls": pa.array([np.packbits(nulls).tobytes()], pa.binary()),
                        "ends": pa.array([offsets.astype(np.int64).tobytes()], pa.binary()),
                        "body": pa.array([squeeze.compress(data.tobytes())], pa.binary()),
                        "rest": pa.array([squeeze.compress(sink.getvalue().to_pybytes())], pa.binary()),
                    }
                )
                first += 1

    typed = docs.withColumn(id_column, F.col(id_column).cast("long")).withColumn(text_column, F.col(text_column).cast("string"))
    return typed.mapInArrow(pack, CHUNK_SCHEMA).repartition("chunk")


class Chunk:
    """One chunk as arrays: ids and offsets of its texts, their bytes, the answers it has had so far."""

    def __init__(self, row: dict):
        self.number = row["chunk"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.offsets = np.frombuffer(row["ends"], np.int64)
        size = int(self.offsets[-1])
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["body"], max_output_size=size) if size else b"", np.uint8)
        self.row = row

    def rest(self) -> pa.RecordBatch:
        raw = zstandard.ZstdDecompressor().decompress(self.row["rest"], max_output_size=1 << 31)
        return pa.ipc.open_stream(raw).read_next_batch()

    def answers(self, level: int) -> list[tuple[int, bytes]]:
        return sorted((x["bucket"], x["mask"]) for x in self.row.get(f"answer{level}") or [])


def chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Chunk(batch.slice(i, 1).to_pylist()[0])


class Question:
    """The distinct keys of some windows of a chunk, ordered by bucket and key, with the lowest id that has each."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, buckets: int, dealt_by: np.ndarray | None = None):
        """`dealt_by` chooses the bucket where it isn't the key itself; equal keys must have it equal."""
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        heads = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(keys) else np.zeros(0, np.int64)
        distinct = ranked[heads]
        place = ((distinct if dealt_by is None else dealt_by[order][heads]) % np.uint64(buckets)).astype(np.int32)
        by_bucket = np.argsort(place, kind="stable")
        self.keys, self.place = distinct[by_bucket], place[by_bucket]
        if len(keys):
            own = ids[order]
            self.lows = np.minimum.reduceat(own, heads)[by_bucket]
            self.many = (np.maximum.reduceat(own, heads)[by_bucket]) != self.lows
        else:
            self.lows, self.many = np.zeros(0, np.int64), np.zeros(0, bool)
        self.sample = order[heads][by_bucket]  # for every key: one window that has it
        where = np.empty(len(distinct), np.int64)
        where[by_bucket] = np.arange(len(distinct))
        self.of_window = np.empty(len(keys), np.int64)  # for every window given: the place of its key
        self.of_window[order] = where[np.cumsum(np.concatenate([[True], ranked[1:] != ranked[:-1]])) - 1] if len(keys) else 0

    def parts(self) -> Iterator[tuple[int, int, int]]:
        edges = np.flatnonzero(np.concatenate([[True], self.place[1:] != self.place[:-1], [True]])) if len(self.place) else []
        for a, b in zip(edges[:-1], edges[1:]):
            yield int(self.place[a]), int(a), int(b)

    def rows(self, chunk: int, with_lows: bool) -> pa.RecordBatch:
        found = list(self.parts())
        return pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array([p for p, _, _ in found], pa.int32()),
                "chunk": pa.array([chunk] * len(found), pa.int64()),
                "keys": pa.array([self.keys[a:b].tobytes() if with_lows else self.keys[a:b].view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for _, a, b in found], pa.binary()),
                "lows": pa.array([self.lows[a:b].tobytes() if with_lows else b"" for _, a, b in found], pa.binary()),
                "many": pa.array([np.packbits(self.many[a:b]).tobytes() for _, a, b in found], pa.binary()),
            }
        )

    def heard(self, answers: list[tuple[int, bytes]], dtype: type = bool) -> np.ndarray:
        """What was answered to every key asked: a bit, or a number of the given type."""
        found = np.zeros(len(self.keys), dtype)
        masks = dict(answers)
        for place, a, b in self.parts():
            if place in masks:
                raw = np.frombuffer(masks[place], np.uint8)
                found[a:b] = np.unpackbits(raw, count=b - a).astype(bool) if dtype is bool else raw.view(dtype)
        return found


def key48(hashes: np.ndarray) -> np.ndarray:
    """Six bytes of a hash: enough to look for candidates, which a later step compares in full."""
    return hashes >> np.uint64(16)


def _asked(table: pa.Table) -> tuple[list[int], list[int], np.ndarray, list[bytes]]:
    raw, many = table.column("keys").to_pylist(), table.column("many").to_pylist()
    return table.column("chunk").to_pylist(), table.column("bucket").to_pylist(), raw, many


def _answered(chunks: list[int], buckets: list[int], sizes: list[int], bits: np.ndarray) -> pa.Table:
    masks, at = [], 0
    for n in sizes:
        masks.append(np.packbits(bits[at : at + n]).tobytes())
        at += n
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "bucket": pa.array(buckets, pa.int32()), "mask": pa.array(masks, pa.binary())})


def shared_keys(table: pa.Table) -> pa.Table:
    """Answer whether a key is held by more than one id (a superset: two chunks that ask count as two)."""
    chunks, buckets, raw, many = _asked(table)
    sizes = [len(x) // 6 for x in raw]
    wide = np.zeros((sum(sizes), 8), np.uint8)
    wide[:, :6] = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, 6)
    keys = wide.view(np.uint64).ravel()
    flags = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=n) for m, n in zip(many, sizes)] or [np.zeros(0, np.uint8)]).astype(bool)
    _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
    shared = counts > 1
    shared[which[flags]] = True
    return _answered(chunks, buckets, sizes, shared[which])


def shared_and_hot_keys(hot: int, table: pa.Table) -> pa.Table:
    """Answer as shared_keys does, and behind it in as many bytes whether the key is hot: `lows` holds a mark of one byte and a number
    for each key, and different marks (128 or more: chunks that ask) plus the sum of the numbers are `hot` or more."""
    chunks, buckets, raw, many = _asked(table)
    shared = shared_keys(table).column("mask").to_pylist()
    sizes = [len(x) // 6 for x in raw]
    wide = np.zeros((sum(sizes), 8), np.uint8)
    wide[:, :6] = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, 6)
    lows = table.column("lows").to_pylist()
    marks = np.frombuffer(b"".join(x[:n] for x, n in zip(lows, sizes)), np.uint8)
    numbers = np.frombuffer(b"".join(x[n:] for x, n in zip(lows, sizes)), np.uint8)
    distinct, which = np.unique(wide.view(np.uint64).ravel(), return_inverse=True)
    pairs = np.unique(which.astype(np.int64) * 256 + marks)
    told = np.bincount(pairs >> 8, minlength=len(distinct))
    different = np.where(told < 128, told, np.bincount(which, minlength=len(distinct))) + np.bincount(which, numbers, minlength=len(distinct))
    hots = _answered(chunks, buckets, sizes, (different >= hot)[which]).column("mask").to_pylist()
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "bucket": pa.array(buckets, pa.int32()), "mask": pa.array([a + b for a, b in zip(shared, hots)], pa.binary())})


def holder_classes(table: pa.Table) -> pa.Table:
    """Answer how many hold the key, as 0 for one and otherwise 1 + log2, rounded down."""
    chunks, buckets, raw, many = _asked(table)
    sizes = [len(x) // 6 for x in raw]
    wide = np.zeros((sum(sizes), 8), np.uint8)
    wide[:, :6] = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, 6)
    flags = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=n) for m, n in zip(many, sizes)] or [np.zeros(0, np.uint8)])
    _, which = np.unique(wide.view(np.uint64).ravel(), return_inverse=True)
    holders = np.bincount(which, 1 + flags) if len(which) else np.zeros(0)
    classes = np.where(holders > 1, 1 + np.floor(np.log2(np.maximum(holders, 1))), 0).astype(np.uint8)[which]
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    masks = [classes[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "bucket": pa.array(buckets, pa.int32()), "mask": pa.array(masks, pa.binary())})


def earlier_elsewhere(table: pa.Table) -> pa.Table:
    """Answer whether another chunk holds the key under an id smaller than the asking chunk's smallest."""
    chunks, buckets, raw, _ = _asked(table)
    sizes = [len(x) // 8 for x in raw]
    keys = np.frombuffer(b"".join(raw), np.uint64)
    lows = np.frombuffer(b"".join(table.column("lows").to_pylist()), np.int64)
    _, which = np.unique(keys, return_inverse=True)
    least = np.full(which.max() + 1 if len(which) else 0, LAST_ID)
    np.minimum.at(least, which, lows)
    return _answered(chunks, buckets, sizes, least[which] < lows)


def exchange(asked: DataFrame, reply: Callable[[pa.Table], pa.Table], level: int) -> DataFrame:
    """Answers of one step, one row per chunk (at most one entry per bucket)."""
    return (
        asked.groupBy("bucket")
        .applyInArrow(reply, "chunk long, bucket int, mask binary")
        .groupBy("chunk")
        .agg(F.collect_list(F.struct("bucket", "mask")).alias(f"answer{level}"))
    )
