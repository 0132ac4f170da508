"""Suffix-array dedup: every byte covered by a `length`-byte string that an earlier document has, too.

A first exchange finds candidates: each window of 50 bytes is represented by the smallest of its 24-byte hashes (its
anchor), and only anchors that several documents hold go on. All windows of one anchor lie in a context of at most 76 bytes.
Contexts of equal anchors meet in one shard; those of its distinct contexts that hold a window whose hash comes twice there form
a text that is suffix-sorted by induced sorting (`suffix`). Neighbours in that order whose permuted common prefix has 50 bytes
are one string; the smallest id that holds it decides which of a chunk's windows are later copies.

An anchor with many different contexts is hot: its windows travel one by one, dealt out by a hash of their own 50 bytes, so that
different text around a common phrase doesn't meet in one shard. Equal windows have the same anchor, hence the same rule and shard.
To tell, each chunk adds to an anchor one byte of the hash of its least context and the number of its further contexts: different
bytes (from 128 on: chunks) plus further contexts stand for the different contexts. Text that thousands of documents hold
alike, with equal contexts throughout, stays in whole contexts. The rule chooses a route only, the result is the same.

Strings are compared as bytes, never by hash; hashes only choose shards and candidates. Inside a shard equal contexts are
one text with the smallest id, so a passage that a third of all documents hold is sorted once.

Defined results: a null text is empty; texts shorter than the string length are kept whole; equal ids are not smaller than each
other; a null id counts as larger than all others; an empty table gives an empty result. All other columns come back
unchanged in the struct column `row`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import spans
from .chunks import ASK_SCHEMA, LAST_ID, Chunk, Question, bucket_count, chunked, chunks_of, exchange, key48, rest_schema, shared_and_hot_keys
from .suffix import permuted_prefixes, suffix_array

LENGTH = 50
ANCHOR = 24
HOT = 512  # an anchor that is not hot has about as many different contexts at most, 39 kB of text


def _runs(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for every entry of each run."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


class _Contexts:
    """Anchors of a chunk; after the first answer those that several documents hold, with their contexts."""

    def __init__(self, chunk: Chunk, length: int, anchor: int, buckets: int):
        self.chunk, self.length, self.buckets = chunk, length, buckets
        n = len(chunk.data)
        self.sums = spans.prefix_sums(chunk.data)
        hashes = spans.every_hash(self.sums, anchor)
        at = spans.window_minima(hashes, length - anchor + 1)
        alive = np.zeros(len(at) + 1, bool)
        for_text = np.diff(chunk.offsets) >= length
        steps = np.zeros(n + 2, np.int32)
        np.add.at(steps, chunk.offsets[:-1][for_text], 1)
        np.add.at(steps, chunk.offsets[1:][for_text] - length + 1, -1)
        alive = np.cumsum(steps[: len(at)]) > 0
        windows = np.flatnonzero(alive)
        chosen = at[windows]
        heads = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]])) if len(chosen) else np.zeros(0, np.int64)
        self.first = windows[heads]
        self.count = np.diff(np.concatenate([heads, [len(chosen)]]))
        self.keys = key48(hashes[chosen[heads]])
        self.texts = np.searchsorted(chunk.offsets, self.first, side="right") - 1
        self.hot = np.zeros(len(self.first), bool)

    def anchors(self) -> Question:
        return Question(self.keys, self.chunk.ids[self.texts], self.buckets)

    def anchor_rows(self) -> pa.RecordBatch:
        """The anchors asked, each with a byte of its least context's hash and the number of its other contexts, 255 at most."""
        asked = self.anchors()
        whole = self.whole()
        order = np.lexsort((whole, asked.of_window))
        owner, ranked = asked.of_window[order], whole[order]
        heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
        new = np.concatenate([[False], (ranked[1:] != ranked[:-1]) & (owner[1:] == owner[:-1])])[: len(owner)]
        others = np.minimum(np.add.reduceat(new.astype(np.int64), heads), 255).astype(np.uint8) if len(heads) else np.zeros(0, np.uint8)
        marks = (ranked[heads] & np.uint64(255)).astype(np.uint8)
        lows = [marks[a:b].tobytes() + others[a:b].tobytes() for _, a, b in asked.parts()]
        rows = asked.rows(self.chunk.number, False)
        return rows.set_column(rows.schema.get_field_index("lows"), "lows", pa.array(lows, pa.binary()))

    def candidates(self) -> _Contexts:
        asked = self.anchors()
        answers = self.chunk.answers(1)
        go = asked.heard(answers)[asked.of_window]
        hot = asked.heard([(place, mask[len(mask) // 2 :]) for place, mask in answers])[asked.of_window][go]
        n = np.where(hot, self.count[go], 1)  # a hot anchor's windows go one by one
        self.hot = np.repeat(hot, n)
        self.first = np.repeat(self.first[go], n) + np.where(self.hot, _runs(n), 0)
        self.count = np.where(self.hot, 1, np.repeat(self.count[go], n))
        self.keys, self.texts = np.repeat(self.keys[go], n), np.repeat(self.texts[go], n)
        return self

    def whole(self) -> np.ndarray:
        """A hash of each context."""
        stops = self.first + self.count - 1 + self.length
        return spans.span_hash(self.sums, self.first, stops) ^ (self.keys * np.uint64(0x9E3779B97F4A7C15))

    def contexts(self) -> Question:
        whole = self.whole()
        return Question(whole, self.chunk.ids[self.texts], self.buckets, np.where(self.hot, whole, self.keys))

    def context_rows(self) -> pa.RecordBatch:
        asked = self.contexts()
        first, count = self.first[asked.sample], self.count[asked.sample]
        sizes = count - 1 + self.length
        found = list(asked.parts())
        raw = []
        for _, a, b in found:
            own = np.repeat(first[a:b], sizes[a:b]) + _runs(sizes[a:b])
            raw.append(count[a:b].astype(np.uint8).tobytes() + self.chunk.data[own].tobytes())
        return pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array([p for p, _, _ in found], pa.int32()),
                "chunk": pa.array([self.chunk.number] * len(found), pa.int64()),
                "keys": pa.array(raw, pa.binary()),
                "lows": pa.array([asked.lows[a:b].tobytes() for _, a, b in found], pa.binary()),
                "many": pa.array([b""] * len(found), pa.binary()),
            }
        )

    def repeated(self) -> np.ndarray:
        """Start of every window that an earlier document has, too."""
        asked = self.contexts()
        masks = asked.heard(self.chunk.answers(2), np.uint32)[asked.of_window]
        later = self.chunk.ids[self.texts] > asked.lows[asked.of_window]
        masks = np.where(later, np.uint32(0xFFFFFFFF), masks)
        at = _runs(self.count)
        flags = (np.repeat(masks, self.count) >> at.astype(np.uint32)) & np.uint32(1)
        return (np.repeat(self.first, self.count) + at)[flags.astype(bool)]


def _earlier(text: np.ndarray, edges: np.ndarray, windows: np.ndarray, holder: np.ndarray, asked: np.ndarray, least: np.ndarray, length: int) -> np.ndarray:
    """For every window asked: whether a context with a smaller id has the same bytes, by suffix sorting the contexts that hold one."""
    if not len(asked):
        return np.zeros(0, bool)
    own = np.unique(holder[asked])
    sizes = edges[own + 1] - edges[own]
    moved = np.cumsum(sizes) - sizes
    text = text[np.repeat(edges[own], sizes) + _runs(sizes)]
    begins = windows[asked] - edges[holder[asked]] + moved[np.searchsorted(own, holder[asked])]
    lows = np.full(len(text), LAST_ID)
    lows[begins] = least[holder[asked]]
    wanted = np.zeros(len(text), bool)
    wanted[begins] = True
    order = suffix_array(text)
    starts = order[wanted[order]]
    heads = np.flatnonzero(permuted_prefixes(text, starts, length)[starts] < length)
    lowest = np.minimum.reduceat(lows[starts], heads)
    earlier = np.zeros(len(text), bool)
    earlier[starts] = np.repeat(lowest, np.diff(np.concatenate([heads, [len(starts)]]))) < lows[starts]
    return earlier[begins]


def _sorted_shard(length: int, table: pa.Table) -> pa.Table:
    """Answer to each context asked, one bit per window: an id smaller than the asking chunk's has the same string."""
    lows = [np.frombuffer(x, np.int64) for x in table.column("lows").to_pylist()]
    sizes = [len(x) for x in lows]
    raw = table.column("keys").to_pylist()
    counts = np.concatenate([np.frombuffer(x[:n], np.uint8) for x, n in zip(raw, sizes)]).astype(np.int64)
    body = np.concatenate([np.frombuffer(x[n:], np.uint8) for x, n in zip(raw, sizes)])
    low = np.concatenate(lows)
    ends = np.concatenate([[0], np.cumsum(counts - 1 + length)])
    contexts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(body.tobytes())])
    coded = contexts.dictionary_encode()
    which = coded.indices.to_numpy(zero_copy_only=False)
    n = len(coded.dictionary)
    least = np.full(n, LAST_ID)
    np.minimum.at(least, which, low)
    count = np.zeros(n, np.int64)
    count[which] = counts
    _, offsets, data = coded.dictionary.buffers()
    edges = np.frombuffer(offsets, np.int64)[coded.dictionary.offset : coded.dictionary.offset + n + 1]
    text = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]

    at = _runs(count)
    windows = np.repeat(edges[:-1], count) + at
    holder = np.repeat(np.arange(n), count)
    hashes = spans.span_hash(spans.prefix_sums(text), windows, windows + length)
    twice = spans.repeated(hashes)  # equal strings have equal hashes, so the others need no sorting
    earlier = np.zeros(len(windows), bool)
    earlier[twice] = _earlier(text, edges, windows, holder, twice, least, length)
    masks = np.zeros(n, np.uint32)
    np.bitwise_or.at(masks, holder[earlier], np.uint32(1) << at[earlier].astype(np.uint32))
    answer = np.where(low > least[which], np.uint32(0xFFFFFFFF), masks[which])
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    return pa.table(
        {
            "chunk": table.column("chunk").cast(pa.int64()),
            "bucket": table.column("bucket").cast(pa.int32()),
            "mask": pa.array([answer[a:b].astype(np.uint32).tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
        }
    )


def remove_copied_bytes(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, id_column: str = "doc_id", text_column: str = "text", hot: int = HOT) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans, kept (remaining bytes), and `row`, its other columns."""
    if not 0 < anchor <= length or length - anchor >= 32:
        raise ValueError("a context holds at most 32 windows: length - anchor must be 0 to 31")
    buckets = bucket_count(docs.sparkSession)
    packed = chunked(docs, id_column, text_column)

    def ask_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks_of(batches):
            yield _Contexts(chunk, length, anchor, buckets).anchor_rows()

    def ask_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks_of(batches):
            yield _Contexts(chunk, length, anchor, buckets).candidates().context_rows()

    known = exchange(packed.mapInArrow(ask_anchors, ASK_SCHEMA), lambda table: shared_and_hot_keys(hot, table), 1)
    asked = packed.join(known, "chunk", "left").mapInArrow(ask_contexts, ASK_SCHEMA)
    sorted_out = exchange(asked, lambda table: _sorted_shard(length, table), 2)
    rest = rest_schema(docs.withColumn(id_column, docs[id_column].cast("long")), text_column)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks_of(batches):
            found = _Contexts(chunk, length, anchor, buckets).candidates().repeated()
            n, size = len(chunk.ids), len(chunk.data)
            flags = np.zeros(size, bool)
            flags[found] = True
            gone = spans.covered(flags, length, size)
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            heads = chunk.offsets[:-1][chunk.offsets[:-1] < chunk.offsets[1:]]
            begins[heads] = gone[heads]  # a run does not cross documents
            removed = np.concatenate([[0], np.cumsum(gone)])
            runs = np.concatenate([[0], np.cumsum(begins)])
            a, b = chunk.offsets[:-1], chunk.offsets[1:]
            kept_ends = chunk.offsets - removed[chunk.offsets]
            kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(kept_ends.astype(np.int64).tobytes()), pa.py_buffer(chunk.data[~gone].tobytes())])
            others = chunk.rest()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(b - a, pa.int64()),
                    pa.array(removed[b] - removed[a], pa.int64()),
                    pa.array(runs[b] - runs[a], pa.int64()),
                    kept.cast(pa.binary()),
                    pa.StructArray.from_arrays(others.columns, fields=list(others.schema)),
                ],
                names=["n_bytes", "n_removed", "n_spans", "kept", "row"],
            )

    schema = T.StructType().add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary").add("row", rest)
    return packed.join(known, "chunk", "left").join(sorted_out, "chunk", "left").mapInArrow(finish, schema)
