"""Substring dedup by level-wise doubling: repeated word windows grow until only full windows are left.

A window is `length` words of one document. At level L (4, 8, ... and finally `length`) every window still
alive is represented by the smallest of the L-word hashes inside it; equal windows choose the same one. Only windows
whose representative occurs in several documents stay alive for the next level, of twice the length. At the last level the
representative is the window itself, and a word is removed if a window over it also starts in a document
with a smaller id. Hashes have 64 bits (48 on the levels that only look for candidates).

Defined results: a null text is empty; a document with fewer words than a window keeps all of them; rows with
equal ids are not smaller than each other and so never remove from each other; a null id counts as larger than
all others; an empty table gives an empty result. Every input row gives one output row, and all its
other columns come back unchanged in the struct column `row`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import spans
from .chunks import ASK_SCHEMA, Chunk, Question, bucket_count, chunked, chunks_of, earlier_elsewhere, exchange, key48, rest_schema, shared_keys

LENGTH = 13


def levels(length: int) -> list[int]:
    """4, 8, 16 ... below the window length, then the length itself."""
    found, step = [], 4
    while step < length:
        found.append(step)
        step *= 2
    return [*found, length]


class _Windows:
    """Windows of a chunk that are alive after the answers so far."""

    def __init__(self, chunk: Chunk, length: int, buckets: int):
        self.chunk, self.length, self.buckets = chunk, length, buckets
        self.starts, self.stops, self.texts = spans.word_spans(chunk.data, chunk.offsets)
        self.words = spans.span_hash(spans.prefix_sums(chunk.data), self.starts, self.stops)
        self.alive = np.flatnonzero(spans.window_texts(self.texts, length))

    def question(self, level: int) -> Question:
        grams = spans.combine(self.words, level)
        if level < self.length:
            grams = key48(grams[spans.window_minima(grams, self.length - level + 1)])
        return Question(grams[self.alive], self.chunk.ids[self.texts[self.alive]], self.buckets)

    def narrowed(self, upto: list[int]) -> _Windows:
        for level in upto:
            asked = self.question(level)
            self.alive = self.alive[asked.heard(self.chunk.answers(level))[asked.of_window]]
        return self

    def repeated(self) -> np.ndarray:
        """Start of every window that an earlier document has, too."""
        asked = self.question(self.length)
        elsewhere = asked.heard(self.chunk.answers(self.length))
        later = self.chunk.ids[self.texts[self.alive]] > asked.lows[asked.of_window]
        return self.alive[later | elsewhere[asked.of_window]]


def joined_words(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, texts: np.ndarray, n_texts: int) -> pa.Array:
    """The given words of every text, joined by one space."""
    sizes = stops - starts + 1
    total = int(sizes.sum())
    ends = np.cumsum(sizes)
    source = np.arange(total) + np.repeat(starts - (ends - sizes), sizes)
    source[ends - 1] = 0
    out = data[source] if total else np.zeros(0, np.uint8)
    out[ends - 1] = 32
    edges = np.concatenate([[0], ends])[np.searchsorted(texts, np.arange(n_texts + 1))]
    keep = np.ones(total, bool)
    last = edges[1:][edges[1:] > edges[:-1]] - 1  # no space after the last word of a text
    keep[last] = False
    dropped = np.concatenate([[0], np.cumsum(~keep)])
    offsets = edges - dropped[edges]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), n_texts, [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(out[keep].tobytes())]).cast(pa.large_string()).cast(pa.string())


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: n_words, n_removed, kept (remaining words joined by one space), text, and `row`, its other columns."""
    steps = levels(length)
    buckets = bucket_count(docs.sparkSession)
    packed = chunked(docs, id_column, text_column)
    known: list[DataFrame] = []

    def answered() -> DataFrame:
        df = packed
        for answer in known:
            df = df.join(answer, "chunk", "left")
        return df

    for i, level in enumerate(steps):
        last = level == length

        def ask(batches: Iterator[pa.RecordBatch], level: int = level, before: list[int] = steps[:i], last: bool = last) -> Iterator[pa.RecordBatch]:
            for chunk in chunks_of(batches):
                yield _Windows(chunk, length, buckets).narrowed(before).question(level).rows(chunk.number, last)

        asked = answered().mapInArrow(ask, ASK_SCHEMA)
        known.append(exchange(asked, earlier_elsewhere if last else shared_keys, level))

    rest = rest_schema(docs.withColumn(id_column, docs[id_column].cast("long")), text_column)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks_of(batches):
            w = _Windows(chunk, length, buckets).narrowed(steps[:-1])
            flags = np.zeros(len(w.starts), bool)
            flags[w.repeated()] = True
            gone = spans.covered(flags, length, len(w.starts))
            n, kept = len(chunk.ids), ~gone
            text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(chunk.row["ends"]), pa.py_buffer(chunk.data.tobytes())])
            others = chunk.rest()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(spans.per_text(w.texts, n), pa.int64()),
                    pa.array(spans.per_text(w.texts, n, gone), pa.int64()),
                    joined_words(chunk.data, w.starts[kept], w.stops[kept], w.texts[kept], n),
                    text.cast(pa.large_string()).cast(pa.string()),
                    pa.StructArray.from_arrays(others.columns, fields=list(others.schema)),
                ],
                names=["n_words", "n_removed", "kept", "text", "row"],
            )

    schema = T.StructType().add("n_words", "long").add("n_removed", "long").add("kept", "string").add("text", "string").add("row", rest)
    return answered().mapInArrow(finish, schema)
