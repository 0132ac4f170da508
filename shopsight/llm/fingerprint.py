"""Document fingerprints: the k smallest hashes of a text's distinct word shingles (bottom-k sketch).

Sketches of parts merge into that of their union by keeping the k smallest of both. Two sketches estimate resemblance (share of the
union's k smallest that both hold), containment and the number of distinct shingles; sets of at most k are exact.

Defined results: a null text is empty; with fewer words than a shingle the whole sequence is the only one; no words give an empty
fingerprint; two empty ones are alike (1.0), one empty and one not are not (0.0). Documents follow each other by descending id, null
ids last, rows with equal ids by their text; after the last comes the first.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from . import spans

WORDS = 5
SIZE = 128
FIRST_ID = np.iinfo(np.int64).min


def shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending within each text, and the text of each."""
    n = len(offsets) - 1
    starts, stops, texts = spans.word_spans(data, offsets)
    hashes = spans.span_hash(spans.prefix_sums(data), starts, stops)
    grams, inside = spans.combine(hashes, words), spans.window_texts(texts, words)
    found, owner = [grams[inside]], [texts[: len(grams)][inside]]
    counts = spans.per_text(texts, n)
    firsts = np.cumsum(counts) - counts
    for i in np.flatnonzero((counts > 0) & (counts < words)):
        found.append(spans.combine(hashes[firsts[i] : firsts[i] + counts[i]], int(counts[i])))
        owner.append(np.array([i]))
    tokens, texts = np.concatenate(found), np.concatenate(owner)
    order = np.lexsort((tokens, texts))
    tokens, texts = tokens[order], texts[order]
    first = np.ones(len(tokens), bool)
    first[1:] = (tokens[1:] != tokens[:-1]) | (texts[1:] != texts[:-1])
    return tokens[first], texts[first]


def sketches(texts: list[bytes], words: int = WORDS, size: int = SIZE) -> list[np.ndarray]:
    """Sketch of every text: its smallest hashes in ascending order."""
    batch = pa.RecordBatch.from_pydict({"t": pa.array(texts, pa.large_binary()).view(pa.large_string())})
    found = []
    for rows, data, offsets in spans.slices(batch, "t"):
        tokens, owner = shingles(data, offsets, words)
        edges = np.searchsorted(owner, np.arange(rows.num_rows + 1))
        found += [tokens[a : min(b, a + size)] for a, b in zip(edges[:-1], edges[1:])]
    return found


def merge(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> np.ndarray:
    return np.union1d(a, b)[:size]


def resemblance(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    union = merge(a, b, size)
    if not len(union):
        return 1.0
    return float(np.isin(union, np.intersect1d(a, b, assume_unique=True), assume_unique=True).sum() / len(union))


def distinct_count(a: np.ndarray, size: int = SIZE) -> float:
    return float(len(a)) if len(a) < size else (size - 1) / ((float(a[-1]) + 1) / 2.0**64)


def containment(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Share of a's shingles that b has, too."""
    if not len(a):
        return 1.0
    both = resemblance(a, b, size) * distinct_count(merge(a, b, size), size)
    return min(1.0, both / distinct_count(a, size))


def as_text(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)


def merge_parts(parts: DataFrame, keys: list[str], column: str = "fingerprint", size: int = SIZE, salts: int = 64) -> DataFrame:
    """One fingerprint per key from those of its parts; a hot key is first merged in `salts` groups."""

    def fold(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, np.ndarray] = {}
        for batch in groups:
            for row in batch.to_pylist():
                key = tuple(row[k] for k in keys)
                best[key] = merge(best.get(key, np.zeros(0, np.uint64)), from_text(row[column] or ""), size)
                if len(best) >= 10_000:
                    yield rows(best)
                    best = {}
        if best:
            yield rows(best)

    def rows(best: dict) -> pa.RecordBatch:
        table = pa.Table.from_pylist([dict(zip(keys, key)) | {column: as_text(s)} for key, s in best.items()], schema=arrow)
        return table.combine_chunks().to_batches()[0]

    some = parts.select(*keys, column)
    arrow = to_arrow_schema(some.schema)
    salted = some.withColumn("_salt", F.pmod(F.xxhash64(column), F.lit(salts)))
    first = salted.repartition(*keys, "_salt").sortWithinPartitions(*keys).select(*keys, column).mapInArrow(fold, some.schema)
    # sorted by key, a key's parts follow each other; what a full dictionary has split is merged by the last step
    last = first.repartition(*keys).sortWithinPartitions(*keys)

    def close(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, np.zeros(0, np.uint64)
        done: list[tuple[tuple, np.ndarray]] = []
        for batch in groups:
            for row in batch.to_pylist():
                key = tuple(row[k] for k in keys)
                if key != held and held is not None:
                    done.append((held, own))
                    own = np.zeros(0, np.uint64)
                held, own = key, merge(own, from_text(row[column] or ""), size)
            if done:
                yield rows(dict(done))
                done = []
        if held is not None:
            yield rows({held: own})

    return last.mapInArrow(close, some.schema)


def with_next(docs: DataFrame, words: int = WORDS, size: int = SIZE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness.

    The edited text has its last third replaced by the beginning of the next document. Texts are shuffled once, by id
    range; the first document of a range is sent to the range before it, too. Only the range bounds and each range's
    largest id pass through the driver: as many numbers as partitions.
    """
    spark = docs.sparkSession
    typed = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(int(FIRST_ID))).alias("id"), F.col(id_column).isNull().alias("no_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = 4 * ranges  # several ranges to a task even out the tasks
    bounds = np.array(sorted(set(typed.where("not no_id").approxQuantile("id", [i / pieces for i in range(1, pieces)], 0.25 / pieces))), dtype=np.float64)

    def place(ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(bounds, ids.astype(np.float64), side="right")

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            own = place(ids)
            found = np.unique(own)
            yield pa.RecordBatch.from_pydict({"range": pa.array(found, pa.int64()), "id": pa.array([int(ids[own == r].max()) for r in found], pa.int64())})

    top = {r["range"]: r["id"] for r in typed.select("id").mapInArrow(tops, "range long, id long").groupBy("range").agg(F.max("id").alias("id")).collect()}
    filled = sorted(top)
    reader = {r: filled[i + 1] if i + 1 < len(filled) else filled[0] for i, r in enumerate(filled)}  # who needs a range's first document

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            own = place(ids)
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(np.zeros(len(own), bool)), *batch.columns], names=["range", "guest", "id", "no_id", "text"])
            heads = np.flatnonzero([ids[i] == top[r] for i, r in enumerate(own)])
            if len(heads):
                some = batch.take(pa.array(heads))
                yield pa.RecordBatch.from_arrays([pa.array([reader[r] for r in own[heads]], pa.int64()), pa.array(np.ones(len(heads), bool)), *some.columns], names=["range", "guest", "id", "no_id", "text"])

    dealt = typed.mapInArrow(deal, "range long, guest boolean, id long, no_id boolean, text string")
    ordered = dealt.repartition(ranges, "range").sortWithinPartitions("range", "guest", F.desc("id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for part, _, _ in spans.slices(batch, "text", 4 << 20):
                held += part.to_pylist()
                yield judged(held)
                held = held[-1:]

    def judged(rows: list[dict]) -> pa.RecordBatch:
        """Results of all rows but the last, each followed by its next document."""
        pairs = [(a, b) for a, b in zip(rows[:-1], rows[1:]) if not a["guest"]]
        follow = [i for i, a in enumerate(rows[:-1]) if not a["guest"]]
        own = sketches([r["text"].encode() for r in rows], words, size)
        edited = []
        for a, b in pairs:
            cut = len(a["text"]) // 3
            edited.append((a["text"][: len(a["text"]) - cut] + b["text"][:cut]).encode())
        changed = sketches(edited, words, size)
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array([None if a["no_id"] else a["id"] for a, _ in pairs], pa.int64()),
                "n_chars": pa.array([len(a["text"]) for a, _ in pairs], pa.int64()),
                "edited_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in edited], pa.string()),
                "fingerprint": pa.array([as_text(own[i]) for i in follow], pa.string()),
                "edited_fingerprint": pa.array([as_text(s) for s in changed], pa.string()),
                "near_edited": pa.array([resemblance(own[i], s, size) for i, s in zip(follow, changed)], pa.float64()),
                "near_next": pa.array([resemblance(own[i], own[i + 1], size) for i in follow], pa.float64()),
            }
        )

    return ordered.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
