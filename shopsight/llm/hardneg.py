"""Hard-negative mining by a vertical scan (BOND): dimensions are columns, read where an anchor is strongest first.

Rows are stored in blocks of BLOCK, one column of whole numbers per dimension, with the least and the largest value of each. An
anchor adds up the columns in the descending order of its own magnitudes. What the unread dimensions can still add lies between
two sums that follow from these least and largest values, so every candidate has a lower and an upper bound; a bitmap
keeps those whose bounds still allow a place among the best, and shrinks until their exact scores decide. Bounds found in one block
prune the next.

First every anchor gets its positives, the best rows of its own label. Each positive then spans a window of scores, a share
of its own, in which the best rows of other labels are its hard negatives.

Anchors are a stated query set: they meet all rows block by block, in chunks of about CHUNK anchors, on a grid of (chunk, slice of
the blocks), so that neither side is ever whole in one task. Both sides are dealt out as rows of one table, the anchors of a cell before its
blocks, so nothing passes through the driver and an anchor is sent once per slice. (Copies of the anchors for every slice are far larger than
the table they come from, by whose size Spark would choose to broadcast them.) A task keeps a few rows per anchor; these are merged by a top-k per anchor. Labels play no part
in the dealing, so a label that most rows have is no hot key. Equal vectors are equal candidates and never pair up beyond the top-k.

Defined results: a row with a null label, a null vector, or a null or non-finite component takes no part. A component x becomes
floor(256 * x), beyond +-2**26 that number. Shorter vectors count as 0 where they end; an empty one scores 0. A null id is no
anchor and comes last among ties. Rows with equal ids are rows of their own: an anchor leaves out itself only, and anchors with
equal ids answer one by one. Anchors without positives, and positives without negatives, give no rows. An empty table gives an
empty result. Other columns are not read. Scores are exact 64-bit numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import scratch

BLOCK = 4096
CHUNK = 4096
SLICE = 16  # blocks to a slice at most; fewer where there would be fewer tasks than shuffle partitions
STEP = 16  # dimensions read between two looks at the bounds
FEW = 64  # candidates that are simply scored
SCALE, LARGEST = 256, 1 << 26
LAST_ID = np.iinfo(np.int64).max  # stands for a null id
BLOCK_SCHEMA = "first long, ids binary, nulls binary, labels binary, columns array<binary>, low binary, high binary"
ANCHOR_SCHEMA = "anchor long, anchor_id long, label long, vector binary"
BEST_SCHEMA = "anchor long, place int, score long, vec_id long"
#: A positive_score p admits negative scores s with 30 p <= 100 s <= 90 p.
FROM, UPTO, OF = 30, 90, 100


def _numbers(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as a matrix of whole numbers, padded with 0; which rows take part."""
    lists = batch.column(batch.schema.get_field_index(column))
    lists = lists.cast(pa.large_list(pa.float64()))
    sizes = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
    flat = lists.flatten()  # null lists have no values here
    values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    good = np.asarray(lists.is_valid()).copy()
    good[row[~np.isfinite(values)]] = False
    values = np.where(np.isfinite(values), values, 0.0)
    matrix = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    within = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    with np.errstate(over="ignore"):
        matrix[row, within] = np.clip(np.floor(values * SCALE), -LARGEST, LARGEST).astype(np.int64)
    return matrix, good


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, label, vector) to blocks of columns."""
    first = TaskContext.get().partitionId() << 33
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            matrix, good = _numbers(part, "vector")
            good &= np.asarray(part.column(1).is_valid())
            matrix = matrix[good].astype(np.int32)
            if not len(matrix):
                continue
            ids = part.column(0).filter(pa.array(good))
            labels = np.asarray(part.column(1).filter(pa.array(good))).astype(np.int64)
            columns = [c.tobytes() for c in np.ascontiguousarray(matrix.T)]
            nulls = np.packbits(np.asarray(ids.is_null(), dtype=bool))
            numbers = np.asarray(ids.fill_null(LAST_ID)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([first], pa.int64()), pa.array([numbers.tobytes()], pa.binary()), pa.array([nulls.tobytes()], pa.binary()),
                    pa.array([labels.tobytes()], pa.binary()), pa.array([columns], pa.list_(pa.binary())),
                    pa.array([matrix.min(0).astype(np.int64).tobytes()], pa.binary()), pa.array([matrix.max(0).astype(np.int64).tobytes()], pa.binary()),
                ],
                names=["first", "ids", "nulls", "labels", "columns", "low", "high"],
            )
            first += len(matrix)


class _Block:
    """A block as arrays: `columns` has a row per dimension."""

    def __init__(self, row: dict):
        self.first = row["first"]
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.low, self.high = np.frombuffer(row["low"], np.int64), np.frombuffer(row["high"], np.int64)
        self.columns = np.frombuffer(b"".join(row["columns"]), np.int32).reshape(len(self.low), len(self.ids))
        self.wide = self.columns.astype(np.float64)

    def nulls(self, row: dict) -> np.ndarray:
        return np.unpackbits(np.frombuffer(row["nulls"], np.uint8), count=len(self.ids)).astype(bool)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (first, at) of blocks as anchors."""
    for batch in batches:
        for row in batch.to_pylist():
            block = _Block(row)
            at = np.asarray(row["at"], np.int64)
            vectors = np.ascontiguousarray(block.columns[:, at].T)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.first + at, pa.int64()), pa.array(block.ids[at], pa.int64()), pa.array(block.labels[at], pa.int64()), pa.array([v.tobytes() for v in vectors], pa.binary())],
                names=["anchor", "anchor_id", "label", "vector"],
            )


class _Reading:
    """One anchor against one block: candidates with their bounds, as dimension after dimension is read."""

    def __init__(self, vector: np.ndarray, block: _Block):
        n = min(len(vector), len(block.low))
        own = vector[:n].astype(np.int64)
        order = np.argsort(-np.abs(own), kind="stable")
        self.order = order[: np.count_nonzero(own)]
        ends = own[self.order, None] * np.stack([block.low[self.order], block.high[self.order]], 1)
        self.exact_in_floats = float(np.abs(ends).max(1).sum()) < 2.0**53 if len(ends) else True
        tail = lambda x: np.concatenate([np.cumsum(x[::-1])[::-1], [0]])
        self.least, self.most = tail(ends.min(1)), tail(ends.max(1))
        self.own, self.columns = (own.astype(np.float64), block.wide) if self.exact_in_floats else (own, block.columns)

    def _read(self, dims: np.ndarray, alive: np.ndarray) -> np.ndarray:
        most = 2 * len(alive) > self.columns.shape[1]  # whole columns are read faster than most of their entries
        part = self.columns[dims] if most else self.columns[np.ix_(dims, alive)]
        sums = (self.own[dims] @ part).astype(np.int64) if self.exact_in_floats else self.own[dims] @ part.astype(np.int64)
        return sums[alive] if most else sums

    def scores(self, alive: np.ndarray, allowed) -> tuple[np.ndarray, np.ndarray]:
        """Candidates left and their scores; `allowed(low, high)` tells which bounds still may matter."""
        total, read = np.zeros(len(alive), np.int64), 0
        while read < len(self.order) and len(alive):
            step = len(self.order) - read if len(alive) <= FEW else STEP
            total = total + self._read(self.order[read : read + step], alive)
            read = min(read + step, len(self.order))
            keep = allowed(total + self.least[read], total + self.most[read])
            alive, total = alive[keep], total[keep]
        return alive, total


def _best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Positions of the n first: higher scores, then smaller ids."""
    if len(scores) > 4 * n:
        least = np.partition(scores, len(scores) - n)[len(scores) - n]
        few = np.flatnonzero(scores >= least)
        return few[np.lexsort((ids[few], -scores[few]))[:n]]
    return np.lexsort((ids, -scores))[:n]


class _Top:
    """The n best rows so far."""

    def __init__(self, n: int):
        self.n = n
        self.scores, self.ids, self.nulls = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def bound(self) -> int | None:
        return int(self.scores[-1]) if len(self.scores) == self.n else None

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        scores, ids, nulls = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.nulls, nulls)))
        best = _best(scores, ids, self.n)
        self.scores, self.ids, self.nulls = scores[best], ids[best], nulls[best]


def _positives(anchor: dict, block: _Block, nulls: np.ndarray, tops: list[_Top]) -> None:
    top = tops[0]
    same = block.labels == anchor["label"]
    own = anchor["anchor"] - block.first
    if 0 <= own < len(same):
        same[own] = False

    def allowed(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        bound = top.bound()
        if len(low) > top.n:
            sure = int(np.partition(low, len(low) - top.n)[len(low) - top.n])
            bound = sure if bound is None else max(bound, sure)
        return high >= bound if bound is not None else np.ones(len(low), bool)

    alive, scores = _Reading(anchor["numbers"], block).scores(np.flatnonzero(same), allowed)
    top.add(scores, block.ids[alive], nulls[alive])


def _negatives(anchor: dict, block: _Block, nulls: np.ndarray, tops: list[_Top]) -> None:
    windows = np.asarray([(-(-FROM * p // OF), UPTO * p // OF) for p in anchor["scores"]], np.int64)

    def allowed(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(low), bool)
        for (least, most), top in zip(windows, tops):
            if least > most:
                continue
            sure, bound = low[(low >= least) & (high <= most)], top.bound()
            if len(sure) >= top.n:
                least = max(least, np.partition(sure, len(sure) - top.n)[len(sure) - top.n])
            if bound is not None:
                least = max(least, bound)
            keep |= (high >= least) & (low <= most)
        return keep

    alive, scores = _Reading(anchor["numbers"], block).scores(np.flatnonzero(block.labels != anchor["label"]), allowed)
    for (least, most), top in zip(windows, tops):
        inside = (scores >= least) & (scores <= most)
        if inside.any():
            top.add(scores[inside], block.ids[alive[inside]], nulls[alive[inside]])


def _scan(best: int, visit, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every chunk of anchors against the blocks of a slice, which follow it; emits the best rows per anchor and place."""
    state: dict[int, list[_Top]] = {}
    anchors: list[dict] = []
    at = None

    def found() -> pa.RecordBatch:
        rows = [(no, place, top) for no, tops in state.items() for place, top in enumerate(tops) if len(top.ids)]
        sizes = [len(t.ids) for _, _, t in rows]
        joined = lambda name, kind: np.concatenate([getattr(t, name) for _, _, t in rows]) if rows else np.zeros(0, kind)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.asarray([no for no, _, _ in rows], np.int64), sizes)),
                pa.array(np.repeat(np.asarray([p for _, p, _ in rows], np.int32), sizes)),
                pa.array(joined("scores", np.int64), pa.int64()),
                pa.array(joined("ids", np.int64), pa.int64(), mask=joined("nulls", bool)),
            ],
            names=["anchor", "place", "score", "vec_id"],
        )

    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if (row["chunk"], row["slice"]) != at:
                if state:
                    yield found()
                at, anchors, state = (row["chunk"], row["slice"]), [], {}
            if row["first"] is None:
                anchors.append({"anchor": row["anchor"], "label": row["label"], "scores": row["scores"], "numbers": np.frombuffer(row["vector"], np.int32)})
                state[row["anchor"]] = [_Top(best) for _ in (row["scores"] or [None])]
                continue
            block = _Block(row)
            nulls = block.nulls(row)
            for a in anchors:
                visit(a, block, nulls, state[a["anchor"]])
    if state:
        yield found()


def _grid(blocks: DataFrame, n_blocks: int, anchors: DataFrame, n_anchors: int, best: int, visit) -> DataFrame:
    """The best rows per anchor and place over all blocks."""
    partitions = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(1, -(-n_anchors // CHUNK))
    slices = max(1, -(-n_blocks // min(SLICE, max(1, chunks * n_blocks // (4 * partitions)))))
    tasks = min(chunks * slices, 16 * partitions)
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asking = anchors.select(F.pmod(F.xxhash64("anchor"), F.lit(chunks)).cast("int").alias("chunk"), numbers(slices).alias("slice"), "anchor", "label", "vector", "scores")
    dealt = blocks.select("*", F.pmod(F.xxhash64("first"), F.lit(slices)).cast("int").alias("slice"), numbers(chunks).alias("chunk"))
    met = dealt.unionByName(asking, allowMissingColumns=True).repartition(tasks, "chunk", "slice").sortWithinPartitions("chunk", "slice", F.col("first").asc_nulls_first())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _scan(best, visit, batches)

    found = met.mapInArrow(scan, BEST_SCHEMA)
    order = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10,
    id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), the hardest negatives first."""
    typed = rows.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("long").alias("label"), F.col(vector_column).cast("array<double>").alias("vector"))
    blocks = scratch.written(typed.mapInArrow(_blocks, BLOCK_SCHEMA), "blocks")
    anchors = scratch.written(_chosen(blocks, is_anchor, id_column), "anchors")
    n_blocks, n_anchors = blocks.count(), anchors.count()
    none = anchors.withColumn("scores", F.lit(None).cast("array<long>"))
    best = scratch.written(_grid(blocks, n_blocks, none, n_anchors, positives, _positives), "positives")
    scores = best.groupBy("anchor").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("scores"))
    asking = scratch.written(anchors.join(scores, "anchor"), "asking")
    worst = _grid(blocks, n_blocks, asking, n_anchors, negatives, _negatives)
    worst = worst.select("anchor", (F.col("place") + 1).alias("nth"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = best.select("anchor", F.col("rank").alias("nth"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = anchors.select("anchor", "anchor_id").join(pairs, "anchor").join(worst, ["anchor", "nth"])
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _chosen(blocks: DataFrame, is_anchor: Column, id_column: str) -> DataFrame:
    """Rows of the blocks that are anchors; a null id is none."""

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                numbers = np.frombuffer(row["ids"], np.int64)
                known = ~np.unpackbits(np.frombuffer(row["nulls"], np.uint8), count=len(numbers)).astype(bool)
                at = np.flatnonzero(known)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), row["first"]), pa.int64()), pa.array(at, pa.int64()), pa.array(numbers[at], pa.int64())], names=["first", "at", id_column])

    wanted = blocks.select("first", "ids", "nulls").mapInArrow(ids, f"first long, at long, `{id_column}` long").where(is_anchor)
    per_block = wanted.groupBy("first").agg(F.sort_array(F.collect_list("at")).alias("at"))  # a block at most
    return blocks.join(per_block, "first").mapInArrow(_anchors, ANCHOR_SCHEMA)
