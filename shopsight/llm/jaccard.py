"""N-gram Jaccard join: documents whose word-shingle sets have a Jaccard similarity of 0.8 or more, as components.

1. Candidates. In the order of their hashes, two linked sets share tokens among their first ones (prefix filter). Chunks ask
   which of these tokens other sets hold too; a set that shares too few cannot be linked and goes no further. The others ask how
   many of them hold each of their tokens, and list their rarest shared tokens: as many as a linked set can't miss all of.
2. Stars. Equal sets are one node. For every listed token one holder, chosen by hash, is compared with all its holders; a second
   round chooses another for each token and leaves out what is connected. Signatures (below) are compared first, then sorted
   arrays exactly. This unites most copies with a number of pairs that is linear in the postings, however large a group is.
3. Tiles. What is left are pairs from different components under one token. Holders are dealt into tiles by size band (a factor
   of 1.25) and hash, and tiles of equal or neighbouring bands meet. A tile holds hashed bitmap signatures: the
   bits in which two differ bound their overlap from above. Pairs that pass are intersected exactly.

No link between different components is left out: every pair of linked sets shares a token that both list, so it is
compared in a star or a tile unless the two are already connected.

Tokens are 64-bit hashes of the shingles (48 bits of them inside the arrays that are intersected).

Defined results: a null or empty text has no shingles and is its own component; with fewer words than a shingle the whole
sequence is the only one; equal ids have one component; a null id counts as larger than all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans
from .chunks import ASK_SCHEMA, LAST_ID, Chunk, Question, bucket_count, chunked, chunks_of, exchange, holder_classes, key48, shared_keys
from .graph import components
from .scratch import written

WORDS = 5
PERCENT = 80
TILE = 1024
BAND = 1.25
NODE_SCHEMA = "doc_id long, n long, node long, tokens array<long>, bits binary, members binary"


def shingle_sets(chunk: Chunk, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a chunk's texts, ascending in each text, and the text of each."""
    data = spans.lower_ascii(chunk.data)
    starts, stops, texts = spans.word_spans(data, chunk.offsets)
    hashes = spans.span_hash(spans.prefix_sums(data), starts, stops)
    grams, inside = spans.combine(hashes, words), spans.window_texts(texts, words)
    found, owner = [grams[inside]], [texts[: len(grams)][inside]]
    counts = spans.per_text(texts, len(chunk.ids))
    firsts = np.cumsum(counts) - counts
    for short in range(1, words):  # the whole sequence is one shingle
        own = np.flatnonzero(counts == short)
        if len(own):
            whole = np.stack([hashes[firsts[own] + i] for i in range(short)])
            found.append(np.concatenate([spans.combine(whole[:, j], short) for j in range(len(own))]))
            owner.append(own)
    tokens, texts = np.concatenate(found), np.concatenate(owner)
    order = np.lexsort((tokens, texts))
    tokens, texts = tokens[order], texts[order]
    first = np.ones(len(tokens), bool)
    first[1:] = (tokens[1:] != tokens[:-1]) | (texts[1:] != texts[:-1])
    return tokens[first], texts[first]


class _Sets:
    def __init__(self, chunk: Chunk, words: int, percent: int, buckets: int):
        self.chunk, self.buckets = chunk, buckets
        self.tokens, self.texts = shingle_sets(chunk, words)
        self.n = spans.per_text(self.texts, len(chunk.ids))
        self.begin = np.cumsum(self.n) - self.n
        heads = self.begin[self.n > 0]
        node = np.zeros(len(chunk.ids), np.uint64)
        if len(heads):
            node[self.n > 0] = spans.mix(np.add.reduceat(spans.mix(self.tokens), heads) + self.n[self.n > 0].astype(np.uint64))
        self.nodes = node.view(np.int64)
        self.least = (percent * self.n + 99) // 100  # overlap that a link needs at least
        spare = np.maximum(1, self.n // 5)
        self.need = np.maximum(1, self.least // 5)
        place = np.arange(len(self.tokens)) - np.repeat(self.begin, self.n)
        self.asked = np.flatnonzero(place < np.repeat(self.n - self.least + spare, self.n))

    def question(self) -> Question:
        return Question(key48(self.tokens[self.asked]), self.nodes[self.texts[self.asked]], self.buckets)

    def suspects(self) -> np.ndarray:
        """Which texts share enough of the tokens asked first."""
        asked = self.question()
        shared = asked.heard(self.chunk.answers(1))[asked.of_window]
        count = np.bincount(self.texts[self.asked][shared], minlength=len(self.n))
        return (self.n > 0) & (count >= self.need)

    def second_question(self) -> Question:
        self.second = np.flatnonzero(self.suspects()[self.texts])
        return Question(key48(self.tokens[self.second]), self.nodes[self.texts[self.second]], self.buckets)

    def rows(self) -> pa.RecordBatch:
        asked = self.second_question()
        classes = np.zeros(len(self.tokens), np.uint8)
        classes[self.second] = asked.heard(self.chunk.answers(2), np.uint8)[asked.of_window]
        shared = np.flatnonzero(classes)
        count = np.bincount(self.texts[shared], minlength=len(self.n))
        suspect = (self.n > 0) & (count >= self.least)
        order = shared[np.lexsort((self.tokens[shared], classes[shared], self.texts[shared]))]
        edges = np.concatenate([[0], np.cumsum(count)])
        seen: set[int] = set()
        raw = self.tokens.view(np.uint8).reshape(-1, 8)[:, 2:]  # the upper six bytes keep the order
        tokens, bits, members = [], [], []
        for i in range(len(self.n)):
            node = int(self.nodes[i])
            if not suspect[i] or node in seen:
                tokens.append(None), bits.append(None), members.append(None)
                continue
            seen.add(node)
            own = slice(self.begin[i], self.begin[i] + self.n[i])
            tokens.append(self.tokens[order[edges[i] : edges[i] + count[i] - self.least[i] + 1]].view(np.int64))
            bits.append(signature(self.tokens[own]))
            members.append(raw[own].tobytes())
        nulls = np.unpackbits(np.frombuffer(self.chunk.row["nulls"], np.uint8), count=len(self.n)).astype(bool)
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array(self.chunk.ids, pa.int64(), mask=nulls),
                "n": pa.array(self.n, pa.int64()),
                "node": pa.array(self.nodes, pa.int64()),
                "tokens": pa.array(tokens, pa.list_(pa.int64())),
                "bits": pa.array(bits, pa.binary()),
                "members": pa.array(members, pa.binary()),
            }
        )


def signature(tokens: np.ndarray) -> bytes:
    """Parity bitmap, about two to four bits per token within 256 to 2,048; halves fold onto each other by exclusive or."""
    width = 256
    while width < 2 * len(tokens) and width < 2048:
        width *= 2
    parity = np.bincount((tokens % np.uint64(width)).astype(np.int64), minlength=width) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def _members(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.view(np.uint64).ravel()


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity, by intersection of their sorted arrays."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, own = [], None, None
            for a, x, y in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if a != last:  # rows of one node follow each other
                    last, own = a, _members(x.as_py())
                other = _members(y.as_py())
                both = len(np.intersect1d(own, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(own) + len(other) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    # the set of b travels to that of a, which Spark splits if it has very many pairs
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("y"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def most_shared(n: np.ndarray, other: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Upper bound of the overlap of sets of two sizes whose signatures differ in so many bits."""
    return np.minimum((n + other - differ) // 2, np.minimum(n, other))


def plausible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures allow the similarity."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y, n, other in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5))):
                words = min(len(x), len(y)) // 8
                one, two = (_fold(np.frombuffer(r, np.uint64)[None, :], words) for r in (x, y))
                most = most_shared(n, other, int(np.bitwise_count(one ^ two).sum()))
                keep.append(bool(100 * most >= percent * (n + other - most)))
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    left = sets.select(F.col("node").alias("a"), F.col("bits").alias("x"), F.col("n").alias("n"))
    right = sets.select(F.col("node").alias("b"), F.col("bits").alias("y"), F.col("n").alias("m"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y", "n", "m").mapInArrow(check, "a long, b long")


def _compare(percent: int, n: np.ndarray, node: np.ndarray, part: np.ndarray, side: np.ndarray, raw: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs among the holders of one token, given in the order of their sizes."""
    widths = np.array([len(x) // 8 for x in raw])
    folded: dict[int, np.ndarray] = {}
    for words in np.unique(widths):  # at each width, all that are at least as wide
        matrix = np.zeros((len(raw), words), np.uint64)
        for own in np.unique(widths[widths >= words]):
            rows = np.flatnonzero(widths == own)
            matrix[rows] = _fold(np.frombuffer(b"".join(raw[i] for i in rows), np.uint64).reshape(len(rows), own), words)
        folded[int(words)] = matrix
    crossed = side.min() != side.max()
    ends = np.searchsorted(n, (100 * n) // percent, side="right")
    found = []
    for i in range(len(n)):
        rows = np.arange(i + 1, ends[i])
        rows = rows[(part[rows] != part[i]) & ((side[rows] != side[i]) | (not crossed))]
        if not len(rows):
            continue
        matrix = folded[int(widths[i])]
        differ = np.bitwise_count(matrix[rows] ^ matrix[i]).sum(axis=1, dtype=np.int64)
        most = most_shared(n[i], n[rows], differ)
        rows = rows[100 * most >= percent * (n[i] + n[rows] - most)]
        if len(rows):
            found.append((np.full(len(rows), node[i]), node[rows]))
    return found


def compare_tile(percent: int, table: pa.Table) -> pa.Table:
    """Pairs from different components, under each token of a tile, whose sizes and signatures allow the similarity."""
    table = table.sort_by([("token", "ascending"), ("n", "ascending"), ("node", "ascending")])
    token, n, node, part, side = (table.column(c).to_numpy() for c in ("token", "n", "node", "component", "side"))
    raw = table.column("bits").to_pylist()
    edges = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1], [True]]))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for a, b in zip(edges[:-1], edges[1:]):
        found += _compare(percent, n[a:b], node[a:b], part[a:b], side[a:b], raw[a:b])
    a = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.int64)
    b = np.concatenate([x for _, x in found]) if found else np.zeros(0, np.int64)
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)  # a pair once per tile
    return pa.table({"a": pa.array(pairs[0], pa.int64()), "b": pa.array(pairs[1], pa.int64())})


def tile_pairs(rows: DataFrame, stats: DataFrame, tile: int, percent: int, buckets: int) -> DataFrame:
    """Pairs to intersect: small groups many to a tile, large ones one tile per pair of blocks of equal or neighbouring bands."""
    rows = rows.join(stats.select("token", "holders"), "token")
    whole = rows.where(F.col("holders") <= tile).select(F.pmod("token", F.lit(buckets)).alias("bucket"), "token", F.lit(0).alias("side"), "node", "n", "component", "bits")
    small = whole.groupBy("bucket").applyInArrow(lambda table: compare_tile(percent, table), "a long, b long")
    if (stats.agg(F.max("holders")).first()[0] or 0) <= tile:
        return small.distinct()
    large = rows.where(F.col("holders") > tile).withColumn("band", F.floor(F.log("n") / F.log(F.lit(BAND))).cast("int"))
    blocks = written(large.groupBy("token", "band").agg(F.ceil(F.count("*") / tile).cast("int").alias("blocks")), "blocks")
    large = large.join(blocks, ["token", "band"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    columns = ["node", "n", "component", "bits"]
    same = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "band", F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"), F.lit(0).alias("up"), *columns
    )
    above = blocks.select("token", (F.col("band") - 1).alias("band"), F.col("blocks").alias("others"))
    low = large.join(above, ["token", "band"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1))).select("token", F.col("own").alias("i"), F.col("other").alias("j"), "band", F.lit(0).alias("side"), F.lit(1).alias("up"), *columns)
    below = blocks.select("token", (F.col("band") + 1).alias("band"), F.col("blocks").alias("others"))
    high = large.join(below, ["token", "band"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1))).select("token", F.col("other").alias("i"), F.col("own").alias("j"), (F.col("band") - 1).alias("band"), F.lit(1).alias("side"), F.lit(1).alias("up"), *columns)
    blocks = same.union(low).union(high).groupBy("token", "band", "up", "i", "j")
    return small.union(blocks.applyInArrow(lambda table: compare_tile(percent, table), "a long, b long")).distinct()


def star_pairs(listed: DataFrame, percent: int, seed: int, by_token: bool) -> DataFrame:
    """One holder of each token with all its others, of compatible sizes and in different components."""
    rank = F.xxhash64("node", F.lit(seed), *(["token"] if by_token else []))
    centre = listed.groupBy("token").agg(F.min(F.struct(rank.alias("h"), "node", "n", "component")).alias("centre"), F.count("*").alias("holders"))
    centre = centre.where("holders > 1").select("token", "centre.*").toDF("token", "h", "c_node", "c_n", "c_component")
    near = (F.col("n") * 100 >= F.col("c_n") * percent) & (F.col("c_n") * 100 >= F.col("n") * percent)
    pairs = listed.join(centre, "token").where(near & (F.col("component") != F.col("c_component")))
    return pairs.select(F.least("node", "c_node").alias("a"), F.greatest("node", "c_node").alias("b")).distinct()


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, tile: int = TILE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles and component_id, the smallest id reachable over links, itself included."""
    buckets = bucket_count(docs.sparkSession)
    packed = chunked(docs.select(id_column, text_column), id_column, text_column)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks_of(batches):
            yield _Sets(chunk, words, percent, buckets).question().rows(chunk.number, False)

    def ask_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks_of(batches):
            yield _Sets(chunk, words, percent, buckets).second_question().rows(chunk.number, False)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks_of(batches):
            yield _Sets(chunk, words, percent, buckets).rows()

    shared = exchange(packed.mapInArrow(ask, ASK_SCHEMA), shared_keys, 1)
    heard = packed.join(shared, "chunk", "left")
    classes = exchange(heard.mapInArrow(ask_again, ASK_SCHEMA), holder_classes, 2)
    nodes = written(heard.join(classes, "chunk", "left").mapInArrow(collect, NODE_SCHEMA), "nodes")

    suspects = nodes.where("members IS NOT NULL")
    sets = written(suspects.dropDuplicates(["node"]).select("node", "n", "members", "bits", "tokens"), "sets")

    def listed(parts: DataFrame | None) -> DataFrame:
        rows = sets.select("node", "n", "tokens", F.col("node").alias("component"))
        if parts is not None:
            rows = rows.drop("component").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
        return rows.select(F.explode("tokens").alias("token"), "node", "n", "component")

    def joined(found: DataFrame, parts: DataFrame) -> DataFrame:  # a link of each node to the head of its component stands for the former ones
        return found.union(parts.select("component", "node"))

    parts = None
    for seed, by_token in ((1, False), (2, True)):
        found = linked(plausible(star_pairs(listed(parts), percent, seed, by_token), sets, percent), sets, percent)
        parts = written(components(found if parts is None else joined(found, parts)), "parts")

    stats = listed(parts).groupBy("token").agg(F.count("*").alias("holders"), F.min("component").alias("c0"), F.max("component").alias("c1"))
    mixed = written(stats.where("c0 <> c1"), "mixed")
    rows = listed(parts).join(sets.select("node", "bits"), "node")
    more = linked(tile_pairs(rows, mixed, tile, percent, buckets), sets, percent)

    final = components(joined(more, parts))
    known = nodes.select("node", F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), "n").where("n > 0").groupBy("node").agg(F.min("id").alias("id"))
    placed = known.join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = placed.groupBy("component").agg(F.min("id").alias("smallest"))
    of_node = placed.join(smallest, "component").select("node", "smallest")
    out = nodes.select("doc_id", "n", F.when(F.col("n") > 0, F.col("node")).alias("node")).join(of_node, "node", "left")
    own = F.when(F.col("n") > 0, F.when(F.col("smallest") != LAST_ID, F.col("smallest"))).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
