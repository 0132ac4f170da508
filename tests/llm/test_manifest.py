"""Merkle manifest, decontamination and hard negatives against plain versions on small, awkward tables."""

from __future__ import annotations

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from shopsight.llm import decontaminate, hardneg, merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
DOCS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, path string"


def _hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    return _hash(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def _tree(nodes, k):
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, w in zip(paths, where):
            a = w - w % k
            path.append(("".join(nodes[a:w]), "".join(nodes[w + 1 : a + k])))
        nodes = [_hash(*nodes[a : a + k]) for a in range(0, len(nodes), k)]
        where = [w // k for w in where]
    return nodes[0], paths


def _manifest(rows, k):
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    own = {}
    for g in names:
        members = sorted(groups[g], key=lambda r: (r[0] is None, r[0] or 0, _leaf(r)))
        own[g] = (members, *_tree([_leaf(r) for r in members], k))
    root, tops = _tree([own[g][1] for g in names], k)
    for g, over in zip(names, tops):
        for r, path in zip(own[g][0], own[g][2]):
            yield r[0], _leaf(r), own[g][1], root, _hash(*[a + b for a, b in path + over])


def _rows(n):
    rng = random.Random(n)
    texts = ["x", "", None, "漢" * 50, "a" * 30000]
    rows = [(rng.choice([None, *range(60)]), rng.choice(["a", None, ""]), rng.choice(["en", "en", "en", "dé", None, "", "Z"]), rng.choice([1, None]), rng.choice(texts)) for _ in range(n)]
    return rows + [rows[0]] * 5


@pytest.mark.parametrize("fan_out, height, n", [(2, 2, 70), (2, 10, 200), (3, 2, 70), (2, 1, 20), (4, 1, 1)])
def test_manifest(spark, fan_out, height, n):
    rows = _rows(n)
    docs = spark.createDataFrame([(*r, "clash", "clash") for r in rows], DOCS).repartition(3)
    out = merkle.manifest(docs, FIELDS, [F.col("doc_id"), F.col("path")], fan_out=fan_out, height=height)
    out = merkle.verified(out, F.col("leaf"))
    got = out.select("row.doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")), "verified", "row.path").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((*r, True, "clash")) for r in _manifest(rows, fan_out))


def test_manifest_finds_tampering(spark):
    docs = spark.createDataFrame([(*r, "", "") for r in _rows(40)], DOCS)
    other = merkle.leaf_digest(*[F.concat("text", F.lit("!")) if f == "text" else F.col(f) for f in FIELDS])
    out = merkle.manifest(docs, FIELDS, [F.when(F.col("doc_id") % 2 == 0, other).alias("shown"), F.col("text")])
    out = merkle.verified(out, F.coalesce("row.shown", "leaf"))
    changed = F.col("row.shown").isNotNull() & F.col("row.text").isNotNull()
    assert out.where(changed == F.col("verified")).count() == 0
    assert out.where(changed).count() > 5


def test_manifest_of_nothing(spark):
    assert merkle.manifest(spark.createDataFrame([], DOCS), FIELDS, [F.col("doc_id")]).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans(decontaminate.UPPER, decontaminate.LOWER)


def _words(text):
    return WORD.findall((text or "").translate(FOLD))


def _decontaminated(docs, items, n=10):
    windows: dict = {}
    for i, text in items:
        own = _words(text)
        for a in range(max(len(own) - n, 0) + 1) if own else []:
            windows.setdefault(tuple(own[a : a + n]), set()).add("" if i is None else str(i))
    for i, text in docs:
        own = _words(text)
        hit, found = [False] * len(own), set()
        for size in {len(k) for k in windows}:
            for a in range(len(own) - size + 1):
                if holders := windows.get(tuple(own[a : a + size])):
                    found |= holders
                    hit[a : a + size] = [True] * size
        yield i, len(own), sum(hit), len(found), ",".join(sorted(found))


def _benchmark_case():
    rng = random.Random(2)
    vocabulary = ["a", "B", "é", "É", "c1", "漢", "x_y", "q-r", "ΑΣ", "İ", "the"]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    items = [(i, text(rng.choice([0, 1, 2, 3, 5, 9, 10, 11, 14, 30]))) for i in range(40)]
    items += [(None, text(12)), (3, "zz " * 11), (7, None), (100, "only one"), (101, "the"), (3, "zz " * 11)]
    docs = [(i, text(rng.choice([0, 1, 5, 9, 10, 30, 80]))) for i in range(150)] + [(None, None), (5, ""), (5, text(3000))]
    docs += [(i, f"Lead {rng.choice(items)[1]} trail {text(4)}") for i in range(200, 260)] + [docs[3]] * 3
    return docs, items


@pytest.mark.parametrize("least", [0, 10, 99])
def test_decontamination(spark, least):
    docs, items = _benchmark_case()
    items = [x for x in items if len(_words(x[1])) >= least]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"row": F.lit("r"), "n_hit": F.lit(1)}).repartition(3)
    out = decontaminate.find(table, spark.createDataFrame(items, "item_id long, text string"))
    got = out.select("row.doc_id", "n_words", "n_hit", "n_items", F.array_join("items", ",")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, _decontaminated(docs, items)))
    assert {r[0] for r in out.select("row.row").distinct().collect()} == {"r"}


def test_decontamination_by_a_full_filter(spark, monkeypatch):
    """Where nearly every fingerprint passes the filter, the join still decides."""
    docs, items = _benchmark_case()
    monkeypatch.setattr(decontaminate, "MOST_BITS", 64)
    monkeypatch.setattr(decontaminate, "LEAST_BITS", 64)
    out = decontaminate.find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = out.select("row.doc_id", "n_words", "n_hit", "n_items", F.array_join("items", ",")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, _decontaminated(docs, items)))


def test_decontamination_of_nothing(spark):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.find(spark.createDataFrame([], "doc_id long, text string"), items).count() == 0


def test_decontamination_runs_no_python(spark):
    docs, items = _benchmark_case()
    out = decontaminate.find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan) and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


VECTORS = "vec_id long, embedding array<double>, label int, score string, vector string"


def _mined(rows):
    good = []
    for k, (i, v, label) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((k, i, label, [max(-(1 << 26), min(1 << 26, math.floor(256 * x))) for x in v]))

    def order(x):
        return -x[0], x[1] is None, x[1] or 0

    for k, i, label, v in good:
        if i is None or i % 100:
            continue
        scores = [(sum(a * b for a, b in zip(v, w)), j, other) for n, j, other, w in good if n != k]
        for p in sorted((x for x in scores if x[2] == label), key=order)[:5]:
            window = (x for x in scores if x[2] != label and 30 * p[0] <= 100 * x[0] <= 90 * p[0])
            for r, x in enumerate(sorted(window, key=order)[:10]):
                yield i, p[1], r + 1, x[1], p[0], x[0]


def _vector_case():
    rng = random.Random(4)

    def vector(n=9):
        return [rng.choice([0.0, rng.uniform(-1, 1), rng.gauss(0, 0.3)]) for _ in range(n)]

    hot = vector()
    rows = [(i, vector(), rng.randrange(4)) for i in range(700)] + [(i, hot, 1 + (i > 900)) for i in range(700, 1000)]
    rows += [(None, vector(), 1), (None, hot, 1), (100, vector(), 2), (100, vector(), 2), (300, None, 1), (5, vector(), None), (1000, [], 1)]
    rows += [(1100, [1.0, None], 1), (1200, [math.nan], 2), (1300, [200.0] * 9, 3), (1400, vector(3), 0), (-200, vector(20), 1), (1500, [math.inf], 1)]
    rows += [rows[200], rows[200]]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk, spread", [(1024, 16), (3, 1)])
def test_hard_negatives(spark, monkeypatch, chunk, spread):
    monkeypatch.setattr(hardneg, "CHUNK", chunk)
    monkeypatch.setattr(hardneg, "SLICE", spread)
    rows = _vector_case()
    table = spark.createDataFrame([(*r, "clash", "clash") for r in rows], VECTORS).repartition(3)
    got = hardneg.mine(table, F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, _mined(rows)))


def test_hard_negatives_beyond_floats(spark):
    """Scores that floats would round."""
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-(1 << 19), 1 << 19) for _ in range(40)], i % 3) for i in range(120)]
    rows += [(100, [x + 1 / 256 for x in rows[0][1]], 0)]
    got = hardneg.mine(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, _mined(rows)))


def test_hard_negatives_of_nothing(spark):
    assert hardneg.mine(spark.createDataFrame([], VECTORS), F.col("vec_id") % 100 == 0).count() == 0
    only = spark.createDataFrame([(100, [1.0], 1, "", ""), (200, None, 1, "", "")], VECTORS)
    assert hardneg.mine(only, F.col("vec_id") % 100 == 0).count() == 0


def test_hard_negatives_pass_no_anchors_through_the_driver(spark):
    """Many slices: the copies of the anchors for them are dealt out, however small the table of anchors is."""
    rng = random.Random(6)
    rows = [(100 * i, i % 3, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(300)]
    typed = spark.createDataFrame(rows, "id long, label long, vector array<double>").repartition(6)
    blocks = hardneg.scratch.written(typed.mapInArrow(hardneg._blocks, hardneg.BLOCK_SCHEMA), "blocks")
    anchors = hardneg.scratch.written(hardneg._chosen(blocks, F.col("id") % 100 == 0, "id"), "anchors").withColumn("scores", F.lit(None).cast("array<long>"))
    out = hardneg._grid(blocks, blocks.count(), anchors, 300, 5, hardneg._positives)
    assert out.count() == 1500
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_bounds_never_lose_a_candidate():
    """Small blocks, so that bounds of one prune the next."""
    import numpy as np

    rng = np.random.default_rng(5)
    for trial in range(30):
        n, d = int(rng.integers(1, 200)), int(rng.integers(1, 40))
        numbers = rng.integers(-300, 300, (n, d)).astype(np.int32)
        if trial % 2:
            numbers = numbers[rng.integers(0, max(1, n // 4), n)]  # many ties
        labels = rng.integers(0, 3, n)
        blocks = []
        for a in range(0, n, 37):
            part = numbers[a : a + 37]
            row = {"first": a, "ids": np.arange(a, a + len(part)).tobytes(), "labels": labels[a : a + 37].astype(np.int64).tobytes(), "columns": [c.tobytes() for c in np.ascontiguousarray(part.T)]}
            blocks.append(hardneg._Block(row | {"low": part.min(0).astype(np.int64).tobytes(), "high": part.max(0).astype(np.int64).tobytes()}))
        for k in range(min(n, 5)):
            anchor = {"anchor": k, "label": labels[k], "numbers": numbers[k]}
            scores = numbers.astype(np.int64) @ numbers[k].astype(np.int64)
            tops = [hardneg._Top(5)]
            for b in blocks:
                hardneg._positives(anchor, b, np.zeros(len(b.ids), bool), tops)
            want = sorted((-scores[i], i) for i in range(n) if i != k and labels[i] == labels[k])[:5]
            assert [(-s, i) for s, i in zip(tops[0].scores, tops[0].ids)] == want
            anchor["scores"] = [int(s) for s in tops[0].scores]
            tops = [hardneg._Top(10) for _ in anchor["scores"]]
            for b in blocks:
                hardneg._negatives(anchor, b, np.zeros(len(b.ids), bool), tops)
            for p, top in zip(anchor["scores"], tops):
                want = sorted((-scores[i], i) for i in range(n) if labels[i] != labels[k] and 30 * p <= 100 * scores[i] <= 90 * p)[:10]
                assert [(-s, i) for s, i in zip(top.scores, top.ids)] == want
