"""Document operators against plain versions on small, awkward tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shopsight.llm import catalog, fingerprint, graph, jaccard, mixing, packing, quality, spans, substring, suffix, suffixdedup

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words int, row string"


def _texts() -> list[tuple]:
    rng = random.Random(5)
    words = ["alpha", "beta", "Gamma", "dé", "e", "f,", "ggg.", "ß", "漢字", "i", "jj", "k"]
    base = [rng.choice(words) + str(rng.randrange(60)) for _ in range(90)]
    rows = [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join(base[:80] + ["x"] * 3)), (7, None), (8, ""), (9, " \n\t "), (10, "one two"), (11, "ONE two")]
    rows += [(12, "the " * 400), (13, "the " * 300 + "end"), (None, " ".join(base)), (None, None), (2, " ".join(base)), (15, "ab" * 900), (16, "one <|endoftext|> two<|endoftext|>")]
    for i in range(20, 60):
        own = [rng.choice(words) + str(rng.randrange(500)) for _ in range(rng.randrange(0, 140))]
        at = rng.randrange(0, 60)
        rows.append((i, " ".join(own[: len(own) // 2] + base[at : at + rng.randrange(0, 60)] + own[len(own) // 2 :])))
    for i in range(60, 75):  # near copies
        own = list(base)
        for _ in range(rng.randrange(1, 4)):
            own[rng.randrange(len(own))] = f"new{rng.randrange(99)}"
        rows.append((i, "\n".join([" ".join(own[:40]), " ".join(own[40:])])))
    rng.shuffle(rows)
    langs = ["en", "de", None, "xx"]
    return [(i, t, langs[k % 4], f"s{k % 3}" if k % 5 else None, 0, "clash", 7, "clash") for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(_texts(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _id(i):
    return 1 << 62 if i is None else i


def _expected(window: int, units) -> Counter:
    first: dict = {}
    rows = _texts()
    for i, text, *_ in rows:
        own = units((text or "").encode())
        for s in range(len(own) - window + 1):
            key = bytes(own[s : s + window]) if isinstance(own, bytes) else tuple(own[s : s + window])
            first[key] = min(first.get(key, 1 << 62), _id(i))
    found: Counter = Counter()
    for i, text, *_ in rows:
        own = units((text or "").encode())
        gone = [False] * len(own)
        for s in range(len(own) - window + 1):
            key = bytes(own[s : s + window]) if isinstance(own, bytes) else tuple(own[s : s + window])
            if first[key] < _id(i):
                gone[s : s + window] = [True] * window
        kept = [u for u, g in zip(own, gone) if not g]
        body = bytes(kept) if isinstance(own, bytes) else b" ".join(kept)
        runs = sum(g and (j == 0 or not gone[j - 1]) for j, g in enumerate(gone))
        found[(i, len(own), sum(gone), runs, hashlib.sha256(body).hexdigest())] += 1
    return found


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(3)
    for k in range(200):
        t = rng.integers(0, rng.choice([1, 2, 4, 256]), int(rng.integers(0, 70))).astype(np.uint8)
        t = np.tile(t, 3) if k % 3 == 0 else t
        raw, order = t.tobytes(), suffix.suffix_array(t)
        assert list(order) == sorted(range(len(raw)), key=lambda i: raw[i:])
        shared = suffix.permuted_prefixes(t, order, 50) if len(t) else []
        for a, b in zip(order[:-1], order[1:]):
            n = next((j for j in range(min(len(raw) - a, len(raw) - b)) if raw[a + j] != raw[b + j]), min(len(raw) - a, len(raw) - b))
            assert min(shared[b], 50) == min(n, 50)


def test_suffix_dedup(table, empty):
    out = suffixdedup.remove_copied_bytes(table)
    rows = out.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert Counter(map(tuple, rows)) == _expected(50, lambda b: b)
    assert suffixdedup.remove_copied_bytes(empty).count() == 0
    assert {r[0] for r in out.select("row.n_words").collect()} == {7}


@pytest.mark.parametrize("hot", [1, 3])
def test_suffix_dedup_of_hot_anchors(table, hot):
    out = suffixdedup.remove_copied_bytes(table, hot=hot)
    rows = out.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert Counter(map(tuple, rows)) == _expected(50, lambda b: b)


def test_suffix_dedup_spreads_a_hot_phrase(spark, monkeypatch):
    """Different text around one common phrase doesn't go to one shard."""
    rng = random.Random(6)

    def least(phrase):
        raw = np.frombuffer(phrase.encode(), np.uint8)
        starts = np.arange(len(raw) - 23)
        return spans.span_hash(spans.prefix_sums(raw), starts, starts + 24).min()

    def letters(n):
        return "".join(rng.choice("abcdefghij ") for _ in range(n))

    phrase = min((letters(30) for _ in range(3000)), key=least)  # its anchor is that of all windows around it
    rows = [(i, letters(60) + phrase + letters(60)) for i in range(600)]
    asked = []
    whole = suffixdedup.exchange
    monkeypatch.setattr(suffixdedup, "exchange", lambda rows, reply, level: (asked.append(rows), whole(rows, reply, level))[1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(100)
    assert suffixdedup.remove_copied_bytes(docs).agg(F.sum("n_removed")).first()[0] == 0
    sizes = [r.n for r in asked[1].groupBy("bucket").agg(F.sum(F.length("keys")).alias("n")).collect()]
    assert sum(sizes) > 600 * 50 and max(sizes) < sum(sizes) / 4


def test_suffix_dedup_sorts_only_what_comes_twice(monkeypatch):
    """A shard's contexts whose windows are all different are not sorted, and the answers follow from the bytes."""
    rng = random.Random(9)
    alone = [bytes(rng.choices(b"abcd", k=50 + rng.randrange(26))) for _ in range(300)]
    shared = [bytes(rng.choices(b"abcd", k=50)) for _ in range(20)]
    partly = [bytes(rng.choices(b"abcd", k=9)) + x + bytes(rng.choices(b"abcd", k=7)) for x in shared for _ in range(3)]
    texts = alone + partly + [alone[0]]
    rng.shuffle(texts)
    asked = [rng.randrange(40) for _ in texts]
    counts = np.array([len(x) - 49 for x in texts], np.uint8)
    table = pa.table({"chunk": [0], "bucket": pa.array([0], pa.int32()), "keys": [counts.tobytes() + b"".join(texts)], "lows": [np.array(asked, np.int64).tobytes()], "many": [b""]})
    least: dict = {}
    for i, x in zip(asked, texts):
        for k in range(len(x) - 49):
            least[x[k : k + 50]] = min(least.get(x[k : k + 50], 99), i)
    sorted_bytes, whole = [], suffixdedup.suffix_array
    monkeypatch.setattr(suffixdedup, "suffix_array", lambda t: (sorted_bytes.append(len(t)), whole(t))[1])
    got = np.frombuffer(suffixdedup._sorted_shard(50, table).column("mask")[0].as_py(), np.uint32)
    for i, x, mask in zip(asked, texts, got):
        assert [int(mask) >> k & 1 for k in range(len(x) - 49)] == [int(least[x[k : k + 50]] < i) for k in range(len(x) - 49)]
    assert sum(sorted_bytes) == sum(map(len, partly))


def test_covered():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 4, 50, 200):
        for length in (1, 3, 50):
            flags = rng.random(max(0, n - rng.integers(0, length))) < 0.05
            want = [any(flags[max(0, i - length + 1) : i + 1]) for i in range(n)]
            assert spans.covered(flags, length, n).tolist() == want


def test_substring_dedup(table, empty):
    out = substring.remove_repeats(table)
    rows = out.select("row.doc_id", "n_words", "n_removed", F.lit(0), F.sha2("kept", 256)).collect()
    want = Counter({(i, n, g, 0, h): c for (i, n, g, _, h), c in _expected(13, lambda b: WORD.findall(b)).items()})
    assert Counter(map(tuple, rows)) == want
    assert substring.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("tile", [1024, 2])
def test_jaccard_components(table, empty, tile):
    sets = []
    for i, text, *_ in _texts():
        w = WORD.findall((text or "").encode().translate(LOWER))
        sets.append((i, frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])))
    group = list(range(len(sets)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if both and 100 * both >= 80 * len(sets[a][1] | sets[b][1]):
                group[top(a)] = top(b)
    least: dict = {}
    for a, (i, _) in enumerate(sets):
        least[top(a)] = min(least.get(top(a), 1 << 62), _id(i))
    want = Counter((i, len(s), None if least[top(a)] == 1 << 62 else least[top(a)]) for a, (i, s) in enumerate(sets))
    assert Counter(map(tuple, jaccard.jaccard_components(table, tile=tile).collect())) == want
    assert jaccard.jaccard_components(empty).count() == 0


def test_components_have_small_plans(spark, monkeypatch):
    """What a round of the components plans, which the driver holds, reads its list four times; the components are those of a plain walk."""
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(500, i) for i in range(501, 600)] + [(i, i + 1) for i in range(700, 760)]
    plans, whole = [], graph.written
    monkeypatch.setattr(graph, "written", lambda df, label: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), whole(df, label))[1])
    group = {x: x for pair in links if pair[0] != pair[1] for x in pair}
    while any(group[a] != group[b] for a, b in links if a != b):
        for a, b in links:
            if a != b:
                group[a] = group[b] = min(group[a], group[b])
    got = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted(group.items())
    assert len(plans) > 2 and all(x.count("Relation") <= 4 for x in plans[1:])
    plans.clear()
    assert graph.components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0 and len(plans) == 2


def test_fingerprints(table, empty):
    rows = sorted(((i, t or "") for i, t, *_ in _texts()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = Counter()
    for (i, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
        cut = len(t) // 3
        want[(i, len(t), hashlib.sha256((t[: len(t) - cut] + nxt[:cut]).encode()).hexdigest())] += 1
    got = fingerprint.with_next(table).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    assert len({r.fingerprint for r in got if r.doc_id in (1, 2)}) == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprint.with_next(empty).count() == 0


def test_sketches_estimate_and_merge(spark):
    rng = random.Random(1)
    words = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    a, b = words[:2000], words[500:]
    one, two, both = fingerprint.sketches([" ".join(x).encode() for x in (a, b, words)])
    sets = [{tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (a, b)]
    true = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    assert abs(fingerprint.resemblance(one, two) - true) < 0.15
    assert abs(fingerprint.containment(one, two) - len(sets[0] & sets[1]) / len(sets[0])) < 0.25
    assert abs(fingerprint.distinct_count(both) / 2996 - 1) < 0.3
    assert (fingerprint.merge(one, two) == both).all()
    parts = spark.createDataFrame([("x", fingerprint.as_text(one)), ("x", fingerprint.as_text(two)), ("y", fingerprint.as_text(two)), ("z", None)], "k string, fingerprint string")
    got = {r.k: r.fingerprint for r in fingerprint.merge_parts(parts, ["k"]).collect()}
    assert got == {"x": fingerprint.as_text(both), "y": fingerprint.as_text(two), "z": ""}


def test_mixing(table, empty, spark):
    out = mixing.mix(table).collect()
    rows = _texts()
    assert Counter((r.doc_id, r.size) for r in out) == Counter((r[0], len(WORD.findall((r[1] or "").encode()))) for r in rows)
    assert all(r.taken == r.copies * r.size <= 3 * r.size for r in out)
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, mixing.mix(table).collect()), key=repr)
    size: Counter = Counter()
    for r in rows:
        size[r[3]] += len(WORD.findall((r[1] or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(size, key=lambda s: (s is None, s or "")))}
    low, high = 0.0, 10.0 * sum(size.values())
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(mid * weight[s], 3 * size[s]) for s in size) < sum(size.values()) else (low, mid)
    for s, n in size.items():
        own = [r for r in out if r.source_size == n]
        assert own and abs(own[0].target - min(low * weight[s], 3 * n)) < 1e-3
    for target, n in {(r.target, r.source_size) for r in out}:
        own = [r for r in out if (r.target, r.source_size) == (target, n)]
        assert abs(sum(r.taken for r in own) - target) <= max(r.size for r in own)
    assert mixing.mix(empty).count() == 0


def test_mixing_targets_stop_at_the_cap(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 0)], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert got["a"] == 30 and abs(got["b"] - 1980 * 2 / 3) < 1e-6 and abs(got["c"] - 1980 / 3) < 1e-6 and got[None] == 0


def test_packing(table, empty):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    plain = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.pack(table).collect()
    assert len({r.sequence_id for r in pieces}) == len(pieces)
    assert all(r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 1024 and r.bucket == r.length.bit_length() - 1 for r in pieces)
    want: Counter = Counter()
    for i, text, *_ in _texts():
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for n in packing.piece_lengths(len(ids)):
            want[(i, at, n, zlib.crc32(ids[at : at + n].tobytes()), len(ids))] += 1
            at += n
        assert at == len(ids)
    assert Counter((r.doc_id, r.start, r.length, zlib.crc32(r.tokens), r.doc_tokens) for r in pieces) == want
    assert packing.pack(empty).count() == 0


def test_encoder_at_odd_white_space():
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    plain = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder, rng = packing.Encoder(packing.vocabulary(), packing.added_tokens()), random.Random(2)
    for _ in range(1500):
        text = "".join(rng.choice([" ", " ", "\n", "\t", " ", "　", "a", "it's", "9", "!", "é", "漢", "<|endoftext|>"]) for _ in range(rng.randrange(0, 14)))
        assert encoder.encode(text) == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_encoder_writes_bytes_of_whole_texts():
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    plain = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder, rng = packing.Encoder(packing.vocabulary(), packing.added_tokens()), random.Random(3)
    words = ["".join(rng.choice("aeinrstéñ漢") for _ in range(rng.randrange(1, 12))) for _ in range(400)]
    for n in (0, 1, 5, 3000):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", ", ", ".\n", " 12 ", "<|endoftext|>"]) for _ in range(n))
        assert encoder.packed(text) == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_quality_rules(table, empty):
    text = re.compile(r"[^\x20\x09-\x0D]+")
    want: Counter = Counter()
    for i, t, *_ in _texts():
        t = t or ""
        w = text.findall(t)
        lines = [x for x in t.split("\n") if text.search(x)]
        n = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        again = len({k + d for k in range(len(w) - 2) if n[tuple(w[k : k + 3])] > 1 for d in range(3)})
        want[(i, len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), again, len(w) < 50 or 100 * again > 50 * len(w))] += 1
    got = quality.judge(table).select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert Counter(tuple(r)[:-1] for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)
    assert quality.judge(empty).count() == 0


def _log_perplexities(texts: list[bytes]) -> list[float]:
    """Nats per byte under a modified Kneser-Ney model of these texts, from dictionaries."""
    rows = [[int(quality.FOLD[b]) for b in t] for t in texts]
    levels = [Counter(tuple(([0, 0, 0] + r)[k : k + 4]) for r in rows for k in range(len(r)))]
    for _ in range(3):
        levels.insert(0, Counter(g[1:] for g in levels[0]))
    about = []
    for grams in levels:
        c = [sum(n == i for n in grams.values()) for i in range(1, 5)]
        cut = [0.0, 0.5, 0.75, 0.9]
        if min(c):
            y = c[0] / (c[0] + 2 * c[1])
            cut = [0.0, *[min(max(i - (i + 1) * y * c[i] / c[i - 1], 0.05), i - 0.05) for i in (1, 2, 3)]]
        total, spare = Counter(), Counter()
        for g, n in grams.items():
            total[g[:-1]] += n
            spare[g[:-1]] += cut[min(n, 3)]
        about.append((grams, cut, total, spare))

    def chance(g):
        if not g:
            return 1 / 64
        grams, cut, total, spare = about[len(g) - 1]
        n, own = grams[g], total[g[:-1]]
        return (n - cut[min(n, 3)] + spare[g[:-1]] * chance(g[1:])) / own if own else chance(g[1:])

    return [-sum(math.log(chance(tuple(([0, 0, 0] + r)[k : k + 4]))) for k in range(len(r))) / max(len(r), 1) for r in rows]


def _judged_texts() -> list[tuple]:
    """Prose by language; some texts easier and some harder than all others, and some that fail the base rules."""
    rng = random.Random(11)
    rows = []
    for lang, syllables in (("en", ["th", "er", "on", "an", "re", "he"]), ("de", ["sch", "ei", "en", "ung", "ü"])):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(300)]
        rows += [(lang, " ".join(rng.choice(words) for _ in range(rng.randrange(60, 140)))) for _ in range(60)]
        rows += [(lang, " ".join("a" * rng.randrange(5, 60) for _ in range(60))) for _ in range(2)]
        rows += [(lang, " ".join("".join(chr(rng.randrange(33, 127)) for _ in range(6)) for _ in range(60))) for _ in range(2)]
        for n in range(2, 26, 2):  # prose with more and more words that are none
            rows.append((lang, " ".join("".join(chr(rng.randrange(33, 127)) for _ in range(6)) if k < n else rng.choice(words) for k in range(100))))
        rows.append((lang, "too short"))
    return [(i, text, lang) for i, (lang, text) in enumerate(rows)]


def _expected_kept(rows: list[tuple], reach: int = 3) -> tuple[dict, Counter]:
    """Verdict by id, and how many of those that pass the base rules lie below, in and above the band of each language."""
    kept, sides = {}, Counter()
    for lang in {r[2] for r in rows}:
        own = [r for r in rows if r[2] == lang]
        scores = dict(zip([r[0] for r in own], _log_perplexities([r[1].encode() for r in own])))
        passed = [r[0] for r in own if len(r[1].split()) >= 50]
        bins = sorted(math.floor(scores[i] * 500) for i in passed)
        low, high = (bins[math.ceil(q * len(bins)) - 1] / 500 for q in (0.25, 0.75))
        wide = reach * max(high - low, 2 / 500)
        for r in own:
            side = (scores[r[0]] > high + wide) - (scores[r[0]] < low - wide)
            kept[r[0]] = r[0] in passed and not side
            sides[(lang, side)] += r[0] in passed
    return kept, sides


def test_quality_verdict(spark):
    rows = _judged_texts()
    want, sides = _expected_kept(rows)
    assert all(sides[(lang, side)] for lang in ("en", "de") for side in (-1, 0, 1))
    assert want != _expected_kept(rows, 6)[0]  # some lie between the bounds and those of twice the reach
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)).select("row.doc_id", "kept").collect()
    assert {r.doc_id: r.kept for r in got} == want


def test_quality_languages(spark):
    """Languages that no list names, and null, have bands of their own, also if there are more than a byte can tell."""
    scripts = {"ru": "абвгдежз", "zh": "的一是不了人我在", "pl": "ąćęłńóśż", None: "etaoinsh"}
    rng = random.Random(12)
    rows = []
    for lang, letters in scripts.items():
        words = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 5))) for _ in range(200)]
        many = 80 if lang == "ru" else 40
        rows += [(lang, " ".join(rng.choice(words) for _ in range(80))) for _ in range(many)]
        rows.append((lang, " ".join("".join(chr(rng.randrange(33, 127)) for _ in range(6)) for _ in range(60))))
    rows += [(f"x{k}", None if k % 2 else "short") for k in range(300)]
    rows = [(i, text, lang) for i, (lang, text) in enumerate(rows)]
    own = [r for r in rows if r[2] is None or r[2] in scripts]
    want = _expected_kept(own)[0]
    assert want != _expected_kept([(i, text, "all") for i, text, _ in own])[0]  # one band for all judges otherwise
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)).select("row.doc_id", "row.lang", "kept").collect()
    assert len(got) == len(rows) and {r.doc_id: r.kept for r in got if r.lang is None or r.lang in scripts} == want
    assert not any(r.kept for r in got if r.lang and r.lang[0] == "x")


def test_perplexity_model():
    """Probabilities sum to one after any context, and a text unlike the corpus has the higher perplexity."""
    rng = random.Random(4)
    body = np.frombuffer(" ".join(rng.choice(["the", "cat", "sat", "on", "mat", "and"]) for _ in range(3000)).encode(), np.uint8)
    codes, counts = np.unique(quality.gram_codes(body, np.array([0, len(body)])), return_counts=True)
    model = quality.Model(codes, counts)
    for context in [int(codes[0]) >> 6, int(codes[len(codes) // 2]) >> 6, 12345]:
        total = np.exp(model.log_probability((np.uint32(context) << np.uint32(6)) | np.arange(64, dtype=np.uint32))).sum()
        assert abs(total - 1) < 1e-6

    def nats(t):
        raw = np.frombuffer(t, np.uint8)
        return -model.log_probability(quality.gram_codes(raw, np.array([0, len(raw)]))).mean()

    assert nats(b"zq#k vx$ jjw") > 2 * nats(b"the cat sat on")


def _word_log_perplexities(texts: list[str]) -> list[float]:
    """Nats per word under a modified Kneser-Ney model of these texts' words, each 4-gram judged without one occurrence of itself; equal texts are one."""
    rows = {t: [None] * 3 + re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts}
    levels = [Counter(tuple(r[k : k + 4]) for r in rows.values() for k in range(len(r) - 3))]
    for _ in range(3):
        levels.insert(0, Counter(g[1:] for g in levels[0]))
    about = []
    for grams in levels:
        c = [sum(n == i for n in grams.values()) for i in range(1, 5)]
        cut = [0.0, 0.5, 0.75, 0.9]
        if min(c):
            y = c[0] / (c[0] + 2 * c[1])
            cut = [0.0, *[min(max(i - (i + 1) * y * c[i] / c[i - 1], 0.05), i - 0.05) for i in (1, 2, 3)]]
        followers: dict = {}
        for g, n in grams.items():
            followers.setdefault(g[:-1], Counter())[g] = n
        about.append((cut, followers))

    def chance(g, out):
        if not g:
            return 1 / len(levels[0])
        cut, followers = about[len(g) - 1]
        n = followers[g[:-1]].copy()
        lower = chance(g[1:], out and n[g] == 1)
        n[g] -= out
        total = sum(n.values())
        return (n[g] - cut[min(n[g], 3)] + sum(cut[min(x, 3)] for x in n.values()) * lower) / total if total else lower

    found = {t: [math.log(chance(tuple(r[k : k + 4]), 1)) for k in range(len(r) - 3)] for t, r in rows.items()}
    return [-sum(found[t]) / max(len(found[t]), 1) for t in texts]


def test_word_perplexities(spark):
    """All n-grams of all words count, also those that differ only in what byte classes fold."""
    rng = random.Random(21)
    words = [rng.choice(["ab", "Ab", "aB", "é", "è", "ê", "漢", "x1", "x2"]) + rng.choice("aeiou") for _ in range(30)]
    rows = [(lang, " ".join(rng.choice(words[: 6 + 3 * i]) for _ in range(rng.randrange(0, 90)))) for lang in ("en", None, "yy") for i in range(12)]
    rows += [rows[3], rows[3], ("en", rows[14][1]), ("en", "alone"), ("yy", " \n"), (None, None), ("zz", "one two"), ("en", "q7 " * 60)]
    rows = [(i, text, lang) for i, (lang, text) in enumerate(rows)]
    want = {}
    for lang in {r[2] for r in rows}:
        own = [r for r in rows if r[2] == lang]
        want |= dict(zip([r[0] for r in own], _word_log_perplexities([r[1] or "" for r in own])))
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3), by_words=True).select("row.doc_id", "word_log_perplexity", "row.text", "row.lang").collect()
    assert len(got) == len(rows)
    for r in got:
        assert abs(r.word_log_perplexity - want[r.doc_id]) < 1e-6
    assert len({r.word_log_perplexity for r in got if (r.text, r.lang) == (rows[3][1], rows[3][2])}) == 1
    assert quality.judge(spark.createDataFrame([], "doc_id long, text string, lang string"), by_words=True).count() == 0


def test_quality_rules_judge_by_words(spark, folder):
    """Texts of known syllables in words of no language are rejected; four byte classes at a time look like prose."""
    rng = random.Random(22)
    every = ["".join(rng.choice("tmsr") + rng.choice("aeo") for _ in range(4)) for _ in range(8000)]
    words = every[:3000]
    others = sorted(set(every) - set(words))
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(80, 120))), "en") for i in range(200)]
    rows += [(1000 + i, " ".join(rng.choice(others) for _ in range(100)), "en") for i in range(4)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{folder}/documents.parquet")
    plain = {r.doc_id: r.kept for r in quality.judge(spark.read.parquet(f"{folder}/documents.parquet")).select("row.doc_id", "kept").collect()}
    got = {r.doc_id: r.kept for r in catalog.op9_quality_rules(spark, folder).collect()}
    assert len(got) == len(rows) and sum(got[i] for i in range(200)) >= 198
    assert any(plain[1000 + i] for i in range(4)) and not any(got[1000 + i] for i in range(4))
