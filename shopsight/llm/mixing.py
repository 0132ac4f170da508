"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

A document of a source with rate r (target words / words present, at most `cap`) gets floor(r) copies, and one more with
probability r - floor(r). The extra copies are decided by pairing: two fractional documents exchange expected words at random,
without changing their sum or either's expectation, until one of them is integral; the other one goes on. Documents are paired
within blocks by a fold over a bounded array; each block hands on at most one fractional document, and these are paired in blocks again, a
reduction tree of few levels. The last one of a source is rounded to the nearer side, so a source misses its target by less than one document.

All random choices are hashes of seed, id, size and level: reruns agree. Rows meet the row of their source under one of
`salts` numbers, so a hot source is spread. The driver sees only the size of the largest source, which tells the number of levels.

Defined results: a null text has size 0 and takes 0; a null source is a source of its own; documents with equal ids are separate; an
empty table gives an empty result; other columns are not touched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
BLOCK = 256
SALTS = 64
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, source_size, n, target): all words shared by weight, none above cap times its size; n documents have words.

    Sources are filled in the order in which they reach their cap; the level at which the rest holds everything else
    follows from running sums over one row per source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("n"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    ranked = by_source.withColumn("weight", weight).withColumn("most", F.lit(cap) * F.col("source_size"))
    filling = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), F.encode("source", "utf-8"))
    everything = Window.partitionBy()
    ranked = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("full", F.coalesce(F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    )
    # the first source whose cap is not reached sets the level of itself and all after it
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct(F.col("most") / F.col("weight"), F.col("level")))).over(everything)
    return ranked.select("source", "source_size", "n", F.least(F.col("most"), F.coalesce(F.col("weight") * level["level"], F.col("most"))).alias("target"))


def _uniform(*parts: Column) -> Column:
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def _pivot(seed: int, level: int) -> Column:
    """Fold over the array `items` of rows with a fractional p: the carried fractional item and the integral ones."""
    eps = 1e-9
    fields = {"id": "bigint", "size": "bigint", "p": "double", "base": "bigint", "source_size": "bigint", "target": "double", "source": "string", "n": "bigint"}
    item = f"struct<{','.join(f'{k}:{v}' for k, v in fields.items())}>"
    start = F.struct(F.lit(None).cast(item).alias("carry"), F.array().cast(f"array<{item}>").alias("done"))

    def step(state: Column, x: Column) -> Column:
        carry = state["carry"]
        # words that can move from x to carry (up) and from carry to x (down)
        up = F.least((1 - carry["p"]) * carry["size"], x["p"] * x["size"])
        down = F.least(carry["p"] * carry["size"], (1 - x["p"]) * x["size"])
        take = _uniform(F.lit(seed), F.lit(level), carry["id"], carry["size"], x["id"], x["size"]) * (up + down) < down
        moved = F.when(take, up).otherwise(-down)
        p_carry = carry["p"] + moved / carry["size"]
        p_x = x["p"] - moved / x["size"]

        def at(one: Column, p: Column) -> Column:
            exact = F.when(p < eps, 0.0).when(p > 1 - eps, 1.0).otherwise(p)
            return F.struct(*[(exact if k == "p" else one[k]).alias(k) for k in fields])

        a, b = at(carry, p_carry), at(x, p_x)
        settled = (a["p"] == 0.0) | (a["p"] == 1.0)
        both = settled & ((b["p"] == 0.0) | (b["p"] == 1.0))
        none = F.lit(None).cast(item)
        return F.when(carry.isNull(), F.struct(x.alias("carry"), state["done"].alias("done"))).otherwise(
            F.when(both, F.struct(none.alias("carry"), F.concat(state["done"], F.array(a, b)).alias("done")))
            .when(settled, F.struct(b.alias("carry"), F.concat(state["done"], F.array(a)).alias("done")))
            .otherwise(F.struct(a.alias("carry"), F.concat(state["done"], F.array(b)).alias("done")))
        )

    return F.aggregate("items", start, step)


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, seed: int = 7, block: int = BLOCK, salts: int = SALTS, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """Per document: doc_id, size, source_size, target (of its source), copies, taken (copies times size)."""
    plain = docs.select(F.col(id_column).cast("long").alias("id"), F.col(source_column).cast("string").alias("source"), word_count(F.col(text_column)).alias("size"))
    sizes = written(plain, "sizes")
    goals = written(targets(sizes, weights, cap), "goals")
    salted = sizes.withColumn("salt", F.pmod(F.xxhash64("id", "size"), F.lit(salts)).cast("int"))
    spread = goals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rated = salted.join(spread, salted["source"].eqNullSafe(spread["source"]) & (salted["salt"] == spread["salt"])).drop(spread["source"], spread["salt"])
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(cap))).otherwise(0.0)
    rated = rated.withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(0.0)).withColumn("base", F.floor(F.col("rate") + 1e-9))
    rated = rated.withColumn("p", F.greatest(F.col("rate") - F.col("base"), F.lit(0.0))).withColumn("base", F.col("base").cast("long"))
    columns = ["id", "size", "p", "base", "source_size", "target", "source", "n"]
    whole = rated.where("p < 1e-9").withColumn("p", F.lit(0.0)).select(columns)
    open_rows = rated.where("p >= 1e-9").select(columns)
    done = [whole]
    level, largest = 0, goals.agg(F.max("n")).first()[0] or 0
    while largest > 1:  # a source's n rows go to n / block blocks, each of which hands on one row at most
        dealt = open_rows.withColumn("n", F.ceil(F.col("n") / block)).withColumn("block", F.pmod(F.xxhash64(F.lit(seed + level), "id", "size"), "n"))
        # large documents first: what a block hands on is then rather a small one
        items = F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("o"), *columns)))
        items = F.transform(items, lambda x: F.struct(*[x[c].alias(c) for c in columns]))
        grouped = dealt.groupBy("source", "block").agg(items.alias("items")).select(_pivot(seed, level).alias("state"))
        state = written(grouped, f"level{level}")
        done.append(state.select(F.explode("state.done").alias("x")).select("x.*").select(columns))
        open_rows = state.where("state.carry IS NOT NULL").select("state.carry.*").select(columns)
        level, largest = level + 1, -(-largest // block)
    done.append(open_rows.withColumn("p", F.round("p")))
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    copies = (F.col("base") + F.col("p")).cast("long")
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
