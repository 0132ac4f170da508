"""Merkle manifest of a table: concatenated-level strings.

The rows of a group (a language, say) are the leaves of a tree, in the order of their ids; every FAN_OUT consecutive
nodes become one, the last run may be shorter. An aligned block of BLOCK = FAN_OUT ** HEIGHT leaves keeps each of its levels as
one hex string: substrings of fixed width are hashed to the level above, and what flanks a digest in its run is the segment
of siblings that its proof needs. The roots of the blocks are the leaves of the next round, until one block is left of each
group; the roots of the groups make one more tree of the same kind. A round divides the number of nodes by BLOCK, so there are
a handful at any size.

The place of a row among its group's comes from a range partitioning and the counts per slice, so a group that holds most
rows is spread like any other. A task meets a block at a time; the driver holds one number per round.

Defined results: a null id comes last, a null group is a group of its own and the first; groups are ordered by their UTF-8 bytes.
Rows with equal ids are ordered by leaf; repeated rows keep a leaf each, side by side. A null field is `-`, an empty one `0:`. Texts
of any length are hashed whole. A group of one row has its leaf as root; so has a table of one group its group's. An
empty table gives an empty result. Input columns come back only in the struct `row`, as chosen by the caller, so their names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import scratch

FAN_OUT = 2
HEIGHT = 10  # levels of a block: 1024 leaves, 64 KB of hex
DIGEST = 64
_NO_PATH = "array<struct<before:binary,after:binary>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex sha256 of the concatenation."""
    return F.sha2(F.concat(*parts), 256)


def encoded(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the text: no two lists of values read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*fields: Column) -> Column:
    return digest(*[encoded(f) for f in fields])


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf.cast("binary"), lambda node, s: digest(s["before"], node, s["after"]).cast("binary")).cast("string")


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, from the leaf to the root."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"]).cast("string")), ""), 256)


def _parents(level: Column, fan_out: int) -> Column:
    """The level above, from fixed-width substrings of this one."""
    width = fan_out * DIGEST
    runs = F.ceil(F.octet_length(level) / F.lit(width)).cast("int")
    hashed = F.transform(F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(F.substring(level, i * width + 1, F.lit(width)), 256))
    return F.array_join(hashed, "").cast("binary")


def _levels(first: Column, height: Column, fan_out: int) -> Column:
    """`first` and the `height` levels above it, one hex string each (as bytes, whose substrings are found at once)."""
    return F.aggregate(
        F.array_repeat(F.lit(0), height), F.array(first), lambda below, _: F.concat(below, F.array(_parents(F.element_at(below, -1), fan_out)))
    )


def _path(levels: Column, at: Column, fan_out: int) -> Column:
    """What flanks the node over leaf `at` in its run, level by level up to the root of the block."""

    def flanks(level: Column, depth: Column) -> Column:
        place = F.floor(at / F.pow(F.lit(fan_out), depth)).cast("int")
        within = F.pmod(place, F.lit(fan_out))
        start = (place - within) * DIGEST + 1
        before = F.substring(level, start, within * DIGEST)
        after = F.substring(level, start + (within + 1) * DIGEST, (F.lit(fan_out - 1) - within) * DIGEST)
        return F.struct(before.alias("before"), after.alias("after"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), flanks)


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """`at`, the place of each row among those of its `grp`, and `n`, their number. `order` must tell all rows apart."""
    keys = [F.col("grp").asc(), *order]
    slot = (1 << 33) - 1
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_mark", F.monotonically_increasing_id())
    placed = scratch.written(placed.withColumns({"_slice": F.shiftright("_mark", 33), "_local": F.col("_mark").bitwiseAND(F.lit(slot))}), "placed")
    parts = placed.groupBy("grp", "_slice").agg(F.count("*").alias("_count"), F.min("_local").alias("_first"))
    before = F.coalesce(F.sum("_count").over(Window.partitionBy("grp").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("_count").over(Window.partitionBy("grp"))
    starts = scratch.written(parts.select("grp", "_slice", (before - F.col("_first")).alias("_shift"), total.alias("n")), "starts")
    return placed.join(starts, ["grp", "_slice"]).withColumn("at", F.col("_local") + F.col("_shift")).drop("_mark", "_slice", "_local", "_shift")


def _climb(nodes: DataFrame, fan_out: int, height: int) -> DataFrame:
    """Blocks of nodes (grp, at, n, node, row) with their levels, the path above them and the root of their group."""
    size = fan_out**height
    rows = F.sort_array(F.collect_list(F.struct("at", "node", "row")))
    steps = F.size(F.filter(F.array(*[F.lit(fan_out**i) for i in range(height)]), lambda reach: reach < F.col("n")))
    first = F.array_join(F.transform("rows", lambda r: r["node"]), "").cast("binary")
    blocks = nodes.groupBy("grp", F.floor(F.col("at") / size).alias("block")).agg(F.max("n").alias("n"), rows.alias("rows"))
    blocks = scratch.written(blocks.withColumn("levels", _levels(first, steps, fan_out)), "blocks")
    top = F.element_at("levels", -1).cast("string")
    last = blocks.agg(F.max("block").alias("m")).first()["m"]
    if not last:
        return blocks.withColumns({"above": F.array().cast(_NO_PATH), "root": top})
    over = blocks.select("grp", F.col("block").alias("at"), F.ceil(F.col("n") / size).cast("long").alias("n"), top.alias("node"), F.struct("block").alias("row"))
    found = _rows(_climb(over, fan_out, height), fan_out, height).select("grp", "row.block", F.col("path").alias("above"), "root")
    return blocks.join(scratch.written(found, "above"), ["grp", "block"])


def _rows(blocks: DataFrame, fan_out: int, height: int, more: tuple[str, ...] = ()) -> DataFrame:
    """Every node of the blocks with its whole path."""
    inside = lambda r: F.pmod(r["at"], F.lit(fan_out**height))
    each = F.transform("rows", lambda r: F.struct(r["row"].alias("row"), r["node"].alias("node"), F.concat(_path(F.col("levels"), inside(r), fan_out), F.col("above")).alias("path")))
    return blocks.select("grp", "root", *more, F.inline(each))


def manifest(
    rows: DataFrame, fields: list[str], keep: list[Column], id_column: str = "doc_id", group_column: str = "lang",
    fan_out: int = FAN_OUT, height: int = HEIGHT,
) -> DataFrame:
    """Per row: `row` (a struct of `keep`, of orderable types), leaf, subroot (of its group), root and path.

    `path` has for every level, from the leaf to the root, the sibling digests before and after the node, as bytes of hex.
    """
    # ordered as the groups are: null, then by bytes
    group = F.coalesce(F.concat(F.lit("+"), F.col(group_column).cast("string")), F.lit(""))
    leaves = rows.select(
        group.alias("grp"), F.col(id_column).alias("id"), leaf_digest(*[F.col(f) for f in fields]).alias("node"),
        F.struct(*keep).alias("row"), F.monotonically_increasing_id().alias("tie"),
    )
    leaves = scratch.written(leaves, "leaves")
    order = [F.col("id").asc_nulls_last(), F.col("node").asc(), F.col("tie").asc()]
    blocks = _climb(numbered(leaves, order).drop("id", "tie"), fan_out, height)
    subroots = blocks.where("block = 0").select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("root").alias("node"))
    places = numbered(scratch.written(subroots, "subroots"), [F.col("name").asc()])
    over = _rows(_climb(places.select("grp", "at", "n", "node", F.struct("name").alias("row")), fan_out, height), fan_out, height)
    over = scratch.written(over.select(F.col("row.name").alias("grp"), F.col("path").alias("_over"), F.col("root").alias("_root")), "groups")
    whole = blocks.join(over, "grp").withColumns({"subroot": F.col("root"), "root": F.col("_root"), "above": F.concat("above", "_over")})
    return _rows(whole, fan_out, height, ("subroot",)).select("row", F.col("node").alias("leaf"), "subroot", "root", "path")


def verified(rows: DataFrame, leaf: Column) -> DataFrame:
    """Adds folded_root, recomputed from `leaf` and the path, and whether it is the root."""
    return rows.withColumn("folded_root", folded(leaf, F.col("path"))).withColumn("verified", F.col("folded_root") == F.col("root"))
