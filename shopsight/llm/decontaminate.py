"""Benchmark decontamination by winnowing, with DataFrame functions only.

Words are hashed, hashes of GRAM words made from them, and of every window of SHARED words the smallest of these is kept as
its fingerprint. Windows with equal words have equal fingerprints, so every shared span of SHARED words or more is found. Fingerprints
of the test items become a filter of bounded size; a document's fingerprint that passes it is extended to its whole window, and
fingerprint and words of that window are joined to those of the items. What the filter lets through by chance is lost in this
join, which compares words, so the result is exact. An item of fewer than SHARED words is one window as long as
the item; documents are read for every such length that occurs, at most SHARED - 1.

Texts are read once and never shuffled: only windows that pass the filter travel. A window that many documents hold is a hot key
on one side of a join whose other side is written first, so that adaptive execution can split it. Documents with the same
windows share one list of items, which is made once. The filter has 16 bits a window up to MOST_BITS (1 MB): beyond that
more windows pass it, none is lost. The driver holds the filter, the number of windows and the few lengths.

Defined results: a null text has no words, an item without words no window; a null id of a document comes back as it is. Items are told
apart by id: rows with the same id are one item, null ids are one item, named by the empty string. Rows with equal ids, repeated rows
and equal texts are judged row by row. Windows never span two texts. Long texts are worked off whole, in memory that
follows the longest text. An empty table gives an empty result, an empty benchmark finds nothing. Other columns
of the documents come back in the struct `row`, whatever their names; those of the items are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scratch

SHARED = 10
GRAM = 4  # a power of two
LEAST_BITS, MOST_BITS = 1 << 12, 1 << 23
# What is no word, once A-Z are in lower case.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case. lower() does the same for ASCII, only faster."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), BREAKS), "")


def _after(values: Column, steps: int) -> Column:
    return F.slice(values, F.lit(steps + 1), F.size(values))


def _doubled(values: Column, upto: int, merge: Callable[[Column, Column], Column]) -> Column:
    """Every run of `upto` values merged, from runs half as long. Entries whose run would pass the end mean nothing."""

    def merged(have: Column, step: int) -> Column:
        return let(have, lambda v: F.zip_with(v, _after(v, step), merge))

    span = 1
    while span < upto:
        step = min(span, upto - span)
        values, span = merged(values, step), span + step
    return values


def fingerprints(hashes: Column, shared: int = SHARED, gram: int = GRAM) -> Column:
    """Of every window of `shared` words the smallest hash of `gram` of them, by the start of the window."""
    grams = _doubled(hashes, gram, lambda a, b: F.xxhash64(a, b))
    minima = _doubled(grams, shared - gram + 1, lambda a, b: F.least(a, b))
    return F.slice(minima, F.lit(1), F.greatest(F.size(hashes) - (shared - 1), F.lit(0)))


def whole_hashes(hashes: Column, length: int) -> Column:
    """Hash of every run of `length` words, by its start."""
    runs = reduce(lambda have, i: F.zip_with(have, _after(hashes, i), lambda a, b: F.xxhash64(a, b)), range(1, length), hashes)
    return F.slice(runs, F.lit(1), F.greatest(F.size(hashes) - (length - 1), F.lit(0)))


def _window(own: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(own, start + 1, length), " ")


def _found(own: Column, marks: Column, length: int, wanted: Callable[[Column], Column]) -> Column:
    """Start, length, fingerprint and words of the windows whose fingerprint is wanted."""
    passed = lambda m: F.array_compact(F.transform(m, lambda v, i: F.when(wanted(v), i)))
    window = lambda m: lambda i: F.struct(
        i.alias("start"), F.lit(length).alias("length"), F.get(m, i).alias("mark"), _window(own, i, F.lit(length)).alias("window")
    )
    return let(marks, lambda m: F.transform(passed(m), window(m)))


def windows_of(items: DataFrame, shared: int, gram: int, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """Distinct windows of the items (no, mark, window, length), and which item has which (no, item)."""
    own, size = F.col("own"), F.size("own")
    texts = items.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item"), words(F.col(text_column)).alias("own"))
    hashes = F.transform(own, lambda w: F.xxhash64(w))
    every = lambda _: F.lit(True)

    def whole(length: int) -> Column:
        return _found(own, let(hashes, lambda h: whole_hashes(h, length)), length, every)

    found = _found(own, let(hashes, lambda h: fingerprints(h, shared, gram)), shared, every)
    found = reduce(lambda other, n: F.when(size == n, whole(n)).otherwise(other), range(1, shared), found)
    each = scratch.written(texts.select("item", F.inline(found)).select("item", "mark", "window", "length").distinct(), "item-windows")
    known = scratch.written(each.select("mark", "window", "length").distinct().withColumn("no", F.monotonically_increasing_id()), "windows")
    uses = scratch.written(each.join(known, ["mark", "window", "length"]).select("no", "item"), "uses")
    return known, uses


def _filter(known: DataFrame) -> tuple[Column, int]:
    """A bit for each fingerprint, as one array of 64-bit numbers; and the number of bits."""
    bits = LEAST_BITS
    while bits < min(16 * known.count(), MOST_BITS):
        bits *= 2
    slot = F.col("mark").bitwiseAND(F.lit(bits - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    filled = known.groupBy(F.shiftright(slot, 6).alias("id")).agg(F.bit_or(one).alias("bits"))
    every = known.sparkSession.range(bits // 64).join(filled, "id", "left")
    dense = F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return every.agg(F.transform(dense, lambda x: x["bits"]).alias("filter")).scalar(), bits


def _spread(intervals: Column) -> Column:
    """How many places the intervals (start, length), ordered by start, cover together."""
    begin = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))

    def more(have: Column, x: Column) -> Column:
        end = F.greatest(have["end"], x["start"] + x["length"])
        return F.struct((have["n"] + end - F.greatest(have["end"], x["start"])).cast("long").alias("n"), end.alias("end"))

    return F.aggregate(intervals, begin, more, lambda x: x["n"])


def find(
    docs: DataFrame, items: DataFrame, shared: int = SHARED, gram: int = GRAM,
    text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Per document: `row` (its columns but the text), n_words, n_hit, n_items, and items, the ids found, sorted as strings."""
    known, uses = windows_of(items, shared, gram, item_column, item_text)
    bits, n_bits = _filter(known)
    short = sorted(r[0] for r in known.where(F.col("length") < shared).select("length").distinct().collect())

    def hits(own: Column) -> Column:
        def by_filter(have: Column) -> Column:
            def wanted(mark: Column) -> Column:
                slot = mark.bitwiseAND(F.lit(n_bits - 1))
                return F.getbit(F.get(have, F.shiftright(slot, 6).cast("int")), slot.bitwiseAND(F.lit(63)).cast("int")) == 1

            def of_hashes(h: Column) -> Column:
                parts = [_found(own, whole_hashes(h, n), n, wanted) for n in short]
                return F.concat(_found(own, fingerprints(h, shared, gram), shared, wanted), *parts)

            return let(F.transform(own, lambda w: F.xxhash64(w)), of_hashes)

        return let(F.col("filter"), by_filter)

    rest = F.struct(*[docs[c] for c in docs.columns if c != text_column])
    told = let(words(F.col(text_column)), lambda own: F.struct(F.size(own).cast("long").alias("n_words"), hits(own).alias("hits")))
    read = docs.select(rest.alias("row"), F.col(text_column), bits.alias("filter")).select("row", told.alias("told"))
    read = scratch.written(read.select(F.monotonically_increasing_id().alias("no_row"), "row", "told.*"), "read")

    met = read.where(F.size("hits") > 0).select("no_row", F.inline("hits")).join(known, ["mark", "window", "length"])
    places = F.sort_array(F.collect_list(F.struct("start", "length")))
    lists = met.groupBy("no_row").agg(_spread(places).alias("n_hit"), F.sort_array(F.collect_set("no")).alias("windows"))
    lists = scratch.written(lists.withColumn("key", F.sha2(F.array_join(F.col("windows").cast("array<string>"), ","), 256)), "lists")

    kinds = lists.groupBy("key").agg(F.first("windows").alias("windows"))
    item_lists = kinds.select("key", F.explode("windows").alias("no")).join(uses, "no").groupBy("key")
    item_lists = scratch.written(item_lists.agg(F.sort_array(F.collect_set("item")).alias("items")), "item-lists")

    found = scratch.written(lists.select("no_row", "n_hit", "key").join(item_lists, "key").drop("key"), "found")
    none = F.array().cast("array<string>")
    return read.select("no_row", "row", "n_words").join(found, "no_row", "left").select(
        "row", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", none).alias("items"),
    )
