"""Benchmark decontamination: containment search for short items inside long documents.

Both sides are cut into windows of ``WIDTH`` words, lower-cased and without ASCII punctuation. An
item is contained when at least ``SIMILARITY`` of its distinct windows occur in the document.

Search. Items are partitioned by size (powers of two of their number of windows). An item is
represented by its MinHash sketch: the k of its windows with the smallest hashes, where k is
one more than the number of windows a contained item may lack. By the pigeonhole principle a
document that contains the item holds at least one sketch window, and at least k minus the
missing ones, so the search loses nothing. A document is tested for sketch windows, never for
its own MinHash, hence its length does not matter; documents with fewer windows than an item needs
are passed over, partition by partition.

Verification. For each candidate the exact share of the item's windows in the document is computed.

Everything stays in the row of its document: texts are read once and never shuffled. The items are
searched in blocks whose windows number at most ``BLOCK_WINDOWS`` (a longer single item makes a block
of its own), one pass over the documents per block, so what each task holds is bounded however
large the benchmark grows.

Items with fewer words than a window are one window of their own length; items without words match
nothing. Null text counts as empty, null ids are carried as they are, repeated rows are reported each.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from inkprint.llm.words import let, packed, text_of, unpacked, window_hashes, words

WIDTH = 5
SIMILARITY = (4, 5)
BLOCK_WINDOWS = 20_000
PUNCTUATION = r"""[!-/:-@\[-`{-~]+"""


def tokens(text: Column) -> Column:
    return words(F.regexp_replace(F.lower(text), PUNCTUATION, ""))


def allowed_missing(n: Column) -> Column:
    num, den = SIMILARITY
    return F.floor((den - num) * n / den).cast("int")


def item_windows(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """item_id, width of its windows, its distinct windows by hash, their number and its size class."""
    cut = F.least(F.lit(width), F.size("_w"))
    by_width = F.array().cast("array<bigint>")
    for k in range(1, width + 1):
        by_width = F.when(cut == k, window_hashes(F.col("_w"), k)).otherwise(by_width)
    told = items.select("item_id", tokens(text_of("text")).alias("_w"))
    told = told.select("item_id", cut.alias("width"), F.sort_array(F.array_distinct(by_width)).alias("windows"))
    told = told.withColumn("n_windows", F.size("windows")).where("n_windows > 0")
    return told.withColumn("size_class", F.floor(F.log2("n_windows")).cast("int"))


def sketched(items: DataFrame) -> DataFrame:
    """MinHash sketch of each item; window hashes are uniform, so their order is the MinHash order."""
    k = allowed_missing(F.col("n_windows")) + 1
    return items.withColumn("sketch", F.slice("windows", F.lit(1), k))


def blocks(items: DataFrame, most: int = BLOCK_WINDOWS) -> Iterator[list]:
    """Items in blocks of at most ``most`` windows, in order of size class."""
    block, held = [], 0
    for item in items.orderBy("size_class", "item_id").toLocalIterator():
        if block and held + item.n_windows > most:
            yield block
            block, held = [], 0
        block.append(item)
        held += item.n_windows
    if block:
        yield block


def _constant(value, kind: str) -> Column:
    """One literal array instead of one expression per element."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _search(rows: DataFrame, block: list, names: list[str], carry: list[Column]) -> DataFrame:
    """Rows with the block's items that they contain, as ``found``."""
    widths = sorted({item.width for item in block})
    slots = 1 << max(10, (8 * sum(len(item.sketch) for item in block)).bit_length())
    table = [False] * slots
    for item in block:
        for h in item.sketch:
            table[h % slots] = True
    taken, sketch = _constant(table, "array<boolean>"), _constant(sorted({h for i in block for h in i.sketch}), "array<bigint>")
    entries = [{"id": i.item_id, "n": i.n_windows, "w": i.width, "s": list(i.sketch), "a": list(i.windows)} for i in block]
    entry = _constant(entries, "array<struct<id:bigint,n:int,w:int,s:array<bigint>,a:array<bigint>>>")

    def held(t: Column) -> Column:
        parts = [window_hashes(t, k) for k in widths]
        return parts[0] if len(parts) == 1 else F.concat(*parts)

    def verified(all_windows: Column, hits: Column) -> Column:
        num, den = SIMILARITY
        enough = lambda e: F.size(all_windows) * den >= num * e["n"]
        near = F.filter(entry, lambda e: enough(e) & F.arrays_overlap(e["s"], hits))
        shared = F.transform(near, lambda e: F.struct(
            e["id"].alias("item_id"), e["n"].alias("n_windows"), F.size(F.array_intersect(e["a"], all_windows)).alias("n_shared")))
        return F.filter(shared, lambda e: e["n_shared"] * den >= num * e["n_windows"])

    def of_windows(x: Column) -> Column:
        likely = F.filter(x, lambda h: taken[F.pmod(h, F.lit(slots)).cast("int")])
        return let(F.array_intersect(likely, sketch), lambda hits: F.when(F.size(hits) > 0, verified(x, hits)))

    found = let(tokens(text_of("text")), lambda t: let(held(t), of_windows))
    return rows.select(*names, *carry, F.explode(F.array(found)).alias("found"))


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document row and contained item: doc_id, item_id, n_windows, n_shared."""
    known = sketched(item_windows(items))
    out = docs.sparkSession.createDataFrame([], docs.select("doc_id").schema.simpleString()[7:-1] + ", item_id bigint, n_windows int, n_shared int")
    for block in blocks(known):
        got = _search(docs.select("doc_id", "text"), block, ["doc_id"], [])
        out = out.unionByName(got.select("doc_id", F.inline("found")))
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs`` that contain no item, with the columns they came with."""
    rows = docs.select(packed(docs).alias("_row"), "text")
    for block in blocks(sketched(item_windows(items))):
        got = _search(rows, block, ["_row"], [F.col("text")])
        rows = got.where("found is null or size(found) = 0").drop("found")
    return unpacked(rows, docs.columns)
