"""N-gram Jaccard join: exact clusters of texts whose shingle sets overlap, by several global token orders.

A text's set holds its distinct shingles of ``WIDTH`` words (64-bit hashes of A-Z lower-cased words). Two
sets are linked when ``100 * intersection >= PERCENT * union`` (90 below, as an example); a text's class is its component.

Texts with equal sets are one set from the start. For the others, every filter below is a necessary
condition of a link, so none loses one:

1. Order one, by hash. Linked sets share at least l tokens of their prefixes of length
   ``n - ceil(0.9 n) + l``. Each set posts such a prefix; a set with too few tokens that any other set
   posted is out.
2. Sets that remain post all their tokens. Let s be the number that occur in another remaining set. No
   link can have more than s common tokens, so ``10 s < 9 n`` is out. That ends large groups of loosely
   similar copies, whose own changes are tokens nobody else has.
3. Order two puts those unshared tokens first and the others by a second hash. Linked sets share a token of
   the prefix of length ``n - ceil(0.9 n) + 1``. Sets that meet in a token become candidates.
4. Candidates must share a prefix token under a third order as well, and under the first, before the sets
   are intersected.

Groups are never expanded into all pairs. Within a token, all sets are first paired with one hub, a set with few
unshared tokens; verified pairs give components. What remains is pairs of different components in one
token: only sets outside the token's largest component are paired, by equality of token and size cell,
with sets of a size that their own s allows and whose parity sketch (of each hash cell, whether it holds an odd
number of tokens) differs in no more bits than linked sets may differ in tokens.

Rows without words have an empty set, class and links of their own. Null ids get null classes and
are linked with nothing. Repeated rows share their class. ``doc_id`` names one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from inkprint.functions.shipping import ship_with_job
from inkprint.llm.graph import components
from inkprint.llm.shingles import mix, shingle_sets
from inkprint.session import materialize

ship_with_job(__name__)

WIDTH = 3
PERCENT = 90
#: Rows of (id) or (id, id) that may be broadcast after they have been counted; beyond, the join is shuffled.
BROADCAST_ROWS = 500_000
#: 64-bit words of the parity sketch that tells apart sets of one group of copies.
PARITY_WORDS = 8
_ORDER_TWO, _PARITY = 0x51ED270B3F4C1A2D, 0x2C1B3C6D94D049BB


def checked(small: DataFrame) -> DataFrame:
    """The frame, stored, with a broadcast hint only where its counted size allows it."""
    stored = materialize(small, "small")
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *[len(a) for a in arrays]])
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.LargeListArray.from_arrays(ends, values.view(np.int64)).cast(pa.list_(pa.int64()))


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _profiles(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Per text: size, 128-bit fingerprint of its set, prefix under order one."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            sets = list(shingle_sets(part.column("text").to_pylist(), width))
            f1 = [int(mix(s).sum(dtype=np.uint64).view(np.int64)) for s in sets]
            f2 = [int(np.bitwise_xor.reduce(mix(s ^ np.uint64(_ORDER_TWO))).view(np.int64)) if len(s) else 0 for s in sets]
            posted = [s[: prefix_length(len(s), percent) + len(s) // 10] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(f1, pa.int64()),
                 pa.array(f2, pa.int64()), _lists(posted)], names=["doc_id", "n", "f1", "f2", "posted"])


def _tokens(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            sets = list(shingle_sets(part.column("text").to_pylist(), width))
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), _lists(sets)],
                                             names=["id", "n", "tokens"])


def profiles(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    told = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return told.mapInArrow(lambda x: _profiles(x, width, percent), "doc_id bigint, n bigint, f1 bigint, f2 bigint, posted array<bigint>")


def _unshared(postings: DataFrame, by: str) -> DataFrame:
    """Tokens that a single ``by`` posts, with it. One shuffle of (token, by), combined before it."""
    once = postings.groupBy("token").agg(F.min(by).alias(by), F.max(by).alias("_last")).where(F.col(by) == F.col("_last"))
    return once.select(by, "token")


def _order_two(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Prefix of order two without its unshared tokens, and the parity sketch of the set."""
    for whole in batches:
        for first in range(0, whole.num_rows, 500):
            batch = whole.slice(first, 500)
            found, parity = [], []
            for tokens, alone in zip(batch.column("tokens"), batch.column("unshared")):
                own = np.array(tokens.values, np.int64).view(np.uint64)
                skip = np.array(alone.values, np.int64).view(np.uint64) if alone.is_valid else np.zeros(0, np.uint64)
                rest = own[~np.isin(own, skip)]
                ranked = rest[np.argsort(mix(rest ^ np.uint64(_ORDER_TWO)))]
                found.append(ranked[: max(0, prefix_length(len(own), percent) - len(skip))])
                bits = np.bincount((mix(own ^ np.uint64(_PARITY)) % np.uint64(64 * PARITY_WORDS)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
                parity.append(np.packbits(bits.astype(np.uint8)).view(np.uint64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n"), batch.column("s"), _lists(found), _lists(parity)],
                                             names=["id", "n", "s", "prefix", "parity"])


def _overlaps(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with their sizes and exact number of common tokens; 0 where orders one or three exclude them.

    Sets are compared row by row where the join puts them, so memory follows the longest pair, not a batch.
    """
    stored = materialize(pairs, "pairs")
    hubs = checked(stored.select(F.col("b").alias("id")).distinct())
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta")).join(checked(stored), "a")
    right = sets.join(hubs, "id", "left_semi").select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    length = lambda n: F.expr(f"{n} - ({percent} * {n} + 99) div 100 + 1").cast("int")
    third = lambda t, n: F.slice(F.sort_array(F.transform(t, lambda x: F.xxhash64(F.lit(3), x))), F.lit(1), length(n))
    one = F.arrays_overlap(F.slice("ta", F.lit(1), length("na")), F.slice("tb", F.lit(1), length("nb")))
    three = F.arrays_overlap(third("ta", "na"), third("tb", "nb"))
    shared = F.when(one, F.when(three, F.size(F.array_intersect("ta", "tb")).cast("bigint")))
    return materialize(left.join(right, "b").select("a", "b", "na", "nb", F.coalesce(shared, F.lit(0)).alias("shared")), "overlaps")


def _links(overlaps: DataFrame, percent: int) -> DataFrame:
    return overlaps.where(100 * F.col("shared") >= percent * F.expr("na + nb - shared")).select("a", "b")


def _may_link(na: Column, sa: Column, nb: Column, sb: Column, percent: int) -> Column:
    """Whether the sizes and shared tokens of two sets allow a link."""
    return (100 + percent) * F.least(sa, sb) >= percent * (na + nb)


def _may_match(left: str, right: str, percent: int) -> Column:
    """Whether the parity sketches allow a link: bits that differ are at most the tokens that differ."""
    differ = sum((F.bit_count(F.col(f"{left}{k}").bitwiseXOR(F.col(f"{right}{k}"))) for k in range(PARITY_WORDS)), F.lit(0))
    return (100 + percent) * differ <= (100 - percent) * (F.col(f"n{left}") + F.col(f"n{right}"))


def _cell(n: Column) -> Column:
    """Sizes below 128 one by one, then 64 cells per power of two."""
    shift = F.length(F.bin(n)) - 7
    return F.when(n < 128, n).otherwise(shift * 64 + F.floor(n / F.pow(F.lit(2), shift))).cast("bigint")


def _hub_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """Each set with the hubs of its tokens.

    A token's first choice is its set with the fewest unshared tokens; its hub is the one of its sets that most
    tokens chose, so that the tokens of one group of copies agree on one hub.
    """
    chosen = postings.groupBy("token").agg(F.min(F.struct((F.col("n") - F.col("s")).alias("u"), F.col("id"))).alias("h"), F.count("*").alias("df"))
    votes = chosen.where("df > 1").groupBy(F.col("h.id").alias("id")).agg(F.count("*").alias("votes"))
    ranked = postings.join(votes, "id")
    hubs = ranked.groupBy("token").agg(F.max(F.struct("votes", "s", "id", "n")).alias("h"))
    hubs = hubs.select("token", F.col("h.id").alias("b"), F.col("h.n").alias("nb"), F.col("h.s").alias("sb"))
    met = postings.join(hubs, "token").where("id <> b").where(_may_link(F.col("n"), F.col("s"), F.col("nb"), F.col("sb"), percent))
    return met.select(F.col("id").alias("a"), "b").distinct()


def _rest_pairs(postings: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a token; ``postings`` has the component of each set.

    ``known`` has the parity sketch of each set; pairs whose sketches differ too much are not made.
    """
    sides = postings.groupBy("token", "component").agg(F.count("*").alias("k"))
    largest = sides.groupBy("token").agg(F.max(F.struct("k", "component")).alias("top"), F.count("*").alias("sides"))
    mixed = largest.where("sides > 1").select("token", F.col("top.component").alias("main"))
    open_ = materialize(postings.join(mixed, "token").withColumn("cell", _cell(F.col("n"))).join(known, "id"), "open")
    side = lambda frame, x: frame.select("token", "cell", F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("s").alias(f"s{x}"),
                                         F.col("component").alias(f"c{x}"), *[F.col("parity")[k].alias(f"{x}{k}") for k in range(PARITY_WORDS)])
    least, most = F.expr(f"({percent} * n + 99) div 100"), F.expr(f"({100 + percent} * s) div {percent} - n")
    few = open_.where("component <> main").withColumn("lo", _cell(least)).withColumn("hi", _cell(most)).where("lo <= hi")
    few = side(few.withColumn("cell", F.explode(F.sequence("lo", "hi"))), "a")
    met = few.join(side(open_, "b"), ["token", "cell"])
    met = met.where((F.col("ca") != F.col("cb")) & _may_link(F.col("na"), F.col("sa"), F.col("nb"), F.col("sb"), percent) & _may_match("a", "b", percent))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def classes(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``."""
    told = materialize(profiles(docs, width, percent), "profiles")
    named = told.where("doc_id is not null and n > 0")
    reps = materialize(named.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("rep")), "reps")

    # Order one: sets with enough posted tokens that other sets posted too.
    posted = named.select("f1", F.explode("posted").alias("token"))
    alone = _unshared(posted, "f1").groupBy("f1").agg(F.count("*").alias("alone"))
    least = F.expr(f"n - ({percent} * n + 99) div 100 + 1 + n div 10 - coalesce(alone, 0) >= 1 + ({percent} * n) div 1000")
    survivors = checked(reps.join(alone, "f1", "left").where(least).select(F.col("rep").alias("id")))

    # All tokens of the sets that remain; those that no other of them has.
    text = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    left = text.join(survivors, F.col("doc_id") == F.col("id"), "left_semi")
    sets = materialize(left.mapInArrow(lambda x: _tokens(x, width), "id bigint, n bigint, tokens array<bigint>"), "sets")
    own = materialize(_unshared(sets.select("id", F.explode("tokens").alias("token")), "id"), "unshared").groupBy("id").agg(
        F.collect_list("token").alias("unshared"))
    near = sets.join(own, "id", "left").withColumn("s", F.col("n") - F.coalesce(F.size("unshared"), F.lit(0))).where(100 * F.col("s") >= percent * F.col("n"))
    two = materialize(near.select("id", "n", F.col("s").cast("bigint").alias("s"), "tokens", "unshared").mapInArrow(
        lambda x: _order_two(x, percent), "id bigint, n bigint, s bigint, prefix array<bigint>, parity array<bigint>"), "two")
    postings, known = two.select("id", "n", "s", F.explode("prefix").alias("token")), two.select("id", "parity")

    star = _links(_overlaps(_hub_pairs(postings, percent), sets, percent), percent)
    labelled = postings.join(components(star), "id", "left").withColumn("component", F.coalesce("component", "id"))
    rest = _links(_overlaps(_rest_pairs(materialize(labelled, "labelled"), known, percent), sets, percent), percent)
    final = components(star.union(rest))

    of_set = reps.join(final, F.col("rep") == F.col("id"), "left").select("n", "f1", "f2", F.coalesce("component", "rep").alias("component"))
    rows = told.select("doc_id", "n", "f1", "f2").alias("t").join(of_set.alias("c"), ["n", "f1", "f2"], "left")
    own_class = F.when(F.col("n") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), own_class).alias("component_id"))


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Rows of ``docs`` that are the least id of their class; rows with null ids are kept."""
    found = classes(docs, width, percent)
    copies = checked(found.where("doc_id <> component_id").select(F.col("doc_id").alias("_copy")).distinct())
    return docs.join(copies, docs["doc_id"].cast("bigint") == copies["_copy"], "left_anti")
