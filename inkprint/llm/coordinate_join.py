"""MinHash near-duplicates by an inverted join over signature coordinates.

A text's set holds its distinct shingles of ``WIDTH`` words, hashed to 64 bits. Its signature has ``COORDINATES``
minima. Two sets are linked when ``100 * intersection >= PERCENT * union``; a text's class is its component.

Every set is posted under each (coordinate, value) of its signature. A pair is a candidate when it collides in at
least ``MATCHES`` coordinates, and every candidate is confirmed on the full sets:

- Values that one set alone has collide with nothing; a set with fewer than ``MATCHES`` others is out.
- *Prefix*: values are ordered by the length of their lists. Two sets with ``MATCHES`` collisions share a value among
  the first ``COORDINATES - MATCHES + 1`` of both, so only those lists, the short ones, are merged.
- *Skip*: the other lists are not merged. Collisions of a pair that met are counted from the packed signatures.

The threshold is far below what linked sets have (85 % of the coordinates): one link in some 10**7 at its very edge is
missed at 38 of 64, and as few at 186 of the 256 packed coordinates that are counted.

Sets with equal shingles are one set from the start. No list is expanded into all pairs: its sets are confirmed
against one hub, the set whose values have the longest lists, and those outside the list's largest component against
hubs of their own, ``ROUNDS`` times. What remains are pairs of different components; a pair is made in the first list
that it shares only, if sizes, packed coordinates and parity bits (as many bits differ as shingles differ, at most) allow
a link; a list's pairs are dealt over as many salts as they ask for. Before that, a set whose shingles are to less
than ``PERCENT`` % shared with any other candidate set is out, since it can have no link.

Odd rows: null, empty and blank texts have an empty set, are linked with nothing and are their own class. Rows with
a null id have a null class, are kept and are linked with nothing. Repeated rows share their class; rows that repeat an
id with another text are judged by their own text. A text of fewer than ``WIDTH`` words is one shingle. Long texts are
hashed whole, in slices. Ids may have any type that can be ordered. Other columns are ignored. An empty table gives an
empty result.
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

WIDTH, PERCENT = 5, 85
COORDINATES, MATCHES = 64, 38
#: Coordinates of four bits that are counted when two sets have met, and how many of them must agree.
PACKED, PACKED_MATCHES = 256, 186
#: Bits that hold the parity of the members hashed to them.
PARITY = 1024
#: Hubs that the sets outside a list's largest component are confirmed against, one after the other.
ROUNDS = 2
#: Rows of ids or pairs that may be broadcast after they have been counted; beyond, the join is shuffled.
BROADCAST_ROWS = 500_000
#: Pairs of one list that one salt may compare.
PAIRS_PER_SALT = 1 << 20
_ROWS = 500
_NIBBLES = 0x1111111111111111
_odd = np.random.default_rng(7011)
_TIMES = _odd.integers(1, 1 << 63, PACKED, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _odd.integers(1, 1 << 63, PACKED, np.int64).astype(np.uint64)


def checked(small: DataFrame, name: str) -> DataFrame:
    """The frame, stored, with a broadcast hint only where its counted size allows it."""
    stored = materialize(small, name)
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def minima(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """Per set and coordinate, the least hash of its members; one row of zeros for an empty set."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.zeros((len(sets), coordinates), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        members = np.concatenate([sets[k] for k in full])
        starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        for k in range(coordinates):
            out[full, k] = np.minimum.reduceat((members + _PLUS[k]) * _TIMES[k], starts)
    return out


def packed(lows: np.ndarray) -> np.ndarray:
    """Four bits of every coordinate, sixteen coordinates in a 64-bit word."""
    bits = (mix(lows) & np.uint64(15)).reshape(len(lows), PACKED // 16, 16)
    return np.bitwise_or.reduce(bits << (np.arange(16, dtype=np.uint64) * np.uint64(4)), axis=2)


def parity(sets: list[np.ndarray]) -> np.ndarray:
    """Per set, whether each of ``PARITY`` cells holds an odd number of its members."""
    odd = [np.bincount((mix(s ^ _PLUS[0]) % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) & 1 for s in sets]
    return np.packbits(np.array(odd, np.uint8).reshape(len(sets), PARITY), axis=1).view(np.uint64)


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *[len(r) for r in rows]])
    values = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    return pa.LargeListArray.from_arrays(ends, values.view(np.int64)).cast(pa.list_(pa.int64()))


def _profiles(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Per text: size and 128-bit fingerprint of its set, and its signature with the coordinate hashed into each value."""
    places = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64))
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            sets = list(shingle_sets(part.column("text").to_pylist(), width))
            one = [int(mix(s).sum(dtype=np.uint64).view(np.int64)) for s in sets]
            two = [int(np.bitwise_xor.reduce(mix(s + np.uint64(_NIBBLES))).view(np.int64)) if len(s) else 0 for s in sets]
            values = mix(minima(sets, COORDINATES) ^ places)
            posted = _lists([values[k] if len(s) else values[k, :0] for k, s in enumerate(sets)])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(one, pa.int64()),
                                              pa.array(two, pa.int64()), posted], names=["doc_id", "n", "f1", "f2", "posted"])


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            sets = list(shingle_sets(part.column("text").to_pylist(), width))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), _lists(sets),
                                              _lists(list(np.hstack([packed(minima(sets, PACKED)), parity(sets)])))], names=["id", "n", "tokens", "sketch"])


def _words(side: str) -> list[Column]:
    """The sketch as columns that cannot be null: a comparison of two sketches must stay small enough to be compiled."""
    return [F.coalesce(F.col("sketch")[k], F.lit(0).cast("bigint")).alias(f"{side}{k}") for k in range(PACKED // 16 + PARITY // 64)]


def _collisions_allow(a: str, b: str) -> Column:
    """Whether the packed coordinates of two sketches agree often enough."""
    def differ(k: int) -> Column:
        x = F.col(f"{a}{k}").bitwiseXOR(F.col(f"{b}{k}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(_NIBBLES)))

    return sum((differ(k) for k in range(PACKED // 16)), F.lit(0)) <= PACKED - PACKED_MATCHES


def _parity_allows(a: str, b: str, na: str, nb: str, percent: int) -> Column:
    """Whether no more parity bits differ than members of linked sets of these sizes may."""
    words = range(PACKED // 16, PACKED // 16 + PARITY // 64)
    differ = sum((F.bit_count(F.col(f"{a}{k}").bitwiseXOR(F.col(f"{b}{k}"))) for k in words), F.lit(0))
    return (100 + percent) * differ <= (100 - percent) * (F.col(na) + F.col(nb))


def _sizes_allow(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked, compared row by row on their full sets."""
    stored = materialize(pairs, "pairs")
    ends = checked(stored.select(F.col("b").alias("id")).distinct(), "ends")
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta")).join(checked(stored, "met"), "a")
    right = sets.join(ends, "id", "left_semi").select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb")).cast("bigint")
    compared = left.join(right, "b").select("a", "b", "na", "nb", both.alias("both"))
    return materialize(compared.where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b"), "links")


def _with_hubs(posts: DataFrame, percent: int) -> DataFrame:
    """Each set with the hubs of the lists it is in, where they have different components; a hub has the greatest weight."""
    hubs = posts.groupBy("token").agg(F.max(F.struct("weight", "id", "n", "component")).alias("h"), F.count("*").alias("length")).where("length > 1")
    hubs = hubs.select("token", F.col("h.id").alias("b"), F.col("h.n").alias("nb"), F.col("h.component").alias("cb"))
    met = posts.join(hubs, "token").where((F.col("component") != F.col("cb")) & _sizes_allow("n", "nb", percent))
    return met.select(F.col("id").alias("a"), "b").distinct()


def _mixed(posts: DataFrame) -> DataFrame:
    """Lists of several components: token, the component with most sets, and the salts that their pairs are dealt over."""
    sides = posts.groupBy("token", "component").agg(F.count("*").alias("k"))
    lists = sides.groupBy("token").agg(F.max(F.struct("k", "component")).alias("top"), F.sum("k").alias("length"), F.count("*").alias("sides")).where("sides > 1")
    others = F.col("length") - F.col("top.k")
    salts = F.least(others, F.ceil(others * F.col("length") / PAIRS_PER_SALT)).cast("int")
    return lists.select("token", F.col("top.component").alias("main"), salts.alias("salts"))


def _across(posts: DataFrame, sets: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a list and whose sizes, collisions and parity allow a link."""
    open_ = materialize(posts.join(_mixed(posts), "token").join(sets, "id").join(prefixes, "id"), "open")
    few = open_.where("component <> main").select("token", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int").alias("salt"), F.col("id").alias("a"),
                                                  F.col("n").alias("na"), F.col("component").alias("ca"), *_words("sa"),
                                                  F.col("prefix").alias("pa"))
    rest = open_.select("token", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("id").alias("b"), F.col("n").alias("nb"),
                        F.col("component").alias("cb"), *_words("sb"), F.col("prefix").alias("pb"), (F.col("component") == F.col("main")).alias("mb"))
    once = F.col("mb") | (F.col("a") < F.col("b"))  # two sets outside the main component meet twice
    first = F.array_intersect("pa", "pb")[0] == F.col("token")
    met = few.join(rest, ["token", "salt"]).where((F.col("ca") != F.col("cb")) & once & _sizes_allow("na", "nb", percent)
            & _parity_allows("sa", "sb", "na", "nb", percent) & _collisions_allow("sa", "sb") & first)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _candidates(reps: DataFrame) -> DataFrame:
    """Sets with enough collisions: id, n, weight and the prefix of their values, shortest lists first."""
    posted = reps.select(F.col("rep").alias("id"), "n", F.explode("posted").alias("token"))
    lengths = checked(posted.groupBy("token").agg(F.count("*").alias("length")).where("length > 1"), "lengths")
    met = posted.join(lengths, "token").groupBy("id", "n").agg(F.sum("length").alias("weight"), F.collect_list(F.struct("length", "token")).alias("met"))
    prefix = F.slice(F.sort_array("met"), F.lit(1), F.size("met") - (MATCHES - 1))["token"]
    return materialize(met.where(F.size("met") >= MATCHES).select("id", "n", "weight", prefix.alias("prefix")), "candidates")


def classes(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (least id reachable) and kept of every row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    told = materialize(texts.mapInArrow(lambda x: _profiles(x, width), f"doc_id {kind}, n bigint, f1 bigint, f2 bigint, posted array<bigint>"), "profiles")
    named = told.where("doc_id is not null and n > 0")
    reps = materialize(named.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("rep"), F.first("posted").alias("posted")), "reps")
    found = _candidates(reps)

    ids = checked(found.select(F.col("id").alias("doc_id")), "ids")
    sets = materialize(texts.join(ids, "doc_id", "left_semi").mapInArrow(
        lambda x: _sets(x, width), f"id {kind}, n bigint, tokens array<bigint>, sketch array<bigint>"), "sets")
    alone = sets.select("id", F.explode("tokens").alias("token")).groupBy("token").agg(F.min("id").alias("id"), F.max("id").alias("last"))
    alone = alone.where("id = last").groupBy("id").agg(F.count("*").alias("alone"))
    may = found.join(alone, "id", "left").where(100 * (F.col("n") - F.coalesce("alone", F.lit(0))) >= percent * F.col("n"))
    posts = materialize(may.select("id", "n", "weight", F.explode("prefix").alias("token")), "posts")

    links = _confirmed(_with_hubs(posts.withColumn("component", F.col("id")), percent), sets, percent)
    final = components(links)
    labels = lambda: materialize(posts.join(final, "id", "left").withColumn("component", F.coalesce("component", "id")), "labelled")
    joined = lambda more: components(final.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more))
    labelled = labels()
    for _ in range(ROUNDS):
        outside = labelled.join(_mixed(labelled), "token").where("component <> main")
        more = _confirmed(_with_hubs(outside.drop("main", "salts"), percent), sets, percent)
        if more.isEmpty():
            break
        final = joined(more)
        labelled = labels()
    last = _confirmed(_across(labelled, sets.select("id", "sketch"), found.select("id", "prefix"), percent), sets, percent)
    if not last.isEmpty():
        final = joined(last)

    of_set = reps.join(final, F.col("rep") == F.col("id"), "left").select("n", "f1", "f2", F.coalesce("component", "rep").alias("component"))
    own = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")))
    judged = told.select("doc_id", "n", "f1", "f2").join(of_set, ["n", "f1", "f2"], "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
    return judged.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Rows of ``docs`` whose id is the least of its class; rows with a null id are kept."""
    gone = checked(classes(docs, width, percent).where(~F.col("kept")).select(F.col("doc_id").alias("_copy")).distinct(), "copies")
    return docs.join(gone, docs["doc_id"] == gone["_copy"], "left_anti")
