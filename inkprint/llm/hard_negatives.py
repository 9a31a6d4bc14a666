"""Hard negatives: for each anchor and positive, the best rows of another label within a window of scores.

Vectors become integers (floor of 256 times each component) and a score is an inner product. All rows are placed in a
multiway hyperplane tree (``gnat``), whose leaves are exact: every row of a leaf that survives is scored.

1. The tree is fitted on ``SAMPLE`` rows (the first in hash order); then every row is placed and the ranges and norms
   of all rows are taken.
2. Leaves are packed into shards; a leaf with more rows than a shard holds is dealt over several.
3. Positives: anchors look into the leaf they belong to, which bounds their k-th best score, then into all shards
   with a leaf that the bound does not eliminate.
4. Negatives: the windows of an anchor's positives are its annuli; leaves outside them are eliminated, within a
   shard also by the scores found so far.

Anchors are sent to shards in Arrow batches and scored in blocks; a task holds one shard. No pair of anchor and row is
written but those that are among the best of a shard.

Odd rows: rows with a null id, label or vector, or with a null or non-finite component take no part, nor do those whose
squared integer norm reaches 2**55, since a hundred times their scores would not fit a long. Of rows that share an id, the least by label,
then vector, counts. Shorter vectors, empty ones too, are read with zeros at their end. Equal scores go by the smaller
id. A positive without a negative in its window, or with a score below zero, gives no row. Other columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from inkprint.functions.shipping import ship_with_job
from inkprint.llm.gnat import Tree
from inkprint.session import materialize

ship_with_job(__name__)

SCALE, N_LABELS, WRONG_EVERY, ANCHOR_EVERY = 256, 10, 7, 50
POSITIVES, NEGATIVES = 5, 3
#: A negative's score is from LEAST to MOST per cent of the positive's.
LEAST, MOST = 50, 95
#: Rows the tree is fitted on, at most.
SAMPLE = 8192
#: Shards of small tables (for parallelism) and rows of a shard of large ones (for memory).
SHARDS, SHARD_ROWS, FEWEST = 64, 1 << 20, 512
_BLOCK, _CHUNK = 512, 8192
_FOUND = "anchor bigint, slot int, id bigint, score bigint"


def prepared(rows: DataFrame) -> DataFrame:
    """id, label and vec (array of int) of the rows that take part."""
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
              & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    scaled = F.transform("embedding", lambda x: F.floor(SCALE * x.cast("double")))
    square = F.aggregate(F.transform("embedding", lambda x: F.pow(F.floor(SCALE * x.cast("double")).cast("double"), F.lit(2.0))), F.lit(0.0), lambda a, x: a + x)
    label = F.when(F.col("vec_id") % WRONG_EVERY == 0, (F.col("label") + 1) % N_LABELS).otherwise(F.col("label")).cast("bigint")
    kept = rows.where(usable).where(square < float(2 ** 55))
    told = kept.select(F.col("vec_id").cast("bigint").alias("id"), F.struct(label.alias("label"), scaled.cast("array<int>").alias("vec")).alias("row"))
    return told.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.label", "row.vec")


def _matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    ends = np.asarray(vectors.offsets)
    values, sizes = np.asarray(vectors.values)[ends[0]:ends[-1]], np.diff(ends)
    out = np.zeros((len(vectors), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _placed(batches: Iterator[pa.RecordBatch], tree: Tree, width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        leaves, _ = tree.place(_matrix(batch.column("vec"), width))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.int32())], names=[*batch.schema.names, "leaf"])


def _ranges(batches: Iterator[pa.RecordBatch], tree: Tree, width: int) -> Iterator[pa.RecordBatch]:
    """Distance ranges (node, point, child), squared norms and counts (node -1, leaf) of the rows of a task."""
    held: dict[tuple[int, int, int], list[float]] = {}
    for batch in batches:
        rows = _matrix(batch.column("vec"), width)
        leaves, ranges = tree.place(rows)
        norms = (rows ** 2).sum(1)
        told = [(key, low, high, 0) for key, (low, high) in ranges.items()]
        for leaf in np.unique(leaves):
            own = norms[leaves == leaf]
            told.append(((-1, int(leaf), 0), own.min(), own.max(), len(own)))
        for key, low, high, n in told:
            a, b, k = held.get(key, (np.inf, -np.inf, 0))
            held[key] = [min(a, low), max(b, high), k + n]
    columns = list(zip(*[(*key, *v) for key, v in held.items()])) or [()] * 6
    kinds = [pa.int32()] * 3 + [pa.float64()] * 2 + [pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["node", "i", "j", "low", "high", "n"])


class _Shard:
    """The rows of one shard, by leaf, and the search for what blocks of anchors want of them."""

    def __init__(self, tree: Tree, leaf: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.tree = tree
        order = np.lexsort((ids, leaf))
        leaf, self.ids, self.labels, self.rows = leaf[order], ids[order], labels[order], rows[order]
        self.leaves, starts = np.unique(leaf, return_index=True)
        self.spans = list(zip(starts, [*starts[1:], len(leaf)]))
        self.most = np.sqrt((self.rows ** 2).sum(1).max(initial=0))

    def _scores(self, queries: np.ndarray, at: slice) -> np.ndarray:
        rows = self.rows[at]
        if self.most * np.sqrt((queries ** 2).sum(1).max(initial=0)) < 2 ** 52:
            return (queries @ rows.T).astype(np.int64)  # every partial sum is an exact double
        return queries.astype(np.int64) @ rows.T.astype(np.int64)

    def find(self, ids: np.ndarray, labels: np.ndarray, queries: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool) -> tuple[np.ndarray, ...]:
        """(query, slot, id, score) of the k best rows of each window (low, high: queries x slots)."""
        kept = tuple(np.zeros(0, np.int64) for _ in range(4))
        need, to_points, norm2 = low.copy(), self.tree.point_distances(queries), (queries ** 2).sum(1)
        home = self.tree.nearest(list(self.leaves), to_points)
        for first in (True, False):
            for place, (leaf, (a, b)) in enumerate(zip(self.leaves, self.spans)):
                mine = (home == place) == first
                wanted = need <= high
                least, most = np.where(wanted, need, np.iinfo(np.int64).max).min(1), np.where(wanted, high, np.iinfo(np.int64).min).max(1)
                mine &= wanted.any(1)
                mine[mine] &= self.tree.survives(int(leaf), [d[mine] for d in to_points], norm2[mine], least[mine].astype(float), most[mine].astype(float))
                asking = np.flatnonzero(mine)
                for at in range(a, b, _CHUNK if len(asking) else b - a + 1):
                    if not len(asking):
                        break
                    part = slice(at, min(b, at + _CHUNK))
                    scores = self._scores(queries[asking], part)
                    fits = (labels[asking, None] == self.labels[part]) == same
                    fits &= (scores >= least[asking, None]) & (scores <= most[asking, None]) & (ids[asking, None] != self.ids[part])
                    q, r = np.nonzero(fits)
                    s = scores[q, r]
                    found = [kept]
                    for slot in range(low.shape[1]):
                        inside = (s >= need[asking[q], slot]) & (s <= high[asking[q], slot])
                        found.append((asking[q[inside]], np.full(inside.sum(), slot), self.ids[part][r[inside]], s[inside]))
                    kept, full = _best(tuple(np.concatenate(c) for c in zip(*found)), k)
                    need[full[0], full[1]] = full[3]
        return kept


def _best(found: tuple[np.ndarray, ...], k: int) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """The k best per (query, slot), ties by id, and the k-th of those that have k."""
    query, slot, ids, score = found
    order = np.lexsort((ids, -score, slot, query))
    query, slot, ids, score = (x[order] for x in found)
    new = np.ones(len(query), bool)
    new[1:] = (query[1:] != query[:-1]) | (slot[1:] != slot[:-1])
    starts = np.flatnonzero(new)
    rank = np.arange(len(query)) - np.repeat(starts, np.diff([*starts, len(query)]))
    take, last = rank < k, rank == k - 1
    return tuple(x[take] for x in (query, slot, ids, score)), tuple(x[last] for x in (query, slot, ids, score))


def _searched(batches: Iterator[pa.RecordBatch], tree: Tree, width: int, k: int, same: bool) -> Iterator[pa.RecordBatch]:
    """Rows come by shard, those of the index (no window) before the anchors that ask."""
    current, parts, shard = None, [], None
    for batch in batches:
        shards = np.asarray(batch.column("shard"))
        cuts = np.flatnonzero(np.diff(shards)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(shards)] if len(shards) else []):
            if shards[a] != current:
                current, parts, shard = shards[a], [], None
            span = batch.slice(a, b - a)
            asks = np.asarray(span.column("asks"))
            split = int(np.searchsorted(asks, True))
            if split:
                own = span.slice(0, split)
                parts.append([np.asarray(own.column("leaf")), np.asarray(own.column("id")), np.asarray(own.column("label")), _matrix(own.column("vec"), width)])
            for at in range(split, len(asks), _BLOCK):
                if shard is None:
                    if not parts:
                        break
                    shard = _Shard(tree, *(np.concatenate(c) for c in zip(*parts)))
                part = span.slice(at, _BLOCK)
                ids, slots = np.asarray(part.column("id")), len(part.column("low")[0])
                low, high = (np.asarray(part.column(c).flatten()).reshape(-1, slots) for c in ("low", "high"))
                query, slot, found, score = shard.find(ids, np.asarray(part.column("label")), _matrix(part.column("vec"), width), low, high, k, same)
                yield pa.RecordBatch.from_arrays([pa.array(ids[query]), pa.array(slot, pa.int32()), pa.array(found), pa.array(score)], names=["anchor", "slot", "id", "score"])


def _asked(batches: Iterator[pa.RecordBatch], tree: Tree, width: int, shards: dict[int, list[int]]) -> Iterator[pa.RecordBatch]:
    """Shards with a leaf that an anchor's windows do not eliminate."""
    for batch in batches:
        for first in range(0, batch.num_rows, _BLOCK):
            part = batch.slice(first, _BLOCK)
            rows, n = _matrix(part.column("vec"), width), part.num_rows
            low, high = (np.asarray(part.column(c).flatten()).reshape(n, -1) for c in ("low", "high"))
            open_ = low <= high
            least, most = np.where(open_, low, np.iinfo(np.int64).max).min(1).astype(float), np.where(open_, high, np.iinfo(np.int64).min).max(1).astype(float)
            to_points, norm2 = tree.point_distances(rows), (rows ** 2).sum(1)
            wanted = {leaf: tree.survives(leaf, to_points, norm2, least, most) & open_.any(1) for leaf in shards}
            asks = [sorted({s for leaf in shards if wanted[leaf][q] for s in shards[leaf]}) for q in range(n)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(asks, pa.list_(pa.int32()))], names=[*part.schema.names, "shards"])


class Index:
    """All rows, placed in a fitted tree and dealt over shards."""

    def __init__(self, rows: DataFrame):
        size = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vec")), F.lit(1))).first()
        self.n, self.width = size[0], max(1, size[1])
        sample = rows.select(F.xxhash64("id").alias("h"), "id", "vec").orderBy("h", "id").limit(SAMPLE).collect()
        fitted = np.zeros((len(sample), self.width))
        for k, row in enumerate(sample):
            fitted[k, : len(row.vec)] = row.vec
        tree, width = Tree(fitted), self.width
        told = rows.mapInArrow(lambda x: _ranges(x, tree, width), "node int, i int, j int, low double, high double, n bigint")
        told = told.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).collect()
        tree.describe({(r.node, r.i, r.j): (r.low, r.high) for r in told if r.node >= 0}, {r.i: (r.low, r.high) for r in told if r.node < 0})
        self.tree = tree
        self.shards = self._packed({r.i: r.n for r in told if r.node < 0})
        schema = "id bigint, label bigint, vec array<int>, leaf int"
        placed = rows.mapInArrow(lambda x: _placed(x, tree, width), schema)
        firsts = F.create_map(*[F.lit(x) for leaf, own in self.shards.items() for x in (leaf, own[0])]) if self.shards else F.create_map(F.lit(-1), F.lit(0))
        counts = F.create_map(*[F.lit(x) for leaf, own in self.shards.items() for x in (leaf, len(own))]) if self.shards else F.create_map(F.lit(-1), F.lit(1))
        shard = firsts[F.col("leaf")] + F.pmod(F.xxhash64("id"), counts[F.col("leaf")]).cast("int")
        self.rows = materialize(placed.withColumn("shard", shard), "gnat")

    def _packed(self, counts: dict[int, int]) -> dict[int, list[int]]:
        """Shards of each leaf: a large leaf has several of its own, small ones share one with their neighbours."""
        most = max(1, -(-self.n // max(1, min(SHARDS, -(-self.n // FEWEST)), -(-self.n // SHARD_ROWS))))
        out, at, held = {}, 0, 0
        for leaf in sorted(counts):
            if held and held + counts[leaf] > most:
                at, held = at + 1, 0
            parts = -(-counts[leaf] // most)
            out[leaf] = list(range(at, at + parts))
            at, held = (at, held + counts[leaf]) if parts == 1 else (at + parts, 0)
        return out

    def search(self, asking: DataFrame, k: int, same: bool) -> DataFrame:
        """The k best rows per anchor and slot; ``asking``: id, label, vec, leaf, low, high and the shards to ask."""
        tree, width = self.tree, self.width
        none = F.lit(None).cast("array<bigint>")
        index = self.rows.select("shard", F.lit(False).alias("asks"), "id", "label", "vec", "leaf", none.alias("low"), none.alias("high"))
        sent = asking.select(F.explode("shards").alias("shard"), F.lit(True).alias("asks"), "id", "label", "vec", "leaf", "low", "high")
        dealt = index.union(sent).repartition("shard").sortWithinPartitions("shard", "asks")
        found = dealt.mapInArrow(lambda x: _searched(x, tree, width, k, same), _FOUND)
        ranked = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("k"), "id", "score"))), 1, k)  # k rows of each shard at most
        return found.groupBy("anchor", "slot").agg(ranked.alias("best"))

    def asked(self, asking: DataFrame) -> DataFrame:
        tree, width, shards = self.tree, self.width, self.shards
        schema = "id bigint, label bigint, vec array<int>, leaf int, low array<bigint>, high array<bigint>, shards array<int>"
        return asking.select("id", "label", "vec", "leaf", "low", "high").mapInArrow(lambda x: _asked(x, tree, width, shards), schema)


def _home(shards: dict[int, list[int]]):
    entries = [x for leaf, own in shards.items() for x in (F.lit(leaf), F.array(*[F.lit(s) for s in own]))]
    return F.create_map(*entries)[F.col("leaf")] if entries else F.array().cast("array<int>")


def _hundredth(x: Column) -> Column:
    """x / 100, rounded down, in integers."""
    return F.floor((x - F.pmod(x, F.lit(100))).cast("decimal(20,0)") / F.lit(100).cast("decimal(20,0)")).cast("bigint")


def mine(rows: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score."""
    index = Index(materialize(prepared(rows), "vectors"))
    anchors = index.rows.where(F.col("id") % ANCHOR_EVERY == 0)
    least, most = F.lit(-(2 ** 62)), F.lit(2 ** 62)
    at_home = anchors.withColumn("low", F.array(least)).withColumn("high", F.array(most)).withColumn("shards", _home(index.shards))
    bound = index.search(at_home, POSITIVES, True)
    bound = bound.select(F.col("anchor").alias("id"), F.when(F.size("best") == POSITIVES, F.col("best")[POSITIVES - 1]["score"]).alias("bound"))
    bounded = anchors.join(materialize(bound, "bounds"), "id", "left").withColumn("low", F.array(F.coalesce("bound", least))).withColumn("high", F.array(most))
    positives = materialize(index.search(index.asked(bounded), POSITIVES, True).select(F.col("anchor").alias("id"), "best"), "positives")

    low = F.transform("best", lambda p: _hundredth(LEAST * p["score"] + 99))
    high = F.transform("best", lambda p: _hundredth(MOST * p["score"]))
    fixed = lambda values, empty: F.transform(F.sequence(F.lit(0), F.lit(POSITIVES - 1)), lambda i: F.coalesce(F.get(values, i), F.lit(empty)))
    asking = anchors.join(positives, "id").withColumn("low", fixed(low, 1)).withColumn("high", fixed(high, 0))
    found = index.search(index.asked(asking), NEGATIVES, False)
    listed = positives.select(F.col("id").alias("anchor"), F.posexplode("best").alias("slot", "p"))
    joined = found.join(listed, ["anchor", "slot"]).select("anchor", "p", F.posexplode("best").alias("at", "x"))
    return joined.select(F.col("anchor").alias("anchor_id"), F.col("p.id").alias("positive_id"), (F.col("at") + 1).alias("rank"), F.col("x.id").alias("negative_id"),
                         F.col("p.score").alias("positive_score"), F.col("x.score").alias("negative_score"))
