"""Mixing sources to target weights by fitting each source's word budget as a subset sum.

Sizes are words. Sources, in code point order with null last, weigh ``WEIGHTS`` in turn and share
``SHARE`` of all words; no target exceeds ``MOST`` times its source, and what that frees is shared
again by weight (the common level is found from running sums over the sources).

A target is met by whole repeats of the source and one partial pass. For the partial pass only the
counts of documents per exact length matter: an equal share of every length is taken first, then long
documents until at most ``RESERVE`` words (and one document) are open, and the open rest is solved exactly
by a bounded-knapsack table over the remaining counts, at most twice as wide as the open rest. If no subset meets it,
the nearest sum is taken.

Which documents of a length are taken follows from a seeded hash of their id. They are not ranked
in one place: quotas are handed down through 256 x 256 hash cells, and only inside a cell are documents ranked,
so a source and length that holds a third of all rows is spread over 65,536 groups.

Null text has size 0 and is never taken; null sources are a source; null ids are hashed by their text. Rows equal in id
are ordered by a hash of the text, so that reruns agree however the rows are partitioned; rows equal in both share
their ranks in any order. A column ``mix_copies`` of the input gives way to that of the mix. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from inkprint.functions.shipping import ship_with_job
from inkprint.llm.words import packed, text_of, unpacked, words
from inkprint.session import materialize

ship_with_job(__name__)

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
RESERVE = 16_384
SEED = 17
CELLS = 256


def sized(docs: DataFrame, carry: Column) -> DataFrame:
    text_hash = F.xxhash64("text")
    by_text = F.when(F.col("doc_id").isNull(), text_hash)  # a null adds nothing to a hash
    return docs.select(carry.alias("_row"), "source", F.xxhash64(F.lit(SEED), F.col("doc_id"), by_text).alias("_h"), text_hash.alias("_t"),
                       F.size(words(text_of("text"))).cast("bigint").alias("size"))


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target. ``totals`` has one row per source, so its windows hold one row per source."""
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    weighed = totals.select("source", "source_size", weight.alias("w"), (share * F.sum("source_size").over(every)).alias("all"))
    by_cap = Window.orderBy("cap_level", F.col("source").asc_nulls_last())
    capped = weighed.withColumn("cap_level", most * F.col("source_size") / F.col("w"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("all") - F.coalesce(F.sum(most * F.col("source_size")).over(before), F.lit(0))) / F.sum("w").over(rest)
    levelled = capped.withColumn("level", level)
    first = F.min(F.when(F.col("level") <= F.col("cap_level"), F.struct("cap_level", "level"))).over(every)["level"]
    target = F.least((most * F.col("source_size")).cast("double"), F.coalesce(first, F.lit(float("inf"))) * F.col("w"))
    return levelled.select("source", "source_size", target.alias("target"))


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int, reserve: int = RESERVE) -> np.ndarray:
    """How many documents of each size to take so that their words sum to ``budget``, or else come nearest."""
    order = np.argsort(-sizes, kind="stable")
    size, count = [int(x) for x in sizes[order]], [int(x) for x in counts[order]]
    total = sum(s * c for s, c in zip(size, count))
    if budget >= total:
        return counts.copy()
    took = [c * budget // total for c in count]
    left = budget - sum(s * t for s, t in zip(size, took))
    for k, s in enumerate(size):
        more = max(0, min(count[k] - took[k], (left - reserve) // s))
        took[k] += more
        left -= more * s
    # Bounded knapsack over the open rest: which sums can be reached, and by which size each was reached first.
    # A sum of more than twice the rest is further from it than taking nothing, so the table ends there.
    most = min(left + max(size), 2 * left)
    mask, reached, by = (1 << (most + 1)) - 1, 1, np.full(most + 1, -1, np.int64)
    for k, s in enumerate(size):
        front = reached
        for _ in range(min(count[k] - took[k], most // s)):
            front = (front << s) & mask & ~reached
            if not front:
                break
            reached |= front
            bits = np.frombuffer(front.to_bytes(most // 8 + 1, "little"), np.uint8)
            by[np.flatnonzero(np.unpackbits(bits, bitorder="little")[: most + 1])] = k
            if reached >> left & 1:
                break
        if reached >> left & 1:
            break
    at = (reached & ((1 << (left + 1)) - 1)).bit_length() - 1
    above = reached >> left
    if above and (above & -above).bit_length() - 1 < left - at:
        at = left + (above & -above).bit_length() - 1
    while at:
        took[by[at]] += 1
        at -= size[by[at]]
    out = np.zeros(len(sizes), np.int64)
    out[order] = took
    return out


def _plan(group: pd.DataFrame) -> pd.DataFrame:
    """Whole repeats and partial counts of one source; one row per distinct size."""
    total, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
    repeats = int(target // total)
    budget = round(target - repeats * total)
    chosen = fit_budget(group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64), budget)
    return pd.DataFrame({"key": group["key"], "size": group["size"], "quota": chosen, "repeats": repeats})


def _key() -> Column:
    return F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source"))


def _hand_down(counted: DataFrame, group: list[str], cell: str) -> DataFrame:
    """Quota of every cell of a group, cells in order; a group has at most ``CELLS`` rows."""
    upto = F.sum("n").over(Window.partitionBy(*group).orderBy(cell))
    return counted.withColumn("quota", F.greatest(F.lit(0), F.least("n", F.col("quota") - (upto - F.col("n")))))


def choose(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """Each row of ``rows`` with the number of ``copies`` that the mix takes of it."""
    cells = rows.withColumn("key", _key()).withColumn("c1", F.pmod("_h", F.lit(CELLS))).withColumn("c2", F.pmod(F.shiftright("_h", 8), F.lit(CELLS)))
    leaf = cells.where("size > 0").groupBy("key", "size", "c1", "c2").agg(F.count("*").alias("n"))
    lengths = leaf.groupBy("key", "size").agg(F.sum("n").alias("n"))
    keyed = goals.withColumn("key", _key()).select("key", "source_size", "target")
    plan = lengths.join(keyed, "key").groupBy("key").applyInPandas(_plan, "key string, size bigint, quota bigint, repeats bigint")
    upper = leaf.groupBy("key", "size", "c1").agg(F.sum("n").alias("n")).join(plan, ["key", "size"])
    upper = _hand_down(upper, ["key", "size"], "c1").select("key", "size", "c1", "quota", "repeats")
    lower = _hand_down(leaf.join(upper, ["key", "size", "c1"]), ["key", "size", "c1"], "c2").drop("n")
    at = ["key", "size", "c1", "c2"]
    ranked = cells.withColumn("rank", F.row_number().over(Window.partitionBy(*at).orderBy("_h", "_t")))
    joined = ranked.join(lower, at, "left")
    copies = F.coalesce(F.col("repeats") + (F.col("rank") <= F.col("quota")).cast("bigint"), F.lit(0))
    return joined.select("_row", "source", "size", copies.cast("bigint").alias("copies"))


def goals_of(rows: DataFrame) -> DataFrame:
    return materialize(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")


def report(docs: DataFrame) -> DataFrame:
    """Id, size, target of the source and words taken, for every document. Only counts are shuffled."""
    told = docs.select("doc_id", "text", "source")
    rows = materialize(sized(told, F.struct("doc_id")), "sizes")
    goals = goals_of(rows)
    mixed = choose(rows, goals).join(goals.withColumnRenamed("source", "_source"), F.expr("source <=> _source"))
    return mixed.select("_row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """Rows of the mix with the columns they came with and ``mix_copies``, the times each is read."""
    rows = sized(docs, packed(docs))
    kept = [name for name in docs.columns if name.lower() != "mix_copies"]
    return unpacked(choose(rows, goals_of(rows.drop("_row"))).where("copies > 0"), kept, F.col("copies").alias("mix_copies"))
