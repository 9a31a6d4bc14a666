"""Per-program label scores: reshape, rank, pool, compare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def to_long(wide: DataFrame, labels: list[str], keys: list[str], prefix: str = "prob_") -> DataFrame:
    """One ``prob_<label>`` column per label -> (keys, label, score)."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(x).alias("label"), F.col(f"`{prefix}{x}`").alias("score")) for x in labels
    ]))
    return wide.select(*keys, cells.alias("s")).select(*keys, "s.*")


def to_wide(long: DataFrame, labels: list[str], keys: list[str], prefix: str = "prob_") -> DataFrame:
    return long.groupBy(*keys).agg(*[
        F.max(F.when(F.col("label") == x, F.col("score"))).alias(f"{prefix}{x}") for x in labels
    ])


def ranked(scores: Column) -> Column:
    """Array of (label, score), best first, label order on ties."""
    key = F.transform(scores, lambda s: F.struct((-s.score).alias("k"), s.label.alias("label")))
    return F.transform(F.sort_array(key), lambda s: F.struct(s.label.alias("label"), (-s.k).alias("score")))


def rank_scores(long: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rank, label, score): labels of one program fit one row, so no window is sorted."""
    packed = long.groupBy(*keys).agg(F.collect_list(F.struct("label", "score")).alias("scores"))
    places = F.posexplode(ranked(F.col("scores"))).alias("rank", "s")
    return packed.select(*keys, places).select(
        *keys, (F.col("rank") + 1).alias("rank"), "s.label", "s.score"
    )


def score_of(scores: Column, label: str) -> Column:
    return F.get(F.filter(scores, lambda s: s.label == label), F.lit(0)).score


def pool_chunks(chunk_scores: DataFrame, keys: list[str]) -> DataFrame:
    """Unweighted mean of the per-chunk scores of each label."""
    return chunk_scores.groupBy(*keys, "label").agg(F.avg("score").alias("score"))


def top_scores(long: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, predicted, top_score) with the alphabetically first label on ties."""
    packed = long.groupBy(*keys).agg(F.collect_list(F.struct("label", "score")).alias("scores"))
    best = F.get(ranked(F.col("scores")), F.lit(0))
    return packed.select(*keys, best.label.alias("predicted"), best.score.alias("top_score"))


def score_differences(saved: DataFrame, local: DataFrame, keys: list[str]) -> DataFrame:
    """Saved against recomputed scores, aligned by label, one row per key.

    Input: (keys, label, score) on both sides. A label that one side lacks is
    counted in ``missing_labels`` and has no difference.
    """
    a = saved.select(*keys, "label", F.col("score").alias("saved"))
    b = local.select(*keys, "label", F.col("score").alias("local"))
    packed = a.join(b, [*keys, "label"], "full").groupBy(*keys).agg(
        F.collect_list(F.struct("label", "saved", "local")).alias("s")
    )

    def best(side: str) -> Column:
        scores = F.transform(F.filter("s", lambda x: x[side].isNotNull()), lambda x: F.struct(x.label.alias("label"), x[side].alias("score")))
        return F.get(ranked(scores), F.lit(0)).label

    return packed.select(
        *keys, best("saved").alias("saved_label"), best("local").alias("local_label"),
        F.array_max(F.transform("s", lambda x: F.abs(x.saved - x.local))).alias("max_score_difference"),
        F.size(F.filter("s", lambda x: x.saved.isNull() | x.local.isNull())).cast("bigint").alias("missing_labels"),
    )


def verification_summary(differences: DataFrame) -> DataFrame:
    return differences.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("saved_label") != F.col("local_label")).alias("label_disagreements"),
        F.max("max_score_difference").alias("maximum_score_difference"),
        F.sum("missing_labels").alias("missing_labels"),
    )
