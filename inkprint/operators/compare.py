"""Ablation comparison, ranking and selection over metric tables.

Metric tables have one row per condition, model and split, so windows here run
over summaries, never over corpus rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def average_rank(score: Column, by: list[Column]) -> Column:
    """Descending rank; tied scores share the mean of their places."""
    places = F.rank().over(Window.partitionBy(*by).orderBy(score.desc()))
    tied = F.count("*").over(Window.partitionBy(*by, score))
    return places + (tied - 1) / F.lit(2.0)


def rank_models(metrics: DataFrame, score: str = "macro_f1", by: list[str] = ("condition", "split")) -> DataFrame:
    return metrics.withColumn("rank", average_rank(F.col(score), [F.col(c) for c in by]))


def append_results(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def merge_modes(old: Column, new: Column) -> Column:
    """Ordered union without repeats."""
    return F.array_distinct(F.concat(old, new))


def pivot_conditions(metrics: DataFrame, conditions: list[str], score: str = "macro_f1") -> DataFrame:
    return metrics.groupBy("model", "split").pivot("condition", conditions).agg(F.first(score))


def ablation_change(pivoted: DataFrame, base: str, other: str) -> DataFrame:
    """Change of ``other`` against ``base`` in percentage points, with both ranks."""
    split = [F.col("split")]
    return pivoted.select(
        "model", "split", base, other,
        (100 * (F.col(other) - F.col(base))).alias("change_percentage_points"),
        average_rank(F.col(base), split).alias("base_rank"),
        average_rank(F.col(other), split).alias("other_rank"),
    )


def select_winner(metrics: DataFrame, condition: str = "original", split: str = "validation",
                  score: str = "macro_f1") -> DataFrame:
    """Highest score; the alphabetically first model wins an exact tie."""
    return (
        metrics.where((F.col("condition") == condition) & (F.col("split") == split))
        .orderBy(F.col(score).desc(), F.col("model"))
        .limit(1)
        .select("condition", "split", "model", score)
    )


def best_epoch(history: DataFrame, by: list[str], score: str = "validation_accuracy") -> DataFrame:
    """Epoch of the highest score; the earliest wins a tie."""
    best = F.max_by(F.struct("epoch", score), F.struct(F.col(score), -F.col("epoch"))).alias("b")
    return history.groupBy(*by).agg(best).select(*by, "b.*")


def early_stop(history: DataFrame, by: list[str], patience: int,
               score: str = "validation_accuracy") -> DataFrame:
    """First epoch at which ``patience`` epochs passed without a new best.

    ``stop_epoch`` is null when training would run to the end.
    """
    order = Window.partitionBy(*by).orderBy("epoch")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    marked = (
        history.withColumn("previous_best", F.max(score).over(before))
        .withColumn("improved", F.col("previous_best").isNull() | (F.col(score) > F.col("previous_best")))
        .withColumn("last_best", F.max(F.when(F.col("improved"), F.col("epoch"))).over(upto))
    )
    waited = F.col("epoch") - F.col("last_best") >= patience
    return marked.groupBy(*by).agg(
        F.min(F.when(waited, F.col("epoch"))).alias("stop_epoch"),
        F.max("epoch").alias("last_epoch"),
    )


def robustness_drop(metrics: DataFrame, by: list[str], score: str = "accuracy") -> DataFrame:
    """Drop from original to stripped text in percentage points."""
    wide = metrics.groupBy(*by).pivot("variant", ["original", "stripped"]).agg(F.first(score))
    return wide.withColumn("drop_pp", 100 * (F.col("original") - F.col("stripped")))


def tradeoffs(metrics: DataFrame, baseline: str, tolerance: float = 0.02) -> DataFrame:
    """Each model against the baseline: stripped F1 gain and clean accuracy change."""
    def pick(variant: str, score: str, name: str) -> Column:
        return F.max(F.when(F.col("variant") == variant, F.col(score))).alias(name)

    wide = metrics.groupBy("model").agg(
        pick("stripped", "macro_f1", "stripped_f1"), pick("original", "accuracy", "clean_accuracy")
    )
    base = wide.where(F.col("model") == baseline).select(
        F.struct(F.col("stripped_f1"), F.col("clean_accuracy"))
    )
    return (
        wide.where(F.col("model") != baseline).withColumn("base", base.scalar())
        .select(
            "model",
            (F.col("stripped_f1") - F.col("base.stripped_f1")).alias("stripped_macro_f1_gain"),
            (100 * (F.col("clean_accuracy") - F.col("base.clean_accuracy")))
            .alias("clean_accuracy_change_pp"),
            (F.col("clean_accuracy") >= F.col("base.clean_accuracy") - tolerance)
            .alias("clean_accuracy_within_tolerance"),
        )
    )


def model_gap(metrics: DataFrame, first: str, second: str, base: str, other: str,
              score: str = "macro_f1") -> DataFrame:
    """Lead of ``first`` over ``second`` under two conditions, and how far it narrows."""
    def at(model: str, condition: str) -> Column:
        return F.max(F.when((F.col("model") == model) & (F.col("condition") == condition), F.col(score)))

    return metrics.groupBy("split").agg(
        (100 * (at(first, base) - at(second, base))).alias("base_gap_pp"),
        (100 * (at(first, other) - at(second, other))).alias("other_gap_pp"),
    ).withColumn("narrowing_pp", F.col("base_gap_pp") - F.col("other_gap_pp"))
