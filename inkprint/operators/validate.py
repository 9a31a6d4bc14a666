"""Corpus checks: summaries, duplicates, one-to-one joins and leakage audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from inkprint.functions import text as tx


def filter_labels(df: DataFrame, labels: list[str], label: str = "label") -> DataFrame:
    return df.where(F.col(label).isin(labels))


def data_summary(corpus: DataFrame, required: list[str]) -> DataFrame:
    """One row of corpus health counts over ``code, stripped_code, label, source_hash``."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    # Distinct hashes are counted from a grouped frame, so the hot hash of a
    # much-copied program is combined before the shuffle.
    per_hash = corpus.groupBy("source_hash").agg(
        F.count("*").alias("n"),
        F.count_if(missing).alias("missing"),
        F.count_if(tx.is_blank(F.col("code"))).alias("blank"),
        F.count_if(F.col("code") != F.col("stripped_code")).alias("changed"),
    )
    return per_hash.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("programs"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("missing_required_values"),
        F.coalesce(F.sum("blank"), F.lit(0)).alias("empty_code"),
        F.coalesce(F.sum("n") - F.count("*"), F.lit(0)).alias("exact_duplicate_excess"),
        F.coalesce(F.sum("changed"), F.lit(0)).alias("programs_changed_by_comment_removal"),
    )


def comment_change_summary(corpus: DataFrame, by: list[str]) -> DataFrame:
    changed = F.col("code") != F.col("stripped_code")
    return corpus.groupBy(*by).agg(
        F.count("*").alias("programs"),
        F.count_if(changed).alias("changed"),
        (F.count("*") - F.count_if(changed)).alias("unchanged"),
    )


def duplicates(df: DataFrame, column: str = "source_hash") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).where("n > 1")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; reads the key columns only."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def join_one_to_one(left: DataFrame, right: DataFrame, keys: list[str],
                    validate: bool = True) -> DataFrame:
    """Inner equi-join that refuses keys that are not there exactly once on both sides.

    The check is one pass over the keys alone, so texts are not shuffled for it.
    """
    if validate:
        sides = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
            right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r")))
        seen = sides.groupBy(*keys).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
        bad = seen.agg(*[F.coalesce(F.sum((F.col(c) > 1).cast("int")), F.lit(0)).alias(f"twice_{c}") for c in "lr"],
                       *[F.coalesce(F.sum((F.col(c) == 0).cast("int")), F.lit(0)).alias(f"missing_{c}") for c in "lr"]).first()
        for side, c in (("left", "l"), ("right", "r")):
            if bad[f"twice_{c}"]:
                raise ValueError(f"keys {keys} are not unique on the {side} side")
            if bad[f"missing_{c}"]:
                raise ValueError(f"{bad[f'missing_{c}']} keys {keys} are missing on the {side} side")
    return left.join(right, keys, "inner")


def leakage_audit(df: DataFrame, columns: list[str], splits: list[str],
                  split: str = "split") -> DataFrame:
    """Values of each column that a split shares with any other split.

    One grouped pass over (column, value); the state per value is one flag per
    split, so a value held by a third of the rows costs no more than any other.
    """
    named = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ]))
    seen = (
        df.select(split, named.alias("x")).select(split, "x.*")
        .groupBy("column", "value")
        .agg(*[F.max((F.col(split) == s).cast("int")).alias(s) for s in splits])
    )
    n_splits = reduce(lambda a, b: a + b, [F.col(s) for s in splits])
    per_split = F.explode(F.array(*[
        F.struct(F.lit(s).alias("split"), F.col(s).alias("inside")) for s in splits
    ]))
    return (
        seen.withColumn("n_splits", n_splits)
        .select("column", "n_splits", per_split.alias("p"))
        .groupBy("column", "p.split")
        .agg(
            F.sum("p.inside").alias("distinct_values"),
            F.count_if((F.col("p.inside") == 1) & (F.col("n_splits") > 1)).alias("shared_values"),
        )
    )


def split_coverage(df: DataFrame, splits: list[str]) -> DataFrame:
    """Per expected split: its label count, all labels, and whether both agree."""
    per_label = df.groupBy("label").agg(
        *[F.max((F.col("split") == s).cast("int")).alias(s) for s in splits]
    )
    unpivot = F.explode(F.array(*[
        F.struct(F.lit(s).alias("split"), F.col(s).alias("has")) for s in splits
    ]))
    return (
        per_label.select(unpivot.alias("p")).groupBy("p.split")
        .agg(F.sum("p.has").alias("labels"), F.count("*").alias("all_labels"))
        .withColumn("complete", F.col("labels") == F.col("all_labels"))
    )


def unexpected_splits(df: DataFrame, splits: list[str]) -> DataFrame:
    return df.where(~F.col("split").isin(splits)).groupBy("split").agg(F.count("*").alias("n"))


def validate_inputs(df: DataFrame, models: list[str], modes: list[str]) -> DataFrame:
    """Adds ``problem``: null for valid rows, else the first failed rule."""
    return df.withColumn(
        "problem",
        tx.input_problem(F.col("code"), F.col("model"), F.col("analysis_mode"), models, modes),
    )


def valid_and_rejected(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    return checked.where("problem is null").drop("problem"), checked.where("problem is not null")


def overlap_fractions(regimes: DataFrame, group: str = "problem_id", prompt: str = "prompt") -> DataFrame:
    """Leakage between train and test under each ``condition``.

    Input rows carry ``condition, part`` (train or test) plus the two columns.
    Membership is decided per value in one grouped pass instead of by a
    semi-join against the distinct training values.
    """
    named = F.explode(F.array(
        F.struct(F.lit("group").alias("kind"), F.col(group).alias("value")),
        F.struct(F.lit("prompt").alias("kind"), F.col(prompt).alias("value")),
    ))
    values = (
        regimes.where(F.col("part").isin("train", "test"))
        .select("condition", "part", named.alias("x"))
        .groupBy("condition", "x.kind", "x.value")
        .agg(
            F.count_if(F.col("part") == "train").alias("train_rows"),
            F.count_if(F.col("part") == "test").alias("test_rows"),
        )
    )
    is_group, is_prompt = F.col("kind") == "group", F.col("kind") == "prompt"
    leaked = F.when(F.col("train_rows") > 0, F.col("test_rows")).otherwise(0)

    def share(kind: Column) -> Column:
        rows = F.sum(F.when(kind, F.col("test_rows")))
        return F.when(rows > 0, F.sum(F.when(kind, leaked)) / rows)

    return values.groupBy("condition").agg(
        F.sum(F.when(is_group, F.col("train_rows")).otherwise(0)).alias("train_programs"),
        F.sum(F.when(is_group, F.col("test_rows")).otherwise(0)).alias("test_programs"),
        F.count_if(is_group & (F.col("train_rows") > 0) & (F.col("test_rows") > 0))
        .alias("shared_groups"),
        share(is_group).alias("test_fraction_with_group_in_train"),
        share(is_prompt).alias("test_fraction_with_prompt_in_train"),
    )
