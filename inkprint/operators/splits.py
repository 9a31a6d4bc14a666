"""Group splits, stratified splits and augmentation masks with exact counts.

All of them mean "the first k rows in hash order". Instead of ranking every row
in one sorted window, :func:`hash_cuts` finds the k-th key itself: rows are
counted per hash bucket, and only the bucket that holds the boundary is ranked.
Rows are then compared with that key, so texts are neither sorted nor shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from inkprint import constants as K
from inkprint.functions.hashing import hash32, seeded

BUCKET_BITS = 16  # 65,536 buckets: the boundary bucket holds about 1/65,536 of the rows


def hash_cuts(keys: DataFrame, order: Column, tie: Column,
              targets: dict[str, Callable[[Column], Column]],
              by: list[str] | None = None) -> DataFrame:
    """Per group of ``by`` (a closed set), the (hash, tie) pair at rank k for each target.

    ``targets`` maps a name to k as an expression of the group's row count. The
    cut is null where k is 0.
    """
    by = by or []
    keyed = keys.select(*by, order.alias("h"), tie.alias("t")).withColumn(
        "bucket", F.shiftright("h", 32 - BUCKET_BITS)
    )
    # At most 65,536 rows per group from here on.
    counts = keyed.groupBy(*by, "bucket").agg(F.count("*").alias("n"))
    running = Window.partitionBy(*by).orderBy("bucket")
    whole = Window.partitionBy(*by)
    total = F.col("total")
    edges = (
        counts.withColumn("upto", F.sum("n").over(running))
        .withColumn("total", F.sum("n").over(whole))
        .select(*by, "bucket", "upto", "n", F.explode(F.array(*[
            F.struct(F.lit(name).alias("name"), k(total).cast("bigint").alias("k"))
            for name, k in targets.items()
        ])).alias("target"))
        .select(*by, "bucket", "target.name", (F.col("target.k") - F.col("upto") + F.col("n")).alias("need"), "n")
        .where("need > 0 and need <= n")
        .drop("n")
    )
    ranked = keyed.join(F.broadcast(edges), [*by, "bucket"]).withColumn(
        "rank", F.row_number().over(Window.partitionBy(*by, "name").orderBy("h", "t"))
    )
    return ranked.where("rank = need").groupBy(*by).agg(*[
        F.max(F.when(F.col("name") == name, F.struct("h", "t"))).alias(name) for name in targets
    ])


def first_k(df: DataFrame, order: Column, tie: Column, k: Callable[[Column], Column],
            by: list[str] | None = None, name: str = "chosen", keys: DataFrame | None = None) -> DataFrame:
    """Adds a boolean: is the row among the first k of its group in hash order.

    ``keys`` may name a cheaper frame with the same rows to find the cut from.
    """
    cuts = hash_cuts(df if keys is None else keys, order, tie, {"cut": k}, by)
    within = F.struct(order.alias("h"), tie.alias("t")) <= F.col("cut")
    if by:
        joined = df.join(F.broadcast(cuts), by, "left")
    else:
        joined = df.withColumn("cut", cuts.select("cut").scalar())
    return joined.withColumn(name, F.coalesce(within, F.lit(False))).drop("cut")


def group_split(df: DataFrame, group: str = "problem_id",
                train: float = 0.70, validation: float = 0.15) -> DataFrame:
    """Adds ``split``; a whole group always lands in one split.

    Groups are put in hash order; the first share is train, the next validation,
    the rest test. Shares are of groups, not rows.
    """
    groups = df.select(group).distinct()
    column = F.col(group).cast("string")
    order = hash32(column)
    cuts = hash_cuts(groups, order, column, {
        "train": lambda n: F.floor(n * train),
        "validation": lambda n: F.floor(n * train) + F.floor(n * validation),
    }).select(F.struct("train", "validation"))
    here = F.struct(order.alias("h"), column.alias("t"))
    return (
        df.withColumn("cuts", cuts.scalar())
        .withColumn(
            "split",
            F.when(here <= F.col("cuts.train"), "train")
            .when(here <= F.col("cuts.validation"), "validation")
            .otherwise("test"),
        )
        .drop("cuts")
    )


def stratified_split(df: DataFrame, test: float = 0.2, seed: int = K.SEED,
                     label: str = "label", key: str = "row_id") -> DataFrame:
    """Adds ``split`` with exactly the rounded share of each label in test."""
    marked = first_k(df, seeded(seed, F.col(key)), F.col(key),
                     lambda n: F.floor(n * test + 0.5), [label], "in_test")
    return marked.withColumn(
        "split", F.when(F.col("in_test"), "test").otherwise("train")
    ).drop("in_test")


def augmentation_mask(df: DataFrame, probability: float, epoch: int,
                      seed: int = K.SEED, key: str = "row_id", name: str = "masked",
                      keys: DataFrame | None = None) -> DataFrame:
    """Adds ``masked``, true on exactly round(n * probability) rows.

    The draw depends on seed + epoch only, so it changes per epoch and no other
    random step influences it.
    """
    if probability <= 0 or probability >= 1:
        return df.withColumn(name, F.lit(probability >= 1))
    return first_k(df, seeded(seed + epoch, F.col(key)), F.col(key),
                   lambda n: F.bround(n * probability), name=name, keys=keys)


def augmented_text(masked: DataFrame, name: str = "text") -> DataFrame:
    return masked.withColumn(
        name, F.when(F.col("masked"), F.col("stripped_code")).otherwise(F.col("code"))
    )


def augmentation_effect(df: DataFrame, probability: float, epochs: list[int],
                        seed: int = K.SEED, key: str = "row_id") -> DataFrame:
    """Per epoch, how many rows were asked to change and how many really did.

    The draws read the key only; texts are compared in one pass for all epochs.
    """
    keys = df.select(key)
    marked = df.select(key, (F.col("code") != F.col("stripped_code")).alias("changed"))
    for e in epochs:
        marked = augmentation_mask(marked, probability, e, seed, key, f"masked_{e}", keys)
    per_epoch = F.array(*[
        F.struct(
            F.lit(e).alias("epoch"),
            F.count_if(f"masked_{e}").alias("requested_stripped_programs"),
            F.count_if(F.col(f"masked_{e}") & F.col("changed")).alias("actually_changed_programs"),
        )
        for e in epochs
    ])
    return marked.agg(per_epoch.alias("rows")).select(F.inline("rows"))


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split", "label").agg(F.count("*").alias("n"))


def split_counts(df: DataFrame) -> DataFrame:
    """Rows and distinct groups per split; grouped twice so no split is one task."""
    return (
        df.groupBy("split", "problem_id").agg(F.count("*").alias("n"))
        .groupBy("split")
        .agg(F.sum("n").alias("samples"), F.count("problem_id").alias("groups"))
    )


def class_counts(df: DataFrame, labels: list[str]) -> DataFrame:
    return df.groupBy("split").pivot("label", labels).count().na.fill(0, labels)


def sample_per_label(df: DataFrame, columns: list[str], label: str = "label",
                     key: str = "row_id") -> DataFrame:
    """The first row of each label by ``key``."""
    first = F.min_by(F.struct(key, *columns), F.col(key)).alias("first")
    return df.groupBy(label).agg(first).select(label, "first.*")
