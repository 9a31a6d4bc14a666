"""Exact counts, disjoint groups and independence of order."""

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from inkprint.operators import splits, validate, windows


def h32(text):
    return int(hashlib.sha256(text.encode()).hexdigest()[:8], 16)


@pytest.fixture(scope="module")
def skewed(spark):
    # One label and one group hold most rows.
    return spark.range(3000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 > 0, "big").otherwise(F.concat(F.lit("l"), F.col("id") % 5)).alias("label"),
        F.when(F.col("id") % 2 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 97)).alias("problem_id"),
    )


def test_group_split_follows_hash_order(skewed):
    groups = sorted({r.problem_id for r in skewed.select("problem_id").distinct().collect()},
                    key=lambda g: (h32(g), g))
    n = len(groups)
    cut = [int(n * .7), int(n * .7) + int(n * .15)]
    want = {g: "train" if i < cut[0] else "validation" if i < cut[1] else "test" for i, g in enumerate(groups)}
    got = {r.problem_id: r.split for r in splits.group_split(skewed).select("problem_id", "split").distinct().collect()}
    assert got == want


def test_stratified_split_is_exact_per_label(skewed):
    got = splits.stratified_split(skewed)
    rows = got.groupBy("label").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("k")).collect()
    assert all(r.k == int(r.n * .2 + .5) for r in rows)
    chosen = {r.row_id for r in got.where("split = 'test' and label = 'l0'").collect()}
    ids = [r.row_id for r in skewed.where("label = 'l0'").collect()]
    ranked = sorted(ids, key=lambda i: (h32(f"42:{i}"), i))
    assert chosen == set(ranked[: int(len(ids) * .2 + .5)])


@pytest.mark.parametrize("probability", [0.0, 0.5, 1.0])
@pytest.mark.parametrize("n", [1, 2, 5, 3000])
def test_mask_size_is_exact(spark, skewed, probability, n):
    masked = splits.augmentation_mask(skewed.where(F.col("row_id") < n), probability, 1)
    assert masked.where("masked").count() == round(n * probability)


def test_mask_changes_with_the_epoch_only(skewed):
    draw = lambda e: {r.row_id for r in splits.augmentation_mask(skewed, 0.5, e).where("masked").collect()}
    one = draw(1)
    assert one == draw(1) and one != draw(2)


def test_leakage_audit_counts_shared_values(spark):
    rows = spark.createDataFrame([("train", "a"), ("test", "a"), ("test", "b"), ("validation", "c")], ["split", "p"])
    got = {r.split: (r.distinct_values, r.shared_values)
           for r in validate.leakage_audit(rows, ["p"], ["train", "validation", "test"]).collect()}
    assert got == {"train": (1, 1), "test": (2, 1), "validation": (1, 0)}


def test_one_to_one_join_refuses_duplicates(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], ["k", "x"])
    right = spark.createDataFrame([(1, "c"), (1, "d")], ["k", "y"])
    with pytest.raises(ValueError, match="right"):
        validate.join_one_to_one(left, right, ["k"])
    with pytest.raises(ValueError, match="left"):
        validate.join_one_to_one(right, left, ["k"])
    assert validate.join_one_to_one(left, left.withColumnRenamed("x", "z"), ["k"]).count() == 2
    with pytest.raises(ValueError, match="1 keys .* missing on the right"):
        validate.join_one_to_one(left, left.where("k = 1"), ["k"])


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 400), min_size=1, max_size=20), st.integers(5, 40), st.integers(0, 60))
def test_windows_cover_every_token(spark, lengths, limit, overlap):
    capacity = limit - 3
    back = min(overlap, capacity - 1)
    rows = spark.createDataFrame([(i, [str(t) for t in range(n)]) for i, n in enumerate(lengths)],
                                 "row_id int, tokens array<string>")
    got = windows.chunk_windows(rows, ["row_id"], limit=limit, overlap=overlap).orderBy("row_id", "chunk").collect()
    for i, n in enumerate(lengths):
        want, start = [], 0
        while True:
            end = min(start + capacity, n)
            want.append((start, end, [str(t) for t in range(start, end)]))
            if end == n:
                break
            start = end - back
        assert [(r.start, r.end, r.window) for r in got if r.row_id == i] == want
