"""Reshaping, ranking, pooling and small comparison helpers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkprint.functions.scorer import batch_scorer, labelled
from inkprint.operators import compare, encode, metrics, scores
from inkprint.session import materialize, release


@pytest.fixture(scope="module")
def wide(spark):
    return spark.createDataFrame([(1, .2, .5, .3), (2, .4, .4, .2)], "row_id int, prob_a double, prob_b double, prob_c double")


def test_wide_and_long_are_inverse(wide):
    long = scores.to_long(wide, ["a", "b", "c"], ["row_id"])
    assert long.count() == 6
    back = scores.to_wide(long, ["a", "b", "c"], ["row_id"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, wide.collect()))


def test_ranking_breaks_ties_by_label(wide):
    long = scores.to_long(wide, ["a", "b", "c"], ["row_id"])
    got = [(r.row_id, r["rank"], r.label) for r in scores.rank_scores(long, ["row_id"]).orderBy("row_id", "rank").collect()]
    assert got == [(1, 1, "b"), (1, 2, "c"), (1, 3, "a"), (2, 1, "a"), (2, 2, "b"), (2, 3, "c")]
    top = {r.row_id: (r.predicted, r.top_score) for r in scores.top_scores(long, ["row_id"]).collect()}
    assert top == {1: ("b", .5), 2: ("a", .4)}


def test_pooling_is_an_unweighted_mean(spark):
    rows = spark.createDataFrame([("p", 1, "a", .9), ("p", 2, "a", .1), ("p", 1, "b", .1), ("p", 2, "b", .8)],
                                 "program string, chunk int, label string, score double")
    got = {r.label: r.score for r in scores.pool_chunks(rows, ["program"]).collect()}
    assert got == pytest.approx({"a": .5, "b": .45})


def test_modes_merge_in_order(spark):
    row = spark.range(1).select(compare.merge_modes(
        F.array(F.lit("first512")), F.array(F.lit("chunks"), F.lit("first512"))).alias("m")).first()
    assert row.m == ["first512", "chunks"]


def test_prediction_counts_as_map(spark):
    rows = spark.createDataFrame([("x", "a"), ("x", "a"), ("x", "b"), ("y", "b")], ["c", "predicted"])
    got = {r.c: r.predictions for r in metrics.prediction_count_map(rows, ["c"]).collect()}
    assert got == {"x": {"a": 2, "b": 1}, "y": {"b": 1}}


def test_label_set_is_bounded(spark):
    rows = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], ["label"])
    assert encode.label_set(rows) == ["a", "b"]
    with pytest.raises(ValueError):
        encode.label_set(rows, limit=1)
    got = rows.select(encode.encode(F.col("label"), ["b", "a"]).alias("t"), encode.encode(F.lit("z"), ["a"]).alias("u")).collect()
    assert sorted((r.t, r.u) for r in got if r.t is not None) == [(0, None), (1, None), (1, None)]


def test_user_scorer_is_loaded_in_the_worker(spark):
    def load():
        def score(texts):
            return np.array([[len(t), 1.0] for t in texts])
        return score

    rows = spark.createDataFrame([("ab",), ("c",)], ["code"])
    got = rows.withColumn("s", batch_scorer(load)(F.col("code"))).select(labelled(F.col("s.scores"), ["n", "one"]).alias("s")).collect()
    assert [[(x.label, x.score) for x in r.s] for r in got] == [[("n", 2.0), ("one", 1.0)], [("n", 1.0), ("one", 1.0)]]


def test_texts_a_scorer_fails_on_carry_the_error(spark):
    def load():
        def score(texts):
            if "bad" in texts:
                raise KeyError("bad")
            return np.array([[1.0] for _ in texts])
        return score

    rows = spark.createDataFrame([("ok",), ("bad",), ("fine",)], ["code"]).coalesce(1)
    got = {r.code: (r.s.scores, r.s.error) for r in rows.withColumn("s", batch_scorer(load)(F.col("code"))).collect()}
    assert got == {"ok": ([1.0], None), "bad": (None, "KeyError"), "fine": ([1.0], None)}


def test_labels_outside_the_set_count_in_n_and_accuracy(spark):
    rows = spark.createDataFrame([("a", "a"), ("b", "b"), ("zz", "a")], ["true", "predicted"])
    got = metrics.model_metrics(rows, labels=["a", "b"]).first()
    assert (got.n, got.accuracy) == (3, 2 / 3)


def test_scores_of_labels_on_one_side_only(spark):
    saved = spark.createDataFrame([(1, "a", 0.6), (1, "b", 0.4)], "k int, label string, score double")
    got = scores.score_differences(saved, saved.where("label = 'a'"), ["k"]).first()
    assert (got.missing_labels, got.max_score_difference, got.local_label) == (1, 0.0, "a")


def test_stored_frames_are_removed_on_release(spark):
    stored = materialize(spark.range(3).toDF("n"), "kept")
    assert stored.count() == 3 and release(spark) >= 1 and release(spark) == 0
