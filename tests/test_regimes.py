"""Regimes share one count of the terms and one vocabulary, and get the vectors they had alone."""

import numpy as np
from pyspark.sql import functions as F

from inkprint.operators import features as ft, linear
from inkprint.plans import jobs

TEXTS = ["x y z y", "y y w", "Z z x", "", "q r s t", "x x x y z w q"]


def corpus(spark):
    rows = [(i, "ab"[i % 2], f"g{i % 5}", TEXTS[i % 6] + f" n{i % 7}") for i in range(60)]
    return spark.createDataFrame(rows, "row_id long, label string, problem_id string, code string")


def test_shared_rows_are_those_of_each_model(spark):
    df = corpus(spark)
    models = [ft.fit_tfidf(df.where(f"row_id % {k} = 0"), "word", max_features=5) for k in (2, 3)]
    shared = ft.shared_terms(models)
    rows = shared.transform(df, carry=["label"])
    for model in models:
        alone = {r.row_id: r for r in model.transform(df, carry=["label"]).collect()}
        for r in ft.reweigh(rows, shared, model, ["row_id", "label"]).collect():
            assert r.indices == alone[r.row_id].indices and r.label == alone[r.row_id].label
            assert np.allclose(r["values"], alone[r.row_id]["values"])


def test_texts_are_tokenised_twice_for_all_regimes(spark, monkeypatch):
    words, calls, sizes = ft.tx.words, [], []
    monkeypatch.setattr(ft.tx, "words", lambda text: calls.append(1) or words(text))

    def fit(features, labels, n_terms):
        sizes.append((features.count(), n_terms))
        return linear.fit_naive_bayes(features, labels, n_terms)

    monkeypatch.setattr(jobs.svm, "fit_linear_svm", fit)
    got = {r.regime: r for r in jobs.regime_scores(corpus(spark), ["a", "b"], 6).collect()}
    assert len(calls) == 2 and list(got) == ["grouped", "random", "random_leaky_vocabulary"]
    assert sizes == [(36, 6), (48, 6), (48, 6)] and got["random"].n == 12
