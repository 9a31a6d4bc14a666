"""Texts stored as counts tell the vectors of the transform, and the fits on them are those on vectors."""

from pathlib import Path
from urllib.parse import unquote, urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkprint import session
from inkprint.operators import features as ft, models, svm

LABELS = ["a", "b"]
WORDS = ["alpha beta", "gamma delta", "epsilon zeta eta", "theta iota kappa"]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "ab"[i % 2], ["train", "train", "test"][i % 3], " ".join(WORDS[j] for j in rng.integers(0, 3, 6) + i % 2)) for i in range(90)]
    rows += [(90, "a", "train", ""), (91, "b", "train", "alpha " * 400), (92, "a", "validation", "\U0001f600\U0001f600"), (93, "c", "train", "alpha")]
    df = spark.createDataFrame(rows, "row_id long, label string, split string, code string").repartition(3)
    return df, ft.fit_tfidf(df.where("split = 'train'"), "char", max_features=2000)


@pytest.fixture(scope="module")
def both(corpus):
    df, model = corpus
    vectors = ft.as_vectors(model.transform(df, carry=["label", "split"]), model.size, partition_by=["split"])
    return vectors, ft.store_counts(model, df, carry=["label", "split"], partition_by=["split"])


def test_stored_counts_tell_the_same_vectors(corpus, both):
    df, model = corpus
    want = {r.row_id: r for r in model.transform(df, carry=["label", "split"]).collect()}
    got = {r.row_id: r for r in both[1].sparse().collect()}
    assert got.keys() == want.keys() and all(got[k].indices == want[k].indices and got[k].label == want[k].label for k in want)
    assert all(got[k]["values"] == want[k]["values"] and got[k].split == want[k].split for k in want)
    assert both[1].where("split = 'train'").count() == both[0].where("split = 'train'").count()


def test_far_terms_and_large_counts_are_kept(spark):
    terms = sorted("%03d" % i for i in range(1000))
    model = ft.TfidfModel("char", 1, terms, [1] * 1000, [1] * 1000, [1.0 + i / 7 for i in range(1000)], True, (3,))
    df = spark.createDataFrame([(0, "999" * 1), (1, "000 700 999"), (2, "0" * 70_000), (3, "")], "row_id long, code string")
    want = model.transform(df).orderBy("row_id").collect()
    assert [r.indices for r in want] == [[999], [0, 700, 999], [0], []]
    assert ft.store_counts(model, df).sparse().orderBy("row_id").collect() == want


@pytest.mark.parametrize("name", ["Naive Bayes", "Logistic Regression", "Linear SVM"])
@pytest.mark.parametrize("direct", [svm.DIRECT, 0])
def test_linear_fits_are_those_on_vectors(both, corpus, monkeypatch, name, direct):
    monkeypatch.setattr(svm, "DIRECT", direct)
    options = {} if name == "Naive Bayes" else {"tolerance": 1e-7}
    fitted = [models.fit(rows.where("split = 'train'"), LABELS, name, 63, corpus[1].size, **options) for rows in both]
    assert np.allclose(fitted[0].weights, fitted[1].weights, atol=1e-4) and np.allclose(fitted[0].intercepts, fitted[1].intercepts, atol=1e-4)
    picked = [sorted(map(tuple, models.predict(fitted[1], rows.where("split <> 'train'"), LABELS).collect())) for rows in both]
    assert picked[0] == picked[1] and len(picked[0]) == 31


def test_forest_reads_the_same_cells(both, corpus):
    fitted = [models.fit(rows.where("split = 'train'"), LABELS, "Random Forest", 63, corpus[1].size, trees=4) for rows in both]
    assert all(f.trees.counts[:4].sum(axis=1).min() > 30 and (f.trees.feature >= 0).any() for f in fitted)
    picked = [sorted(map(tuple, models.predict(fitted[1], rows.where("split <> 'train'"), LABELS).collect())) for rows in both]
    assert picked[0] == picked[1]


def test_saved_model_is_reused_for_the_same_counts_only(both, tmp_path, corpus):
    train = both[1].where("split = 'train'")
    reused = lambda rows: models.load_or_fit(str(tmp_path), rows, LABELS, "Naive Bayes", 63, corpus[1].size)[1]
    assert [reused(train), reused(train), reused(train.where("row_id > 5")), reused(train)] == [False, True, False, True]


def test_rows_are_written_by_split_without_a_sort(spark, corpus, tmp_path):
    df, model = corpus
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    with session._settings(spark, session.OPEN_FILES):
        assert spark.conf.get(setting) == "8"
        rows = model.transform(df, carry=["split"])
        rows.write.partitionBy("split").parquet(str(tmp_path / "out"))
    assert spark.conf.get(setting) == before
    stored = ft.store_counts(model, df, carry=["label", "split"], partition_by=["split"])
    assert sorted({r.split for r in stored.frame.select("split").distinct().collect()}) == ["test", "train", "validation"]
    assert spark.conf.get(setting) == before


def test_queries_store_about_a_byte_an_entry(spark):
    from inkprint.plans import feature_queries as fq

    stored, _ = fq._stored(spark, "/root/testdata/sf0.001")
    entries = stored.sparse().agg(F.sum(F.size("indices"))).first()[0]
    size = sum(f.stat().st_size for name in stored.frame.inputFiles() for f in [Path(unquote(urlparse(name).path))])
    assert size < 3 * entries  # a vector's entry has twelve bytes


def test_labels_that_are_done_are_left_out_of_the_passes(both, corpus, monkeypatch):
    seen = []
    sums = svm.loss_sums

    def watched(rows, weights, slope, by_term=None):
        seen.append(len(weights))
        return sums(rows, weights, slope, by_term)

    monkeypatch.setattr(svm, "loss_sums", watched)
    model = models.fit(both[1].where("split = 'train'"), ["a", "b", "c", "never"], "Linear SVM", 64, corpus[1].size)
    assert seen[0] == 4 and min(seen) < 4 and all(s.converged for s in model.status)
