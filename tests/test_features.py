"""N-gram counts, TF-IDF and classifiers against plain Python."""

import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.ml.classification import NaiveBayes
from pyspark.sql import functions as F

from inkprint.functions import ngrams
from inkprint.operators import features as ft, linear, models, svm

TEXTS = ["int main  return", "for the loop", "", "ab", "été  naïve 😀 smile 😀", "int main int main", "zz"]


def grams(text, sizes=(3, 4, 5)):
    import re
    text = re.sub(r"\s\s+", " ", text)
    return Counter(text[i:i + n] for n in sizes for i in range(len(text) - n + 1))


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, t, "a" if i % 2 else "b") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "row_id long, code string, label string")


def test_char_ngrams(corpus):
    got = {(r.row_id, r.term): r.tf for r in ft.char_ngrams(corpus).collect()}
    assert got == {(i, t): n for i, text in enumerate(TEXTS) for t, n in grams(text).items()}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=12), st.booleans())
def test_count_pairs_with_any_alphabet(texts, wide):
    if wide:  # thousands of letters force ranks instead of plain codes
        texts = texts + ["".join(chr(0x4E00 + (i * 7919) % 20000) for i in range(9000))]
    got = Counter()
    for pairs in ngrams.count_pairs(texts, (3, 4, 5)):
        terms = pairs.terms.to_pylist()
        for row, n, t in zip(pairs.rows, pairs.counts, pairs.term_of_pair):
            got[int(row), terms[t]] += int(n)
    want = Counter()
    for i, text in enumerate(texts):
        for n in (3, 4, 5):
            for k in range(len(text) - n + 1):
                want[i, text[k:k + n]] += 1
    assert got == want


def brute_tfidf(texts, k, analyze, sublinear):
    counted = [analyze(t) for t in texts]
    cf = sum(counted, Counter())
    vocab = sorted(sorted(cf, key=lambda t: (-cf[t], t))[:k])
    df = {t: sum(t in c for c in counted) for t in vocab}
    idf = {t: math.log((1 + len(texts)) / (1 + df[t])) + 1 for t in vocab}
    rows = []
    for c in counted:
        w = {t: ((1 + math.log(c[t])) if sublinear else c[t]) * idf[t] for t in vocab if t in c}
        norm = math.sqrt(sum(x * x for x in w.values()))
        rows.append({t: x / norm for t, x in w.items()})
    return vocab, rows


def test_tfidf_char(corpus):
    vocab, want = brute_tfidf(TEXTS, 20, grams, True)
    model = ft.fit_tfidf(corpus, "char", max_features=20)
    assert model.terms == vocab
    f = model.transform(corpus, carry=["label"])
    assert f.count() == len(TEXTS)  # texts without known terms stay
    got = {(r.row_id, r.term): r.weight for r in model.explain(f).collect()}
    assert got == pytest.approx({(i, t): w for i, row in enumerate(want) for t, w in row.items()})


def test_tfidf_word(corpus):
    import re
    analyze = lambda t: Counter(re.findall(r"(?u)\b\w+\b", t.lower()))
    vocab, want = brute_tfidf(TEXTS, 6, analyze, False)
    model = ft.fit_tfidf(corpus, "word", max_features=6)
    assert model.terms == vocab
    got = {(r.row_id, r.term): r.weight for r in model.explain(model.transform(corpus)).collect()}
    assert got == pytest.approx({(i, t): w for i, row in enumerate(want) for t, w in row.items()})


def test_slices_do_not_change_counts(corpus, monkeypatch):
    whole = [(p.terms.to_pylist(), p.counts.tolist()) for p in ngrams.count_pairs(TEXTS, (3,))]
    total = Counter()
    for part in ngrams._row_slices([len(t) for t in TEXTS]):
        for p in ngrams.count_pairs(TEXTS[part], (3,)):
            for n, t in zip(p.counts, p.term_of_pair):
                total[p.terms.to_pylist()[t]] += int(n)
    monkeypatch.setattr(ngrams, "SLICE_CHARS", 5)
    small = Counter()
    parts = list(ngrams._row_slices([len(t) for t in TEXTS]))
    assert [i for p in parts for i in range(p.start, p.stop)] == list(range(len(TEXTS)))
    for part in parts:
        for p in ngrams.count_pairs(TEXTS[part], (3,)):
            for n, t in zip(p.counts, p.term_of_pair):
                small[p.terms.to_pylist()[t]] += int(n)
    assert whole and small == total


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(240):
        label = "abc"[i % 3]
        idx = np.sort(rng.choice(12, size=rng.integers(0, 6), replace=False))
        values = rng.random(len(idx)) + (idx % 3 == i % 3)
        rows.append((i, label, [int(x) for x in idx], [float(v) for v in values]))
    return spark.createDataFrame(rows, "row_id long, label string, indices array<int>, values array<double>")


def dense(df):
    rows = df.orderBy("row_id").collect()
    x = np.zeros((len(rows), 12))
    for i, r in enumerate(rows):
        x[i, r.indices] = r["values"]
    return x, [r.label for r in rows]


def test_naive_bayes_equals_spark_ml(labelled):
    ours = linear.fit_naive_bayes(labelled, ["a", "b", "c"], 12)
    vectors = ft.as_vectors(labelled, 12)
    target = vectors.withColumn("target", F.expr("array_position(array('a', 'b', 'c'), label) - 1").cast("double"))
    theirs = NaiveBayes(smoothing=1.0, modelType="multinomial", labelCol="target").fit(target)
    assert ours.weights == pytest.approx(theirs.theta.toArray())
    fitted = models.fit(vectors, ["a", "b", "c"], "Naive Bayes", 240, 12)
    a = {r.row_id: r.predicted for r in models.predict(fitted, vectors, ["a", "b", "c"]).collect()}
    b = {r.row_id: "abc"[int(r.prediction)] for r in theirs.transform(target).collect()}
    assert a == b


def test_svm_reaches_the_optimum(labelled):
    model = svm.fit_linear_svm(labelled, ["a", "b", "c"], 12, tolerance=1e-6)
    assert all(s.converged and s.relative_gradient <= 1e-6 for s in model.status)
    x, y = dense(labelled)
    x1 = np.hstack([x, np.ones((len(x), 1))])
    for k, label in enumerate(model.labels):
        sign = np.where(np.array(y) == label, 1.0, -1.0)
        w = np.zeros(13)
        for _ in range(100):  # Newton steps of the same objective
            short = np.maximum(0, 1 - sign * (x1 @ w))
            on = short > 0
            grad = w - 2 * x1.T @ (sign * short)
            w = w - np.linalg.solve(np.eye(13) + 2 * x1[on].T @ x1[on], grad)
        assert np.append(model.weights[k], model.intercepts[k]) == pytest.approx(w, abs=1e-4)


def test_linear_model_saves_and_loads(spark, labelled, tmp_path):
    model = linear.fit_naive_bayes(labelled, ["a", "b", "c"], 12)
    models.save(model, spark, str(tmp_path / "m"))
    again = models.load(spark, str(tmp_path / "m"))
    assert again.labels == model.labels and np.array_equal(again.weights, model.weights)


def test_softmax_sums_to_one_and_ties_take_label_order(spark):
    rows = spark.createDataFrame([([("a", 1000.0), ("b", 1000.0), ("c", -5.0)],)],
                                 "scores array<struct<label:string,score:double>>")
    r = rows.select(linear.softmax(F.col("scores")).alias("p"), linear.top_label(F.col("scores")).alias("t")).first()
    assert sum(x.score for x in r.p) == pytest.approx(1) and r.t == "a"
