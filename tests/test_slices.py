"""Kernels work on bounded slices of a batch and give the same rows."""

import numpy as np
import pyarrow as pa

from inkprint.functions import ngrams


class Shared:
    value = (["a", "b", "c"], np.array([1.0, 2.0, 3.0]), False)


def test_token_lists_are_weighed_in_slices(monkeypatch):
    rows = [["a", "b", "x"], [], None, ["c"] * 5, ["b", "a", "a"], ["x"], ["a"] * 20, ["c", "b"]]
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string())), pa.array(range(len(rows)))], names=["t", "row_id"]).slice(1)
    kernel = ngrams.weigh_tokens(Shared)
    whole = list(kernel([batch]))
    monkeypatch.setattr(ngrams, "SLICE_TOKENS", 6)
    parts = list(kernel([batch]))
    assert len(whole) == 1 and len(parts) == 4
    assert pa.Table.from_batches(parts).to_pydict() == pa.Table.from_batches(whole).to_pydict()
    assert whole[0].column("row_id").to_pylist() == list(range(1, 8))


def test_ngram_lists_are_the_rows_of_the_long_form():
    texts = ["abcabc", "", "ab", "xyzzyx\U0001f600\U0001f600", "abcab"]
    batch = pa.RecordBatch.from_arrays([pa.array([5, 6, 7, 8, 9]), pa.array(texts)], names=["row_id", "text"])
    long = pa.Table.from_batches(ngrams.row_counts((3, 4))([batch])).to_pydict()
    lists = pa.Table.from_batches(ngrams.row_lists((3, 4))([batch])).to_pydict()
    flat = [(i, t, n) for i, terms, tfs in zip(*lists.values()) for t, n in zip(terms, tfs)]
    assert flat == list(zip(*long.values())) and len(lists["row_id"]) == 6
    assert all(len({len(t) for t in terms}) == 1 for terms in lists["terms"])


def test_char_ngrams_sorts_and_shuffles_no_terms(spark):
    from inkprint.plans import feature_queries as fq

    plan = fq.char_ngrams(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "array_min" in plan and "length(terms" in plan and "min(term#" not in plan


def test_long_form_is_made_without_a_join(spark):
    from inkprint.operators import features as ft

    df = spark.createDataFrame([(1, "ab ab c"), (2, "zz"), (3, "c")], "row_id long, code string")
    model = ft.fit_tfidf(df.where("row_id <> 2"), "word", max_features=10)
    long = model.explain(model.transform(df))
    assert "Join" not in long._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.row_id, r.term) for r in long.collect()) == [(1, "ab"), (1, "c"), (3, "c")] and long.columns == ["row_id", "weight", "term"]
