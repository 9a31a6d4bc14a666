"""Nulls, empty and very long texts, repeated rows, empty tables and clashing column names."""

import pytest
from pyspark.sql import functions as F

from inkprint.llm import decontaminate, licences, lm_score, mixing, ngram_join, pii, pu_quality, quality_rules, toxicity, url_filter


def ids(df, column="doc_id"):
    return sorted((r[column] is None, r[column] or 0) for r in df.collect())


EVERY_ID = sorted((i is None, i or 0) for i in [1, 2, 3, 4, 5, None, 6, 6, 7, 8])


def test_url_filter(spark):
    pages = spark.createDataFrame([(1, None, "v"), (2, "", "v"), (3, "no scheme", "v"), (4, "http://A.net", "v"), (4, "http://A.net", "v"), (5, "x://" + "a" * 100_000, "v")], "page_id bigint, url string, verdict string")
    rows = url_filter.judge(pages, [("net/", "block")]).select("_row.page_id", "host", "path", "rule", "verdict").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows[:4]] == [("", "", None, "allow")] * 3 + [("a.net", "", None, "allow")]
    assert len(rows) == 6 and url_filter.judge(pages.where("false"), []).count() == 0


def test_quality_rules(odd_docs, no_docs):
    kept = quality_rules.keep(odd_docs)
    assert kept.columns == odd_docs.columns and ids(kept) == [(False, 1), (False, 2), (False, 8)]
    found = {r.doc_id: r for r in quality_rules.report(odd_docs).collect()}
    assert found[3].n_words == 0 and found[3].base_failed and found[7].n_repeat_words == 30_000
    assert quality_rules.keep(no_docs).count() == 0


def test_join(odd_docs, no_docs):
    rows = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.classes(odd_docs).collect()}
    assert {(1, 13, 1), (2, 13, 1), (8, 13, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6), (None, 6, None)} <= rows
    assert ids(ngram_join.keep_one(odd_docs)) == sorted((i is None, i or 0) for i in [1, 3, 4, 5, None, 6, 6, 7])
    assert ngram_join.keep_one(odd_docs).columns == odd_docs.columns and ngram_join.classes(no_docs).count() == 0


def test_decontamination(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "fox jumps over the lazy dog near"), (2, None), (3, ""), (4, "ONE!"), (None, "quick brown fox jumps over the lazy cat")], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id, r.n_windows, r.n_shared) for r in decontaminate.leaks(odd_docs, items).collect()}
    assert found == {(d, 1, 3, 3) for d in (1, 2, 8)} | {(6, 4, 1, 1)}
    clean = decontaminate.drop_contaminated(odd_docs, items)
    assert clean.columns == odd_docs.columns and ids(clean) == sorted((i is None, i or 0) for i in [3, 4, 5, None, 7])
    assert decontaminate.leaks(no_docs, items).count() == 0 and decontaminate.drop_contaminated(odd_docs, items.where("false")).count() == 10


def test_pii(odd_docs, no_docs):
    assert ids(pii.report(odd_docs)) == EVERY_ID
    same = pii.sanitise(odd_docs)
    assert same.columns == odd_docs.columns and same.exceptAll(odd_docs).count() == 0 and pii.sanitise(no_docs).count() == 0


def test_mixing(odd_docs, no_docs):
    rows = mixing.report(odd_docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == EVERY_ID
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows) and sum(r.taken for r in rows if r.doc_id == 3) == 0
    assert mixing.mix(odd_docs).columns == [*odd_docs.columns, "mix_copies"] and mixing.report(no_docs).count() == 0


def test_lm_score(odd_docs, no_docs):
    rows = lm_score.score(odd_docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == EVERY_ID
    by = {r.doc_id: r for r in rows}
    assert by[3].n_tokens == by[4].n_tokens == 1 and by[3].score == by[4].score < 0 and by[7].n_tokens == 30_002
    assert by[1].score == pytest.approx(by[8].score) and lm_score.score(no_docs).count() == 0


def test_licences(odd_docs, no_docs):
    model = licences.train(odd_docs)
    rows = licences.scan(odd_docs, model)
    assert ids(rows) == EVERY_ID and rows.where(F.size("licences") > 0).count() == 0 and licences.scan(no_docs, model).count() == 0
    assert licences.scan(no_docs).count() == 0


@pytest.mark.parametrize("operator", [toxicity, pu_quality])
def test_classifiers(odd_docs, no_docs, odd_labels, operator):
    rows = operator.score(odd_docs, odd_labels).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == EVERY_ID
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert operator.score(odd_docs, odd_labels.where("false")).count() == 10 and operator.score(no_docs, odd_labels).count() == 0
