"""The pipeline against a plain version of its stages."""

import re

import corpus_pipeline
from inkprint.llm import pii
from tests.llm.test_exact import base_by_force, classes_by_force, words_of

SF = "/root/testdata/sf0.001"


def test_stages_by_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(corpus_pipeline.STAGES) == 5
    kept = {r.doc_id: r for r in corpus_pipeline.quality(spark, docs, SF).collect()}
    one = {r.doc_id for r in corpus_pipeline.one_of_each(spark, spark.createDataFrame(list(kept.values()), docs.schema), SF).collect()}
    classes = classes_by_force({i: r.text for i, r in kept.items()}, 5, 80)
    assert one == {i for i, (_, c) in classes.items() if c == i}
    items = [_windows(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {i for i in one if not any(5 * len(w & _windows(kept[i].text)) >= 4 * len(w) for w in items if w)}
    part = spark.createDataFrame([kept[i] for i in sorted(one)], docs.schema)
    left = corpus_pipeline.benchmark_free(spark, part, SF)
    assert {r.doc_id for r in left.collect()} == clean
    masked = {r.doc_id: r for r in corpus_pipeline.private(spark, left, SF).collect()}
    assert masked.keys() == clean
    for i, r in masked.items():
        assert all(kept[i].text[a:b] not in r.text for a, _, b, _ in base_by_force(kept[i].text)) and r.n_chars == len(r.text)
        assert r.text == kept[i].text or pii.base_spans(kept[i].text)
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {r.doc_id for r in rows} <= clean and all(r.mix_copies in (1, 2) and r.text == masked[r.doc_id].text for r in rows)
    total = sum(len(words_of(r.text)) for r in masked.values())
    assert abs(sum(r.mix_copies * len(words_of(r.text)) for r in rows) - 1.5 * total) <= 0.01 * total


def _windows(text):
    w = words_of(re.sub(r"[!-/:-@\[-`{-~]+", "", text.lower()))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
