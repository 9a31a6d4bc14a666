"""Labelled rows come first in the sample that classifiers are fitted on."""

from pyspark.sql import functions as F

from inkprint.llm.toxicity import fit_sample


def taken(spark, n_labels, rows, n_docs=4_000):
    docs = spark.range(n_docs).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    labels = spark.range(n_labels).select((7 * F.col("id")).alias("doc_id"), (F.col("id") % 2).cast("int").alias("label"))
    found = fit_sample(docs, labels, F.col("doc_id") % 5 == 0, "label", rows).collect()
    assert all(r.doc_id % 5 and r.text == f"text {r.doc_id}" for r in found)
    assert all((r.label is None) == (r.doc_id % 7 > 0 or r.doc_id >= 7 * n_labels) for r in found)
    return sum(r.label is not None for r in found), sum(r.label is None for r in found)


def test_few_labels_are_all_taken(spark):
    with_label, without = taken(spark, 50, 400)
    assert with_label == 40 and 280 < without < 440  # 40 of the 50 are training rows


def test_many_labels_take_half(spark):
    with_label, without = taken(spark, 500, 200)
    assert 60 < with_label < 140 and 60 < without < 140


def test_everything_where_it_fits_and_nothing_where_there_is_nothing(spark):
    assert taken(spark, 500, 100_000) == (400, 2_800)
    assert taken(spark, 0, 100_000) == (0, 3_200) and taken(spark, 5, 100, n_docs=0) == (0, 0)
