"""The licence model and its threshold come from every paragraph of the corpus."""

import pytest
from pyspark.sql import functions as F

from inkprint.llm import licences


@pytest.fixture(scope="module")
def many(spark):
    """9,000 different paragraphs in 3,000 texts, and a repeated one in each."""
    i = F.col("id")
    lines = [F.concat(F.lit(f"row {k} of the "), F.sha2(F.concat(i.cast("string"), F.lit(k)).cast("binary"), 256)) for k in range(3)]
    return spark.range(3_000).select(i.alias("doc_id"), F.concat_ws("\n", *lines, F.lit("the same line again")).alias("text"))


def test_every_paragraph_is_learned_from(spark, many):
    found = licences.background(many, licences.Vocabulary(spark))
    total, aside = found.agg(F.sum("n"), F.sum(F.when(F.col("aside"), F.col("n")))).first()
    assert total == 9_001 and 2_000 < aside < 2_500


def test_threshold_counts_every_paragraph(spark):
    gaps = spark.range(5_000).select((F.col("id") / 7).alias("gap"), F.lit(2).alias("n"))
    # 10 of 10,000 may exceed it: the five greatest gaps.
    assert licences.least_handicap(gaps) == pytest.approx(4_994 / 7 + 1e-6)
    assert licences.least_handicap(gaps.where("false")) == 0 and licences.least_handicap(gaps.select((-F.col("gap") - 1).alias("gap"), "n")) == 0


def test_large_corpus_keeps_the_licences(spark, many):
    notice = spark.createDataFrame([(-1, "Some words before\nReleased under the MIT License.\nand after"), (-2, "no notice in this one")], "doc_id long, text string")
    found = {r.doc_id: [x.family for x in r.licences if x.confirmed] for r in licences.scan(many.unionByName(notice)).where("doc_id < 5").collect()}
    assert found[-1] == ["MIT"] and not any(v for k, v in found.items() if k != -1)
