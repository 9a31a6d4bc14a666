"""A corpus pipeline of five stages over ``documents``; every stage works on what the one before kept.

All but the last return the columns of ``documents``. The last returns the documents of the mix with
``mix_copies``, the times each is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkprint.llm import decontaminate, mixing, ngram_join, pii, quality_rules
from inkprint.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules keep."""
    return quality_rules.keep(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return ngram_join.keep_one(docs, width=5, percent=80)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and what reveals it replaced."""
    return pii.sanitise(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix that meets the sources' word budgets."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", benchmark_free),
    ("PII", private),
    ("mixing", mixed),
]

#: The PII stage replaces spans by pattern and corpus statistics and the mixing stage follows a knapsack table; SQL
#: cannot express either. tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read back by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = materialize(docs, f"stage{place}")
    return docs
