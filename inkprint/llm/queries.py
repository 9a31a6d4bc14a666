"""Registered queries of this package: thin digests of the operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from inkprint.llm import (coordinate_join, decontaminate, hard_negatives, licences, lm_score, mixing, ngram_join, pii, pu_quality, quality_rules,
                          spelling, toxicity, url_filter)
from inkprint.llm.sql import OP1_SQL, OP6_SQL, OP10_SQL, OP13_SQL, URL_RULES

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("_row.page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.report(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *quality_rules.MEASURES, "base_failed", "kept")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents"))


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most probable confirmed licence of every document, null where there is none."""
    found = licences.scan(table(spark, sf_dir, "documents"))
    sure = F.filter("licences", lambda x: x["confirmed"])
    best = F.array_max(F.transform(sure, lambda x: F.struct(x["p"].alias("p"), x["family"].alias("family"))))
    return found.select("doc_id", "n_paragraphs", F.size("licences").cast("bigint").alias("n_predicted"), F.size(sure).cast("bigint").alias("n_confirmed"),
                        best["family"].alias("licence"), F.round(best["p"], 6).alias("probability"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.col("n_windows").cast("bigint").alias("n_windows"), F.col("n_shared").cast("bigint").alias("n_shared"))


def op11_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coordinate_join.classes(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_url_filter": op1_url_filter,
    "op2_toxicity": op2_toxicity,
    "op3_mixing": op3_mixing,
    "op4_pii": op4_pii,
    "op5_lm_score": op5_lm_score,
    "op6_quality_rules": op6_quality_rules,
    "op7_ngram_join": op7_ngram_join,
    "op8_licence_scan": op8_licence_scan,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_decontamination": op10_decontamination,
    "op11_minhash_join": op11_minhash_join,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLES: dict[str, str] = {"op1_url_filter": OP1_SQL, "op6_quality_rules": OP6_SQL, "op10_decontamination": OP10_SQL, "op13_hard_negatives": OP13_SQL}
