"""Corpus-shaped views over the given test tables.

``documents`` become labelled programs (label = language, task group = source)
whose text is wrapped in C-like comments and literals; predictions, scores and
study records follow from hashes of the row ids, so both engines agree on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from inkprint import constants as K
from inkprint.functions import text as tx
from inkprint.operators import metrics, splits
from inkprint.operators.encode import generator_label
from inkprint.operators.study import with_cells

# Fixed values of the views.
LANGS = ["de", "en", "es", "fr"]
TASKS = ["gcd", "memory", "recursion", "sorting", "strings", "structures"]
UNKNOWN_MODEL = "vendor/unlisted-model"
STUDY_MODELS = list(K.GENERATOR_LABELS) + [UNKNOWN_MODEL]
ABLATION_CONDITIONS = ["original", "comments_removed", "limited_features"]
ABLATION_MODELS = ["m0", "m1", "m2", "m3"]


#: Session setting: partitions that texts are dealt to after the scan, for a table that is one small file.
#: Unset, as on a cluster, texts stay in the partitions of the scan.
SPREAD = "spark.inkprint.textPartitions"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def programs(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    parts = spark.conf.get(SPREAD, None)
    if parts:
        d = d.repartition(int(parts), "doc_id")
    plain = F.col("doc_id") % 40 == 0
    code = F.concat(
        F.when(plain, "").otherwise(F.concat(F.lit("// file "), "source", F.lit("\n"))),
        F.lit('#define U "http://x/'), F.col("lang"), F.lit('"\n'),
        F.when(plain, "").otherwise(F.concat(
            F.lit("/* "), F.replace(F.substring("text", 1, 60), F.lit("*/"), F.lit("")), F.lit("\n */\n")
        )),
        F.col("text"),
        F.when((F.col("doc_id") % 3 == 0) & ~plain, F.concat(F.lit(" // end "), "lang")).otherwise(""),
    )
    return d.select(
        F.col("doc_id").alias("row_id"), F.col("lang").alias("label"), F.col("source").alias("problem_id"),
        F.concat(F.lit("write for "), "source").alias("prompt"), code.alias("code"),
    ).withColumn("source_hash", tx.source_hash(F.col("code")))


def stripped(spark: SparkSession, sf: str) -> DataFrame:
    return programs(spark, sf).withColumn("stripped_code", tx.strip_comments(F.col("code")))


def split_programs(spark: SparkSession, sf: str) -> DataFrame:
    return splits.group_split(programs(spark, sf))


def split_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Split without the texts; the scan reads three columns."""
    d = table(spark, sf, "documents").select(
        F.col("doc_id").alias("row_id"), F.col("lang").alias("label"), F.col("source").alias("problem_id")
    )
    return splits.group_split(d)


def saved_splits(spark: SparkSession, sf: str) -> DataFrame:
    return split_programs(spark, sf).select("row_id", "label", "source_hash", "split", "problem_id")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*[p.cast("string") for p in parts]), 256)


def byte(hex_digest: Column, at: int = 1) -> Column:
    return F.conv(F.substring(hex_digest, at, 2), 16, 10).cast("int")


def next_label(label: Column) -> Column:
    following = dict(zip(LANGS, LANGS[1:] + LANGS[:1]))
    pairs = [F.lit(x) for item in following.items() for x in item]
    return F.element_at(F.create_map(*pairs), label)


def _predicted(salt: str) -> Column:
    wrong = F.substring(digest(F.lit(salt), F.col("row_id")), 1, 1).isin("0", "1", "2", "3")
    return F.when(wrong, next_label(F.col("label"))).otherwise(F.col("label"))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """row_id, true, predicted, predicted_cleaned; reads two columns."""
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), F.col("lang").alias("label"))
    return d.select("row_id", F.col("label").alias("true"), _predicted("o").alias("predicted"),
                    _predicted("s").alias("predicted_cleaned"))


def ablation_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Twelve condition x model predictions per held-out row; m3 repeats m2, so ranks tie."""
    rows = split_rows(spark, sf).where("split <> 'train'")
    conditions = F.array(*[F.lit(c) for c in ABLATION_CONDITIONS])
    models = F.array(*[F.lit(m) for m in ABLATION_MODELS])
    long = rows.select("*", F.posexplode(conditions).alias("ci", "condition")).select(
        "*", F.posexplode(models).alias("mi", "model")
    )
    strength = F.least("mi", F.lit(2))
    value = byte(digest(F.col("condition"), strength, F.col("row_id")))
    wrong = value < 20 + 30 * strength + 15 * F.col("ci")
    return long.select(
        "row_id", "condition", "model", "split", F.col("label").alias("true"),
        F.when(wrong, next_label(F.col("label"))).otherwise(F.col("label")).alias("predicted"),
    )


def ablation_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.model_metrics(ablation_predictions(spark, sf), ["condition", "model", "split"], LANGS)


def variant_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics per model and text variant, comments removed standing for stripped."""
    p = ablation_predictions(spark, sf).where("condition <> 'limited_features' and split = 'test'")
    variant = F.when(F.col("condition") == "original", "original").otherwise("stripped")
    return metrics.model_metrics(p.withColumn("variant", variant), ["model", "variant"], LANGS)


def wide_scores(spark: SparkSession, sf: str) -> DataFrame:
    """row_id, true and one prob_<label> per label, summing to 1."""
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), F.col("lang").alias("true"))
    raw = {x: byte(digest(F.col("row_id"), F.lit(x))) + 1 for x in LANGS}
    total = sum(raw.values())
    return d.select("row_id", "true", *[(v / total).alias(f"prob_{x}") for x, v in raw.items()])


def batches(spark: SparkSession, sf: str) -> DataFrame:
    """Event rows as a training log: run, epoch (day), loss, examples in the batch."""
    e = table(spark, sf, "events")
    return e.select(
        (F.col("user_id") % 4).alias("run"), F.dayofmonth("ts").alias("epoch"),
        (F.col("value") / 100).alias("loss"), (1 + F.col("event_id") % 16).alias("n"), "event_type",
    )


def history(spark: SparkSession, sf: str) -> DataFrame:
    return batches(spark, sf).groupBy("run", "epoch").agg(
        F.avg("loss").alias("training_loss"),
        F.avg((F.col("event_type") != "error").cast("int")).alias("validation_accuracy"),
        F.avg(F.col("event_type").isin("click", "purchase").cast("int")).alias("validation_macro_f1"),
    )


def samples(spark: SparkSession, sf: str) -> DataFrame:
    """Programs as study samples."""
    pick = lambda values, i: F.get(F.array(*[F.lit(v) for v in values]), i.cast("int"))
    i = F.col("row_id")
    requested = pick(STUDY_MODELS, F.floor(i / 6) % len(STUDY_MODELS))
    dated = i % 2 == 0
    returned = (
        F.when(i % 13 == 0, "vendor/another-version")
        .when((requested == "openai/gpt-4.1") & dated, "openai/gpt-4.1-2025-04-14")
        .when((requested == "deepseek/deepseek-chat") & dated, "deepseek/deepseek-chat-v3")
        .otherwise(requested)
    )
    status = (
        F.when(i % 7 == 6, "failed").when(i % 7 == 5, "in_progress")
        .when((i % 7 == 3) & (i % 5 == 0), "pending").otherwise("completed")
    )
    return programs(spark, sf).select(
        i.alias("row_id"), F.concat(F.lit("s"), i.cast("string")).alias("sample"),
        pick(TASKS, i % 6).alias("task"), F.col("prompt"), (i % 2 + 1).cast("int").alias("repetition"),
        requested.alias("model"), returned.alias("returned_model"),
        F.concat(F.lit("provider"), (i % 3).cast("string")).alias("provider"),
        F.when(i % 11 == 0, "length").otherwise("stop").alias("finish_reason"),
        status.alias("generation_status"), "code",
    )


def analyses(spark: SparkSession, sf: str) -> DataFrame:
    """Saved analyses: about one cell in eight is missing, one in sixteen failed."""
    cells = with_cells(samples(spark, sf).where("generation_status = 'completed'"))
    key = digest(F.col("sample"), F.lit("|"), F.col("classifier"), F.lit("|"),
                 F.col("comments_removed"), F.lit("|"), F.col("analysis_mode"))
    d = cells.withColumn("d", key).withColumn("digit", F.substring("d", 1, 1)).where(
        ~F.col("digit").isin("0", "1")
    )
    failed = F.col("digit") == "2"
    any_label = F.get(F.array(*[F.lit(x) for x in K.LABELS]), byte(F.col("d"), 3) % 5)
    label = F.when(F.col("digit") >= "8", F.coalesce(generator_label(F.col("model")), any_label)).otherwise(any_label)
    chunked = F.col("analysis_mode") == "chunks"
    tokens = F.floor(F.length("code") / 4).cast("int")
    ok = lambda c: F.when(~failed, c)
    return d.select(
        "sample", "row_id", "task", "repetition", "model", "returned_model", "provider", "finish_reason",
        "classifier", "comments_removed",
        # Records of the older classifier run carry no coverage mode.
        F.when(~(~chunked & (F.col("classifier") == "050")), F.col("analysis_mode")).alias("analysis_mode"),
        ok(F.when(chunked, 1 + F.floor(tokens / 512)).otherwise(1).cast("int")).alias("chunk_count"),
        ok(label).alias("predicted_label"),
        ok((128 + byte(F.col("d"), 5) / 2) / 256).alias("top_score"),
        ok(byte(F.col("d"), 7) / 512).alias("gpt_score"),
        ok(tokens).alias("input_tokens"),
        ok(F.when(chunked, tokens).otherwise(F.least(tokens, F.lit(512)))).alias("used_tokens"),
        ok(~chunked & (tokens > 512)).alias("truncated"),
        F.when(failed, "ValueError").alias("error"),
    )
