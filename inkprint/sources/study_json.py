"""Study state as nested JSON, its flat report, and record import."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from inkprint import constants as K

_SCORE = "label STRING, name STRING, score DOUBLE"
_CHUNK = (
    "chunk INT, code_token_start INT, code_token_end INT, model_tokens INT, "
    "prediction STRING, score DOUBLE"
)
_ANALYSIS = (
    "classifier STRING, comments_removed BOOLEAN, analysis_mode STRING, chunk_count INT, "
    f"aggregation STRING, chunks ARRAY<STRUCT<{_CHUNK}>>, "
    "predicted_label STRING, top_score DOUBLE, gpt_score DOUBLE, input_tokens INT, "
    f"used_tokens INT, truncated BOOLEAN, scores ARRAY<STRUCT<{_SCORE}>>, error STRING"
)
_GENERATION = (
    "requested_model STRING, returned_model STRING, provider STRING, response_id STRING, "
    "finish_reason STRING, error STRING"
)
STUDY_SCHEMA = (
    "id STRING, status STRING, created_at STRING, updated_at STRING, models ARRAY<STRING>, "
    "prompts ARRAY<STRUCT<task STRING, prompt STRING>>, temperature DOUBLE, max_tokens INT, "
    "repetitions INT, analysis_modes ARRAY<STRING>, samples ARRAY<STRUCT<"
    "id STRING, task STRING, prompt STRING, repetition INT, model STRING, "
    f"generation_status STRING, code STRING, generation STRUCT<{_GENERATION}>, "
    f"analyses ARRAY<STRUCT<{_ANALYSIS}>>>>"
)


def read_studies(spark: SparkSession, path: str) -> DataFrame:
    """One study per file."""
    return spark.read.schema(STUDY_SCHEMA).option("multiLine", True).json(path)


def parse_studies(df: DataFrame, column: str = "value") -> DataFrame:
    return df.select(F.from_json(column, STUDY_SCHEMA).alias("s")).select("s.*")


def study_samples(studies: DataFrame) -> DataFrame:
    return studies.select(F.col("id").alias("study"), F.explode("samples").alias("s")).select(
        "study", F.col("s.id").alias("sample"), "s.task", "s.prompt", "s.repetition", "s.model",
        "s.generation_status", "s.code", "s.generation", "s.analyses",
        F.col("s.generation.finish_reason").alias("finish_reason"),
        F.coalesce(F.size("s.analyses"), F.lit(0)).alias("analysed"),
    )


def flatten_study(studies: DataFrame) -> DataFrame:
    """One row per analysis with the fixed report columns; records without a
    coverage mode are of the default mode."""
    rows = study_samples(studies).withColumn("a", F.explode("analyses"))
    named: dict[str, Column] = {
        "requested_model": F.col("model"),
        "returned_model": F.col("generation.returned_model"),
        "provider": F.col("generation.provider"),
        "analysis_mode": F.coalesce("a.analysis_mode", F.lit(K.DEFAULT_MODE)),
    }
    own = {"sample", "task", "repetition"}
    return rows.select(*[
        (named.get(c) if c in named else F.col(c if c in own else f"a.{c}")).alias(c)
        for c in K.COMPARISON_COLUMNS
    ])


def write_comparison(flat: DataFrame, path: str) -> None:
    flat.select(*K.COMPARISON_COLUMNS).write.mode("overwrite").option("header", True).option(
        "quoteAll", True
    ).csv(path)


_IMPORT_TYPES = {"temperature": T.DoubleType(), "max_tokens": T.IntegerType(), "sample_row": T.LongType()}
IMPORT_SCHEMA = T.ArrayType(T.StructType([
    T.StructField(c, _IMPORT_TYPES.get(c, T.StringType())) for c in K.IMPORT_FIELDS
]))


def import_records(df: DataFrame, column: str = "value", keep: list[str] = (),
                   max_records: int = K.MAX_IMPORT_RECORDS, max_chars: int = K.MAX_CODE_CHARS) -> DataFrame:
    """Uploaded JSON arrays to records with only the allowed fields.

    ``problem`` is null for a good record. A payload that is no array or holds no
    records gives one row with its problem; one with too many records keeps all of
    them, each marked ``record count``.
    """
    parsed = df.select(*keep, F.from_json(column, IMPORT_SCHEMA).alias("records"))
    size = F.coalesce(F.size("records"), F.lit(0))
    payload_problem = F.when((size < 1) | (size > max_records), F.lit("record count"))
    records = F.when(size >= 1, F.col("records")).otherwise(
        F.array(F.lit(None).cast(IMPORT_SCHEMA.elementType))
    )
    rows = parsed.select(*keep, payload_problem.alias("payload_problem"), F.posexplode(records).alias("position", "r"))
    record_problem = F.when(F.col("r").isNull(), "not a record").when(
        F.length("r.code") > max_chars, "code too long"
    )
    return rows.select(
        *keep, "position", "r.*", F.coalesce("payload_problem", record_problem).alias("problem")
    )
