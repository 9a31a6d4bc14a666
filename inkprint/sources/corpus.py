"""Corpus and split scans with explicit schemas and stable row ids."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from inkprint.functions.shipping import ship_with_job
from inkprint.functions.text import source_hash
from inkprint.sources import json_records

ship_with_job(__name__)

RECORD_SCHEMA = T.StructType([
    T.StructField("c_code", T.StringType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("prompt", T.StringType()),
])
#: Files whose offsets may be broadcast, once counted.
BROADCAST_FILES = 200_000
SPLIT_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("label", T.StringType()),
    T.StructField("source_hash", T.StringType()),
    T.StructField("split", T.StringType()),
    T.StructField("problem_id", T.StringType()),
])


def number_by_file(df: DataFrame, file: str = "file", position: str = "position") -> DataFrame:
    """Adds ``row_id``, 0-based over all files in path order.

    Positions within a file come from the scan. Only the row count per file is
    aggregated, so no row is sorted to be numbered; none is moved either unless
    there are more files than may be broadcast. ``file`` may be a struct of ordered parts of files.
    """
    counts = df.groupBy(file).agg(F.count("*").alias("n"))
    before = Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(file, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")).cache()
    if offsets.count() <= BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    return df.join(offsets, file).withColumn("row_id", F.col("offset") + F.col(position)).drop("offset")


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet rows with ``file`` and ``position`` taken from the reader itself."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path).select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("position")
    )


def _corpus(records: DataFrame) -> DataFrame:
    """Parsed records (file, value) to the corpus columns."""
    parsed = F.from_json("value", T.ArrayType(RECORD_SCHEMA))
    rows = records.select("file", F.posexplode(parsed).alias("position", "r"))
    return number_by_file(rows).select(
        "row_id", F.col("r.c_code").alias("code"), F.col("r.model_name").alias("label"),
        F.col("r.prompt").alias("prompt"), source_hash(F.col("r.c_code")).alias("source_hash"),
    )


def read_corpus_json(spark: SparkSession, path: str) -> DataFrame:
    """Files of records (an array, lines, or objects in a row), each read by as many tasks as it has byte ranges."""
    rows = read_records(spark, path, RECORD_SCHEMA).withColumn("part", F.struct("file", "start"))
    return number_by_file(rows, "part", "number").select(
        "row_id", F.col("r.c_code").alias("code"), F.col("r.model_name").alias("label"),
        F.col("r.prompt").alias("prompt"), source_hash(F.col("r.c_code")).alias("source_hash"),
    )


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """file, start, number and the parsed record r; fields outside ``schema`` are ignored."""
    return json_records.records(spark, path).select("file", "start", "number", F.from_json("text", schema).alias("r"))


def _members(frames):
    for frame in frames:
        for path, content in zip(frame["path"], frame["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for name in sorted(archive.namelist()):
                    if name.endswith(".json"):
                        text = archive.read(name).decode("utf-8")
                        yield pd.DataFrame({"file": [f"{path}/{name}"], "value": [text]})


def read_corpus_zip(spark: SparkSession, path: str) -> DataFrame:
    """The same from zipped files."""
    zipped = spark.read.format("binaryFile").load(path).select("path", "content")
    return _corpus(zipped.mapInPandas(_members, "file string, value string"))


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SPLIT_SCHEMA).csv(path, header=True)
