"""Report sinks: predictions, class scores, matrices, metrics and run records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T


def write_report(df: DataFrame, path: str, partition_by: list[str] = (), form: str = "parquet") -> None:
    """Replaces only the partitions present in ``df``, so results of other runs stay."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if form == "csv":
        writer = writer.option("header", True).option("quoteAll", True)
    writer.format(form).save(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType, form: str = "parquet") -> DataFrame:
    reader = spark.read.schema(schema)
    if form == "csv":
        reader = reader.option("header", True)
    return reader.format(form).load(path)


def write_run_record(spark: SparkSession, record: dict, path: str) -> None:
    """One JSON line describing a run (settings, sizes, seconds)."""
    import json

    spark.createDataFrame([(json.dumps(record, sort_keys=True),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)
