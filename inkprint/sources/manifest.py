"""Content checked against recorded SHA-256 hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from inkprint.functions.text import unix_newlines

BARE_C_NAME = r"^[^/\\]+\.c$"


def verify(found: DataFrame, manifest: DataFrame, name_form: str | None = None) -> DataFrame:
    """(file, status) for every manifest entry.

    ``found`` has (file, sha256), the manifest (file, sha256). Status is ``ok``,
    ``bad name``, ``missing`` or ``mismatch``.
    """
    wanted = manifest.select("file", F.col("sha256").alias("expected"))
    joined = wanted.join(found.select("file", F.col("sha256").alias("actual")), "file", "left")
    status = F.when(F.col("actual").isNull(), "missing").when(
        F.col("actual") != F.col("expected"), "mismatch"
    ).otherwise("ok")
    if name_form:
        status = F.when(~F.col("file").rlike(name_form), "bad name").otherwise(status)
    return joined.select("file", status.alias("status"))


def hash_files(spark: SparkSession, path: str, unix_csv: bool = True) -> DataFrame:
    """(file, sha256, bytes) of the files under ``path``; CSV line ends are made LF first."""
    files = spark.read.format("binaryFile").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    content = F.sha2("content", 256)
    if unix_csv:
        text = unix_newlines(F.decode("content", "UTF-8"))
        content = F.when(name.endswith(".csv"), F.sha2(text, 256)).otherwise(content)
    return files.select(name.alias("file"), content.alias("sha256"), F.col("length").alias("bytes"))


def require_ok(status: DataFrame) -> None:
    bad = status.where("status <> 'ok'").orderBy("file").limit(5).collect()
    if bad:
        raise ValueError("content check failed: " + ", ".join(f"{r.file}: {r.status}" for r in bad))
