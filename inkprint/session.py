"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

#: Rows that a task decodes, and bytes it hands to Python, at once while one row is a vector of thousands of entries. Spark's
#: 4,096 rows of 3,000 entries are some hundred megabytes for each task.
WIDE_ROWS = {"spark.sql.parquet.columnarReaderBatchSize": "128", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
#: A task that writes few partitions keeps a file open for each instead of sorting its rows by partition, which spills them.
OPEN_FILES = {"spark.sql.maxConcurrentOutputFileWriters": "8"}
_written: list[str] = []


def build_session(app: str = "inkprint", master: str | None = None, **conf) -> SparkSession:
    """Session with adaptive execution on; cluster settings stay with the cluster."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def wide_rows(spark: SparkSession) -> Iterator[None]:
    """Jobs that are planned inside read and send a few wide rows at a time; the session's settings come back afterwards."""
    with _settings(spark, WIDE_ROWS):
        yield


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def work_folder(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    A folder of our own is made only for a local master; on a cluster a
    machine-local folder would not be seen by the executors, so that is an error.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="inkprint-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder of ours; :func:`release` removes all of them."""
    path = f"{work_folder(spark)}/inkprint/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def release(spark: SparkSession) -> int:
    """Remove the folders written so far, once no result that reads them is needed; how many there were."""
    found = 0
    while _written:
        target = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        found += bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True))
    return found


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None,
                schema=None, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Unlike a cached frame the files outlive a lost executor, and a partitioned
    write lets later reads prune.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    writer = df.write.options(**options or {})
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _settings(spark, OPEN_FILES if partition_by else {}):
        writer.parquet(path)
    reader = spark.read
    return (reader.schema(schema) if schema is not None else reader.schema(df.schema)).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
