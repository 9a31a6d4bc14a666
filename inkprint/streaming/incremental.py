"""Incremental study scoring: score only missing cells, append, never repeat.

Works on a batch of samples (an anti-join with earlier results finds the missing cells) or on a
file stream (keyed state does). Each batch writes its own ``batch=<name>`` folder with
overwrite, so a retried batch replaces its own output.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from inkprint import constants as K
from inkprint.operators.study import CELL, with_cells
from inkprint.session import path_exists

#: Number and values of each cell of a sample, and the mask of all.
_CELLS = [(bit, *cell) for bit, cell in enumerate(itertools.product(K.CLASSIFIERS, [False, True], K.MODES))]
_ALL = (1 << len(_CELLS)) - 1
Scorer = Callable[[DataFrame], DataFrame]


def _same(samples: DataFrame) -> DataFrame:
    return samples


def _greatest(version: list[str], row: Column) -> Column:
    """Of the struct ``row`` the greatest of a group, by ``version`` and then by all its fields; each text is held once."""
    return F.max(F.struct(*[row[v].alias(f"v{at}") for at, v in enumerate(version)], row.alias("s")))["s"]


def _inlined(samples: DataFrame) -> DataFrame:
    return samples.select("*", F.inline("__cells")).drop("__cells")


def append_missing(samples: DataFrame, scorer: Scorer, path: str, batch: str, version: list[str] = (), shared: Scorer = _same) -> None:
    """Score the cells of completed samples that no other batch has scored.

    Of a sample delivered several times in one batch the greatest by ``version``, then by all its columns, counts. ``shared``
    adds to a sample what its cells have in common; unlike ``scorer`` it sees every text once, not once a cell.
    """
    spark = samples.sparkSession
    whole = F.struct(*[F.col(f"`{c}`") for c in samples.columns])
    completed = samples.where("generation_status = 'completed'").select(whole.alias("s")).groupBy("s.sample").agg(
        _greatest(version, F.col("s")).alias("s")).select("s.*")
    if path_exists(spark, path):
        done = spark.read.parquet(path).where(f"batch <> '{batch}'").select(*CELL)
        # Cells are matched by key alone; each text is joined once to its missing
        # cells (at most one per classifier, comment setting and mode).
        missing = with_cells(completed.select("sample")).join(done, CELL, "left_anti")
        per_sample = missing.groupBy("sample").agg(F.collect_list(F.struct(*CELL[1:])).alias("__cells"))
        cells = _inlined(shared(completed.join(per_sample, "sample")))
    else:
        cells = with_cells(shared(completed))
    scorer(cells).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def known_cells(scored: DataFrame) -> DataFrame:
    """sample and bit of cells that are scored already."""
    number = F.create_map(*[x for cell in _CELLS for x in (F.lit(_name(*cell[1:])), F.lit(cell[0]))])
    named = F.concat_ws("/", "classifier", F.col("comments_removed").cast("string"), "analysis_mode")
    return scored.select("sample", number[named].alias("bit")).where("bit is not null")


def _name(classifier: str, comments_removed: bool, mode: str) -> str:
    return f"{classifier}/{str(comments_removed).lower()}/{mode}"


def _drain(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    stream.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _newly_asked(told: DataFrame) -> DataFrame:
    """sample and mask of the missing cells of samples whose first text came with the batch that is told now.

    ``told`` is a stream of sample, mask (cells scored elsewhere), asked (a text came) and number (of the batch). Told again,
    a batch has the same result, as its number is still the first and the last of its samples.
    """
    state = told.groupBy("sample").agg(
        F.bit_or("mask").alias("known"), F.min(F.when(F.col("asked"), F.col("number"))).alias("first"), F.max("number").alias("last"))
    return state.where("first = last").select("sample", F.lit(_ALL).bitwiseAND(F.bitwise_not("known")).alias("missing")).where("missing <> 0")


def score_stream(stream: DataFrame, scorer: Scorer, path: str, checkpoint: str, run: str = "run", version: list[str] = (), known: DataFrame | None = None, shared: Scorer = _same) -> None:
    """Drain a file stream; calling it again picks up only new files.

    What is scored is keyed state: one mask of cells per sample, kept by a stream of keys in ``checkpoint``, beside the progress
    of the stream of texts. Every batch of texts tells that stream its keys, and its answer is joined with the batch, so no text
    goes through the state and no batch reads earlier results. A batch that failed tells its keys again, gets the same answer
    and replaces its own output.
    ``known``, a stream of sample, classifier, comments_removed and analysis_mode, holds cells scored elsewhere; its files
    must be there before the samples are. A sample delivered several times in one batch counts once, as in
    :func:`append_missing`, where ``shared`` is described too.
    """
    spark = stream.sparkSession
    if path_exists(spark, f"{checkpoint}/offsets"):
        raise ValueError(f"{checkpoint} holds masks of an earlier form, which are not read")
    whole = F.struct(*[F.col(f"`{c}`") for c in stream.columns])
    told = stream.where("generation_status = 'completed'").select("sample", whole.alias("s"), F.lit(0).alias("mask"))
    if known is not None:
        no_text = F.lit(None).cast(told.schema["s"].dataType)
        told = told.unionByName(known_cells(known).select("sample", no_text.alias("s"), F.expr("shiftleft(1, bit)").alias("mask")))
    keys = spark.readStream.schema(told.select("sample", "mask", F.lit(True).alias("asked"), F.lit(0).cast("bigint").alias("number")).schema)
    answers = told.select("sample", F.col("mask").alias("missing")).schema
    cells = F.array(*[F.struct(F.lit(1 << bit).alias("bit"), *[F.lit(v).alias(c) for c, v in zip(CELL[1:], cell)]) for bit, *cell in _CELLS])

    def each(batch: DataFrame, number: int) -> None:
        batch.groupBy("sample").agg(F.bit_or("mask").alias("mask"), F.max(F.col("s").isNotNull()).alias("asked")).write.mode(
            "append").parquet(f"{checkpoint}/keys/number={number}")
        answer = f"{checkpoint}/missing/number={number}"
        _drain(_newly_asked(keys.parquet(f"{checkpoint}/keys")), lambda rows, _: rows.write.mode("overwrite").parquet(answer), f"{checkpoint}/masks", "update")
        missing = batch.sparkSession.read.schema(answers).parquet(answer)
        # A struct is a key that also finds the sample without a name.
        key = F.struct("sample").alias("key")
        texts = batch.where("s is not null").select(key, "s").join(missing.select(key, "missing"), "key")
        latest = texts.groupBy("key").agg(_greatest(version, F.col("s")).alias("s"), F.max("missing").alias("missing"))
        wanted = F.filter(cells, lambda c: F.col("missing").bitwiseAND(c["bit"]) != 0)
        asked = latest.select("s.*", F.transform(wanted, lambda c: F.struct(*[c[x].alias(x) for x in CELL[1:]])).alias("__cells"))
        scorer(_inlined(shared(asked))).write.mode("overwrite").parquet(f"{path}/batch={run}-{number}")

    _drain(told, each, f"{checkpoint}/texts")
