"""Records of JSON files, found in parallel inside each file.

A record is an outermost object, so a file may hold one array, one object a line, or objects in a row. The text reader
cuts files at every ``}`` and deals them out by byte range; ``}`` is one byte, so no character is cut. Whether a range
begins inside a string, and how deep, follows from the ranges before it:

1. Each range tells what it does to a reader that arrives outside or inside a string: whether it flips that, and
   the depth it adds in either case.
2. These are composed in order by two running sums per file (a parity, then a depth), one row per range.
3. Each range, now with its state, gives the records that begin and end in it. What is left at its edges, one piece of a
   record at most at either end, is put together by the range the record begins in.

Texts are never shuffled but for those pieces, and no task reads more than its ranges.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from inkprint.functions.shipping import ship_with_job

ship_with_job(__name__)

#: Ranges whose states may be broadcast, once counted; beyond, pieces are dealt by range and sorted again.
BROADCAST_RANGES = 200_000
_MARK = re.compile(r'\\.|["{]', re.S)
_PIECES_A_BATCH = 5_000


def _walk(piece: str, inside: bool) -> tuple[bool, int, int]:
    """Whether the piece ends inside a string, the objects it opens, and where it opens the first (else -1)."""
    if '"' not in piece:
        return inside, 0 if inside else piece.count("{"), -1 if inside else piece.find("{")
    opened, first = 0, -1
    for mark in _MARK.finditer(piece):
        kind = mark[0]
        if kind == '"':
            inside = not inside
        elif kind == "{" and not inside:
            opened += 1
            first = mark.start() if first < 0 else first
    return inside, opened, first


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: whether it flips, depth added from outside and from inside a string, bytes."""
    held: dict[tuple[str, int], list] = {}
    for batch in batches:
        for file, start, size, piece in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "size", "piece"))):
            effect = held.setdefault((file, start), [False, True, 0, 0, 0, size])
            for arrived in (0, 1):
                effect[arrived], opened, _ = _walk(piece, effect[arrived])
                effect[2 + arrived] += opened - (not effect[arrived])
            effect[4] += len(piece.encode()) + 1
    rows = [(file, start, e[0], *e[2:]) for (file, start), e in held.items()]
    kinds = pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64()
    columns = list(zip(*rows)) or [()] * 7
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "start", "flips", "outside", "inside", "bytes", "size"])


class _Range:
    """Pieces of one range in order; ``told`` gets (file, start, number, role, text)."""

    def __init__(self, file: str, start: int, inside: bool, depth: int, open_end: bool, told: list[tuple]) -> None:
        self.key, self.inside, self.depth, self.open_end, self.told = (file, start), inside, depth, open_end, told
        self.parts: list[str] = []
        self.role = "rest" if depth > 0 else "record"  # of what is being read
        self.number, self.held = 0, None

    def add(self, piece: str) -> None:
        if self.held is not None:
            self._take(self.held, True)
        self.held = piece

    def _take(self, piece: str, closed: bool) -> None:
        self.inside, opened, first = _walk(piece, self.inside)
        if self.depth == 0 and first < 0:
            return  # between records
        self.parts.append((piece[first:] if self.depth == 0 else piece) + ("}" if closed else ""))
        self.depth += opened - (closed and not self.inside)
        if self.depth == 0:
            self._tell(self.role)

    def _tell(self, role: str) -> None:
        self.told.append((*self.key, self.number if role != "rest" else -1, role, "".join(self.parts)))
        self.number += role != "rest"
        self.parts, self.role = [], "record"

    def close(self) -> None:
        if self.held is not None:
            self._take(self.held, not self.open_end)
        if self.parts:
            self._tell("begin" if self.role == "record" else "rest")


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    told: list[tuple] = []
    kinds = pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()

    def out() -> pa.RecordBatch:
        columns = list(zip(*told)) or [()] * 5
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "start", "number", "role", "text"])
        told.clear()
        return made

    now: _Range | None = None
    for whole in batches:
        for at in range(0, whole.num_rows, _PIECES_A_BATCH):
            batch = whole.slice(at, _PIECES_A_BATCH)
            for file, start, piece, inside, depth, open_end in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "piece", "in_string", "depth", "open_end"))):
                if now is None or now.key != (file, start):
                    if now is not None:
                        now.close()
                    now = _Range(file, start, inside, depth, open_end, told)
                now.add(piece)
            yield out()
    if now is not None:
        now.close()
    yield out()


def _states(pieces: DataFrame) -> DataFrame:
    """file, start, and the state in which each range begins; open_end marks a file's last range if no ``}`` ends it."""
    effects = pieces.mapInArrow(_effects, "file string, start bigint, flips boolean, outside bigint, inside bigint, bytes bigint, size bigint")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum(F.col("flips").cast("int")).over(before), F.lit(0)) % 2 == 1
    added = F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))
    every = Window.partitionBy("file")
    states = effects.withColumn("in_string", turned).withColumn("depth", F.coalesce(F.sum(added).over(before), F.lit(0)))
    states = states.withColumn("last", F.max("start").over(every) == F.col("start")).withColumn("read", F.sum("bytes").over(every))
    return states.select("file", "start", "in_string", "depth", (F.col("last") & (F.col("read") > F.col("size"))).alias("open_end"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, start (of the byte range), number (in the range) and text of every record, in file order by these three.

    A record that the end of its file cuts short is given as it stands and does not parse.
    """
    read = spark.read.option("lineSep", "}").text(path)
    pieces = read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("piece"))
    sized = read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                        F.col("_metadata.file_size").alias("size"), F.col("value").alias("piece"))
    states = _states(sized).cache()
    if states.count() <= BROADCAST_RANGES:
        arrived = pieces.join(F.broadcast(states), ["file", "start"])
    else:
        numbered = pieces.withColumn("at", F.monotonically_increasing_id())
        arrived = numbered.join(states, ["file", "start"]).repartition("file", "start").sortWithinPartitions("file", "start", "at")
    found = arrived.select("file", "start", "piece", "in_string", "depth", "open_end").mapInArrow(
        _found, "file string, start bigint, number bigint, role string, text string")
    whole = found.where("role = 'record'")
    # A record's pieces: where it begins, then the rest of it from the ranges that follow.
    edges = found.where("role <> 'record'")
    begun = F.col("role") == "begin"
    in_order = Window.partitionBy("file").orderBy("start", "number").rowsBetween(Window.unboundedPreceding, 0)
    edges = edges.withColumn("origin", F.max(F.when(begun, F.struct("start", "number"))).over(in_order))
    joined = edges.groupBy("file", "origin").agg(F.sort_array(F.collect_list(F.struct("start", "number", "text"))).alias("parts"))
    joined = joined.select("file", "origin.start", "origin.number", F.array_join("parts.text", "").alias("text"))
    return whole.drop("role").unionByName(joined)
