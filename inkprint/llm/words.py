"""Column expressions shared by the operators of this package: words, windows, quoting.

Words are runs of characters outside ``[\\x20\\x09-\\x0D]``. Every expression binds an array
once with :func:`let`, so that a lambda over its positions does not build it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and leave every other character as it is."""
    one_byte = F.octet_length(text) == F.length(text)
    return F.when(one_byte, F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def window_hashes(tokens: Column, width: int) -> Column:
    """64-bit hash of every ``width`` consecutive tokens, in order; empty when there are fewer."""
    starts = F.sequence(F.lit(0), F.size(tokens) - width)
    none = F.array().cast("array<bigint>")
    return F.when(F.size(tokens) < width, none).otherwise(
        F.transform(starts, lambda i: F.xxhash64(*[tokens[i + j] for j in range(width)])))


def packed(frame: DataFrame) -> Column:
    """The whole row as one struct, so that columns of ours cannot clash with the caller's."""
    return F.struct(*[F.col(f"`{name}`") for name in frame.columns])


def unpacked(frame: DataFrame, columns: list[str], *more: Column) -> DataFrame:
    return frame.select(*[F.col(f"_row.`{name}`").alias(name) for name in columns], *more)
