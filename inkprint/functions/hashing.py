"""Deterministic 32-bit order keys from SHA-256, the same on every engine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hash32(value: Column) -> Column:
    """First eight hex digits of SHA-256 as a BIGINT in [0, 2**32)."""
    return F.conv(F.substring(F.sha2(value.cast("string"), 256), 1, 8), 16, 10).cast("bigint")


def seeded(seed: int | str, key: Column) -> Column:
    """Hash of ``seed:key``; another seed gives an independent order."""
    return hash32(F.concat(F.lit(f"{seed}:"), key.cast("string")))
