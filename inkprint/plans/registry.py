"""Named queries and, where SQL can express them, the equivalent DuckDB statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def bigint_counts(sql: str) -> str:
    """DuckDB counts conditions as HUGEINT; cast every count_if(...) to BIGINT."""
    out, at = [], 0
    while (start := sql.find("count_if(", at)) >= 0:
        end, depth = start + len("count_if("), 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        out.append(sql[at:start] + f"CAST({sql[start:end]} AS BIGINT)")
        at = end
    return "".join(out) + sql[at:]


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = bigint_counts(sql)
        return fn

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def r6(*columns: str) -> str:
    """SQL select list of columns rounded under their own names."""
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)
