"""Run a query on Spark and its SQL on DuckDB and compare the two row multisets."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short description of the first differences."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    want = rows_of(names, result.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got == want:
        kinds = {n: t for n, t in zip(names, [str(d[1]) for d in result.description])}
        bad = [n for n, t in kinds.items() if "HUGEINT" in t or "DECIMAL" in t]
        return f"SQL types of {bad}" if bad else None
    extra, missing = got - want, want - got
    return (f"{sum(got.values())} rows against {sum(want.values())}; "
            f"only Spark {list(extra.items())[:2]}; only SQL {list(missing.items())[:2]}")
