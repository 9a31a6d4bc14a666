"""Label encoding and id mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from inkprint import constants as K


def label_set(df: DataFrame, label: str = "label", limit: int = 1000) -> list[str]:
    """Sorted distinct labels; fails when the column is not a closed set."""
    rows = df.select(label).where(F.col(label).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{label} has more than {limit} values")
    return sorted(r[0] for r in rows)


def _literal(labels: list[str]) -> Column:
    return F.array(*[F.lit(x) for x in labels])


def encode(label: Column, labels: list[str]) -> Column:
    """0-based position among the sorted labels, null when unknown."""
    at = F.array_position(_literal(sorted(labels)), label)
    return F.when(at > 0, (at - 1).cast("int"))


def decode(target: Column, labels: list[str]) -> Column:
    return F.get(_literal(sorted(labels)), target)


def generator_label(model: Column, mapping: dict[str, str] = K.GENERATOR_LABELS) -> Column:
    """Corpus label of a generator id, null when the id is unknown."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.element_at(F.create_map(*pairs), model)
