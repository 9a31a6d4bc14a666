"""Quality classifier learnt from trusted positives and unlabelled text, by non-negative unbiased risk.

Texts are described by statistics of their characters, words and lines, each cut into quantile cells; the
classifier is linear in the cells. Positives are training rows labelled 1, unlabelled are training rows without
a label; rows labelled 0 are not used. The class prior is estimated from a first classifier that separates
positives from unlabelled rows: over its upper score ranges, the least ratio of unlabelled to
positive rows, each half of the sample judged by the classifier of the other. Then ``prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))`` is minimised; while the
second part is negative its descent is reversed.

The fit uses a sample of about ``FIT_ROWS`` training rows, labelled ones first, chosen by hash of the id; only their statistics reach the
driver. Every whole text is scored.

Null and empty texts have all statistics 0 and are scored as such. Null ids are never learnt from. Repeated
rows are scored each. Without positives or without unlabelled rows every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from inkprint.functions.shipping import ship_with_job
from inkprint.llm.shingles import hash_words, mix, slices
from inkprint.llm.toxicity import fit_sample

ship_with_job(__name__)

FIT_ROWS = 40_000
CELLS = 24
PASSES = 500

_U = np.uint64
#: Byte classes: other, space, line end, lower, upper, digit, symbol, full stop or comma, exclamation, bar, other ASCII mark, beyond ASCII.
_CLASS = np.zeros(256, np.int64)
for _k, _of in enumerate((" \t\r\x0b\x0c", "\n", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#*$%&<>", ".,", "!?", "|", ";:'\"()[]{}/\\-_=+~^`@"), 1):
    _CLASS[[ord(_c) for _c in _of]] = _k
_CLASS[128:] = 11
_CLASSES = 12
STATISTICS = 18


def _repeats(keys: np.ndarray) -> tuple[float, float]:
    """Share of entries that are not first of their kind, and share of the most frequent kind."""
    if len(keys) == 0:
        return 0.0, 0.0
    _, counts = np.unique(keys, return_counts=True)
    return 1 - len(counts) / len(keys), counts.max() / len(keys)


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of statistics per text."""
    out = np.zeros((len(texts), STATISTICS))
    for first, last in slices(texts):
        part = [t or "" for t in texts[first:last]]
        words, at = hash_words(part)
        pairs = mix(words[:-1] * _U(3) + words[1:]) if len(words) > 1 else words[:0]
        for k, text in enumerate(part):
            own = words[at[k]:at[k + 1]]
            if not len(own):
                continue
            raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
            by = np.bincount(_CLASS[raw], minlength=_CLASSES)
            solid = max(1, len(raw) - by[1] - by[2])
            two = pairs[at[k]:at[k + 1] - 1]
            lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")]
            again, top = _repeats(own)
            again2, top2 = _repeats(two)
            out[first + k] = [
                np.log1p(len(own)), solid / len(own), *(by[[4, 5, 6, 7, 8, 9, 10, 11]] / solid), again, top, again2, top2,
                (own[1:] == own[:-1]).mean() if len(own) > 1 else 0.0, np.log1p(len(lines)), 1 - len(set(lines)) / len(lines), np.log1p(len(own) / len(lines))]
    return out


def cut_points(values: np.ndarray, cells: int = CELLS) -> list[np.ndarray]:
    return [np.unique(np.quantile(values[:, j], np.linspace(0, 1, cells + 1)[1:-1])) for j in range(values.shape[1])]


def cells_of(values: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Number of the cell of each statistic, counted through all statistics."""
    starts = np.cumsum([0, *[2 * len(c) + 1 for c in cuts[:-1]]])
    low = [np.searchsorted(c, values[:, j], "left") + np.searchsorted(c, values[:, j], "right") for j, c in enumerate(cuts)]
    return np.stack(low, 1) + starts


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _descend(size: int, gradient, passes: int, decay: float = 1e-4, pace: float = 0.05) -> np.ndarray:
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, passes + 1):
        grad = gradient(w) + decay * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - pace * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def _slope(cells: np.ndarray, by_row: np.ndarray, size: int) -> np.ndarray:
    """Gradient of a mean over rows from its derivative by margin."""
    each = np.repeat(by_row / len(by_row), cells.shape[1])
    return np.append(np.bincount(cells.ravel(), each, size), by_row.mean())


def margins(cells: np.ndarray, w: np.ndarray) -> np.ndarray:
    return w[cells].sum(1) + w[-1]


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, size: int, passes: int = PASSES) -> float:
    """Share of positives among unlabelled rows, from rows the separating classifier scores highest."""
    def ratio(p: np.ndarray, u: np.ndarray, seen: np.ndarray, other: np.ndarray) -> float:
        def gradient(w: np.ndarray) -> np.ndarray:
            return _slope(p, -_sigmoid(-margins(p, w)), size) + _slope(u, _sigmoid(margins(u, w)), size)

        w = _descend(size, gradient, passes // 2, decay=1e-2)
        high, low = margins(seen, w), margins(other, w)
        cuts = np.quantile(high, 1 - np.linspace(0.3, 0.95, 14))
        # One standard error above, so that the least of several noisy ratios is not too low.
        inside, of = np.array([(high >= c).mean() for c in cuts]), np.array([(low >= c).mean() for c in cuts])
        noise = np.sqrt((1 - inside) / (inside * len(high)) + (1 - of) / np.maximum(of * len(low), 1))
        return float(np.min(of / inside * (1 + noise)))

    halves = (positive[::2], unlabelled[::2]), (positive[1::2], unlabelled[1::2])
    if min(len(x) for half in halves for x in half) == 0:
        return 0.5
    found = [ratio(*halves[k], *halves[1 - k]) for k in (0, 1)]
    return float(np.clip(np.mean(found), 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, size: int, prior: float, passes: int = PASSES) -> np.ndarray:
    """Weights that minimise the non-negative risk, for the sigmoid loss (bounded, so that far margins count no more)."""
    def gradient(w: np.ndarray) -> np.ndarray:
        p, u = _sigmoid(margins(positive, w)), _sigmoid(margins(unlabelled, w))
        plus = prior * _slope(positive, -p * (1 - p), size)
        rest = u.mean() - prior * p.mean()
        minus = _slope(unlabelled, u * (1 - u), size) - prior * _slope(positive, p * (1 - p), size)
        return plus + minus if rest >= 0 else -minus

    return _descend(size, gradient, passes)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, held_out: Column, rows: int = FIT_ROWS) -> tuple[list[np.ndarray], np.ndarray, float]:
    """Cut points, weights (the offset last) and the estimated prior."""
    sample = fit_sample(docs, labels, held_out, "quality", rows).where("label is null or label = 1")

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = statistics(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("label"), *[pa.array(values[:, j]) for j in range(STATISTICS)]],
                                             names=["label", *[f"s{j}" for j in range(STATISTICS)]])

    kept = sample.select("text", "label").mapInArrow(described, "label int, " + ", ".join(f"s{j} double" for j in range(STATISTICS))).toArrow()
    values = np.stack([np.array(kept.column(f"s{j}"), float) for j in range(STATISTICS)], 1)
    positive = ~np.isnan(np.array(kept.column("label").to_pandas(), float))
    if not positive.any() or positive.all():
        return [np.zeros(0)] * STATISTICS, np.zeros(STATISTICS + 1), 0.5
    cuts = cut_points(values)
    cells, size = cells_of(values, cuts), sum(2 * len(c) + 1 for c in cuts)
    prior = class_prior(cells[positive], cells[~positive], size)
    return cuts, fit(cells[positive], cells[~positive], size, prior), prior


def score(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    held = is_held_out(F.col("doc_id")) if held_out is None else held_out
    cuts, weights, _ = learn(docs, labels, held, rows)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                p = _sigmoid(margins(cells_of(statistics(part.column("text").to_pylist()), cuts), weights))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                                                 names=["doc_id", "held_out", "score", "predicted"])

    told = docs.select("doc_id", held.alias("held_out"), F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return told.mapInArrow(scored, f"doc_id {kind}, held_out boolean, score double, predicted int")
