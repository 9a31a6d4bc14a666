"""Toxicity by weak supervision: many noisy voters, a generative label model, a linear classifier.

Voters. Two are fixed (an insult lexicon, a pattern of direct abuse). Others are lexicons drawn from the labelled
training rows: whole words in two halves, and word beginnings of four to seven bytes, that occur
mostly in rows labelled toxic. One more asks for several different hits. A voter says toxic or not.

Label model. Votes are counted by pattern, at most 2 ** number of voters rows. The model is
``log P(votes, y) = b y + sum a_j v_j + sum w_j v_j y + sum c_jk v_j v_k - log Z``: w_j is the accuracy of a
voter, c_jk the correlation of two voters beside what y explains (with an L1 penalty). It is fitted by its exact
marginal likelihood, without labels, and gives each pattern a posterior.

Classifier. A logistic regression over presence of words and word beginnings (hashed) is fitted on the posteriors;
the features that the posteriors tell apart enter, and always the voters' own terms and the abuse pattern. One that no
row of the sample holds weighs as much as its voter's posterior says. Its scale and offset are set on the labelled training rows.

Learning uses training rows only, a sample of about ``FIT_ROWS`` of them, labelled ones first, chosen by hash of the id; the sample and
its selected features (at most ``FEATURES``) are all that reaches the driver. Every whole text is scored.

Null and empty texts have no features and get the classifier's offset alone. Null ids are never learnt
from. Repeated rows are scored each. Long texts are hashed whole, in slices. An empty table gives an empty result.
Without training rows the score is that of the prior and the fixed voters. Without labelled rows of both kinds only the fixed voters vote.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from inkprint.functions.shipping import ship_with_job
from inkprint.llm.shingles import hash_words, mix, slices
from inkprint.session import materialize

ship_with_job(__name__)

FIT_ROWS = 30_000
FEATURES = 4_096
SUPPORT = 5
#: Least evidence of a feature, in nats: rows times the divergence of its precision from the base rate. By Chernoff's
#: bound exp(-EVIDENCE) is the chance of a feature that tells nothing; it does not grow with the rows.
EVIDENCE = 16.0
ODDS = 30.0
PRECISION = 0.8
PASSES = 600
#: Log odds of a toxic row before anything is learnt.
PRIOR = -3.0

INSULTS = ("arschloch", "asshole", "bastard", "bitch", "cabrón", "clown", "connard", "creep", "degenerate", "disgusting", "dumb",
           "dumbass", "estúpido", "filth", "freak", "gilipollas", "hideous", "hure", "idiot", "idiota", "idiote", "imbecile",
           "imbécil", "imbécile", "jerk", "liar", "loser", "lowlife", "mierda", "moron", "parasite", "pathetic", "pig", "puta",
           "putain", "repulsive", "retard", "salaud", "scum", "scumbag", "shit", "slut", "stupid", "subhuman", "trash",
           "vermin", "whore", "wichser", "worthless")
_ABUSE = re.compile(r"\b(you|they|he|she|u)\b.{0,12}\b(are|is|re|r)\b.{0,20}\b(" + "|".join(INSULTS) + r")\b|\b(kill|hang|shoot) (yourself|urself|them all)\b|\bgo to hell\b", re.I)
#: A text without any of these, folded, cannot match the pattern.
_HINTS = ("urself", "them all", "to hell", *INSULTS)

#: Feature of texts that match the pattern of abuse; above all others, whose lowest bits are less.
ABUSE = np.array([0xFFFFFFFFFFFFFFFF], np.uint64)

_STARTS = (4, 5, 6, 7)
_KINDS = 1 + len(_STARTS)
_U = np.uint64
#: Bytes between words: ASCII other than letters and digits.
_GAPS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def feature_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Sorted distinct features of each text; the three lowest bits tell words from beginnings."""
    for first, last in slices(texts):
        words, at, *starts = hash_words(texts[first:last], _GAPS, _STARTS)
        tagged = [(h & ~_U(7)) | _U(kind) for kind, h in enumerate([words, *starts])]
        for k in range(last - first):
            own = [t[at[k]:at[k + 1]] for t in tagged]
            own = [own[0], *[t[t > 7] for t in own[1:]]]
            yield np.unique(np.concatenate(own))


def abusive(texts: list[str | None]) -> list[bool]:
    """Whether each text matches the pattern of abuse; one pass of an automaton finds the few texts worth a look."""
    hints = ahocorasick.Automaton()
    for word in _HINTS:
        hints.add_word(word.casefold(), True)
    hints.make_automaton()
    fold = lambda t: t.lower() if t.isascii() else t.replace("\u0130", "i").replace("\u0131", "i").casefold()
    return [bool(t and next(hints.iter(fold(t)), None) and _ABUSE.search(t)) for t in texts]


def matches(texts: list[str | None], features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, place in the sorted features) of all features that the texts have, in that order, each pair once."""
    found = [np.zeros(0, np.int64)]
    size, taken = max(1, len(features)), np.zeros(1 << 20, bool)
    taken[(features >> _U(44)).astype(np.int64)] = True
    for first, last in slices(texts):
        words, at, *starts = hash_words(texts[first:last], _GAPS, _STARTS)
        owner = np.repeat(np.arange(first, last), np.diff(at))
        for kind, h in enumerate([words, *starts]):
            live = np.flatnonzero(taken[(h >> _U(44)).astype(np.int64)])
            tagged = (h[live] & ~_U(7)) | _U(kind)
            place = np.searchsorted(features, tagged)
            hit = place < len(features)
            hit[hit] = features[place[hit]] == tagged[hit]
            hit &= (tagged > _U(7)) | (kind == 0)
            found.append(np.unique(owner[live[hit]] * size + place[hit]))
    abuse = np.flatnonzero(features == ABUSE[0])
    if len(abuse):
        found.append(np.flatnonzero(abusive(texts)) * size + abuse[0])
    every = np.unique(np.concatenate(found))
    return every // size, every % size


def word_features(words: tuple[str, ...]) -> np.ndarray:
    return np.unique((hash_words(list(words), _GAPS)[0] & ~_U(7)))


def votes(texts: list[str | None], lexicons: list[np.ndarray]) -> np.ndarray:
    """One row per text: hits in each lexicon, the pattern of abuse, and three or more different hits."""
    out = np.zeros((len(texts), len(lexicons) + 2), np.int8)
    total = np.zeros(len(texts), np.int64)
    for j, lexicon in enumerate(lexicons):
        hits = np.bincount(matches(texts, np.sort(lexicon))[0], minlength=len(texts))
        out[:, j] = hits > 0
        total += hits
    out[:, -2], out[:, -1] = abusive(texts), total >= 3
    return out


class LabelModel:
    """Accuracies and pairwise correlations of binary voters around a hidden label, by exact likelihood."""

    def __init__(self, voters: int) -> None:
        self.voters = voters
        self.pairs = [(j, k) for j in range(voters) for k in range(j + 1, voters)]
        grid = (np.arange(1 << voters)[:, None] >> np.arange(voters)) & 1
        self.free = self._terms(grid, np.zeros(len(grid)))
        self.toxic = self._terms(grid, np.ones(len(grid)))
        self.theta = np.concatenate([[PRIOR], np.full(voters, -3.0), np.full(voters, 4.0), np.zeros(len(self.pairs))])

    def _terms(self, v: np.ndarray, y: np.ndarray) -> np.ndarray:
        both = np.stack([v[:, j] * v[:, k] for j, k in self.pairs], 1) if self.pairs else np.zeros((len(v), 0))
        return np.concatenate([y[:, None], v, v * y[:, None], both], 1).astype(float)

    def posterior(self) -> np.ndarray:
        """P(toxic | votes) by pattern number."""
        a, b = self.free @ self.theta, self.toxic @ self.theta
        return 1 / (1 + np.exp(np.clip(a - b, -60, 60)))

    def fit(self, counts: np.ndarray, passes: int = PASSES, penalty: float = 0.002) -> LabelModel:
        seen = counts / counts.sum()
        m = v = np.zeros_like(self.theta)
        pairs = slice(1 + 2 * self.voters, None)
        for t in range(1, passes + 1):
            a, b = self.free @ self.theta, self.toxic @ self.theta
            top = max(a.max(), b.max())
            ea, eb = np.exp(a - top), np.exp(b - top)
            z = ea.sum() + eb.sum()
            p = self.posterior()
            grad = (seen * p - eb / z) @ self.toxic + (seen * (1 - p) - ea / z) @ self.free
            grad -= 1e-4 * self.theta
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            self.theta = self.theta + 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
            self.theta[pairs] = np.sign(self.theta[pairs]) * np.maximum(np.abs(self.theta[pairs]) - 0.05 * penalty, 0)
            self.theta[1 + self.voters:1 + 2 * self.voters] = np.maximum(self.theta[1 + self.voters:1 + 2 * self.voters], 0.1)
        return self


def _codes(cast: np.ndarray) -> np.ndarray:
    return cast.astype(np.int64) @ (1 << np.arange(cast.shape[1]))


def fit_logistic(starts: np.ndarray, columns: np.ndarray, target: np.ndarray, size: int, passes: int = 400, decay: float = 1e-5) -> np.ndarray:
    """Weights and, last, the offset of a logistic regression on rows of present features, for soft targets."""
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    if not len(target):
        w[-1] = PRIOR
        return w
    rows = np.repeat(np.arange(len(target)), np.diff(starts))
    n = max(1, len(target))
    for t in range(1, passes + 1):
        z = np.bincount(rows, w[columns], len(target)) + w[-1]
        error = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - target
        grad = np.append(np.bincount(columns, error[rows], size) / n, error.mean()) + decay * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def fit_scale(margin: np.ndarray, label: np.ndarray, passes: int = 300) -> tuple[float, float]:
    """Scale and offset that make margins into probabilities of the labels."""
    if len(label) == 0 or label.min() == label.max():
        return 1.0, 0.0
    a, b = 1.0, 0.0
    for _ in range(passes):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -40, 40)))
        q = np.maximum(p * (1 - p), 1e-6)
        g = np.array([((p - label) * margin).sum() + 1e-2 * (a - 1), (p - label).sum() + 1e-2 * b])
        h = np.array([[(q * margin * margin).sum() + 1e-2, (q * margin).sum()], [(q * margin).sum(), q.sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(max(a, 1e-3)), float(b)


def is_held_out(doc_id: Column, parts: int = 5, part: int = 0) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def fit_sample(docs: DataFrame, labels: DataFrame, held_out: Column, label: str, rows: int) -> DataFrame:
    """About ``rows`` training rows, chosen by hash of the id, with their label where there is one.

    Half of them have a label, or as many as there are; the rest is filled from the other kind. So few labels among many
    rows are all in the sample.
    """
    ids = docs.where(F.col("doc_id").isNotNull() & ~held_out).select("doc_id", F.col("text").cast("string").alias("text"))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("label")).where("label is not null")
    n_known = ids.select("doc_id").join(known, "doc_id", "left_semi").count()
    n_other = ids.select("doc_id").count() - n_known
    of_known = min(n_known, max(rows // 2, rows - n_other))
    cell = F.pmod(F.xxhash64(F.lit(91), "doc_id"), F.lit(1 << 20))
    within = lambda part, whole: cell < int(min(1.0, part / max(1, whole)) * (1 << 20))
    told = ids.where(within(of_known, n_known)).join(known.where(within(of_known, n_known)), "doc_id").select("doc_id", "text", "label")
    other = ids.where(within(rows - of_known, n_other)).join(known, "doc_id", "left_anti").select("doc_id", "text", F.lit(None).cast(known.schema["label"].dataType).alias("label"))
    return materialize(told.unionByName(other), "sample")


def _tallied(sample: DataFrame, weight: str) -> DataFrame:
    """Per feature the number of rows and the sum of ``weight`` over them; summed inside each task first."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                sets = list(feature_sets(part.column("text").to_pylist()))
                weights = np.array(part.column("w"), float)
                every = np.concatenate(sets) if sets else np.zeros(0, _U)
                keys, inverse = np.unique(every, return_inverse=True)
                w = np.bincount(inverse, np.repeat(weights, [len(s) for s in sets]), len(keys))
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.bincount(inverse, minlength=len(keys)).astype(float)), pa.array(w)],
                                                 names=["feature", "n", "w"])

    told = sample.select("text", F.expr(weight).cast("double").alias("w"))
    return told.mapInArrow(tally, "feature bigint, n double, w double").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("w").alias("w"))


def _telling(sample: DataFrame, weight: str, rows: float, positive: float, most: int, odds: float) -> np.ndarray:
    """Features that occur mostly where the weight is 1, the most frequent ``most`` of them."""
    inside = (F.col("w") + 0.5) / (positive - F.col("w") + 1.0)
    outside = (F.col("n") - F.col("w") + 0.5) / (rows - positive - F.col("n") + F.col("w") + 1.0)
    other = F.greatest(F.col("n") - F.col("w"), F.lit(0.0))
    part = lambda k, rate: F.when(k > 0, k * F.log(k / (F.col("n") * float(rate)))).otherwise(0.0)
    evidence = part(F.col("w"), positive / rows) + part(other, max(1e-12, 1 - positive / rows))
    sure = (F.col("w") >= SUPPORT) & (F.col("w") >= PRECISION * F.col("n")) & (evidence >= EVIDENCE)
    found = _tallied(sample, weight).where(sure & (inside / outside >= odds))
    picked = found.orderBy(F.desc("w"), "feature").limit(most).select("feature").collect()
    return np.sort(np.array([r.feature for r in picked], np.int64).view(_U))


def learn(docs: DataFrame, labels: DataFrame, held_out: Column, rows: int = FIT_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Features and weights (scaled; the offset last) of the classifier."""
    sample = fit_sample(docs, labels, held_out, "toxic", rows)
    known = sample.where("label is not null")
    n, positive = known.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    found = _telling(known, "label", n, positive, FEATURES, ODDS) if 0 < positive < n else np.zeros(0, _U)
    kind, half = found & _U(7), (mix(found) >> _U(63)).astype(bool)
    lexicons = [word_features(INSULTS), found[(kind == 0) & half], found[(kind == 0) & ~half], *[found[kind == k] for k in range(1, _KINDS)]]
    voters = len(lexicons) + 2

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            codes = _codes(votes(texts, lexicons))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes)], names=[*batch.schema.names, "votes"])

    voted = materialize(sample.mapInArrow(cast, "doc_id bigint, text string, label int, votes bigint"), "votes")
    counts = np.zeros(1 << voters)
    for row in voted.groupBy("votes").count().collect():
        counts[row.votes] = row["count"]
    model = LabelModel(voters)
    if counts.sum():
        model.fit(counts)
    posterior = np.where(counts > 0, model.posterior(), 0.0)
    seen = np.flatnonzero(counts)
    table = sample.sparkSession.createDataFrame([(int(c), float(posterior[c])) for c in seen], "votes bigint, p double")
    soft = materialize(voted.join(F.broadcast(table), "votes"), "posteriors")  # at most 2 ** voters patterns
    total, mass = soft.agg(F.count("*"), F.coalesce(F.sum("p"), F.lit(0.0))).first()
    telling = _telling(soft, "p", total, mass, FEATURES, ODDS) if total and mass > 0 else np.zeros(0, _U)
    features = np.unique(np.concatenate([telling, *lexicons, ABUSE]))

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places = matches(batch.column("text").to_pylist(), features)
            ends = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays([pa.LargeListArray.from_arrays(ends, places).cast(pa.list_(pa.int64())), batch.column("p"), batch.column("label")], names=["hits", "p", "label"])

    fitted = soft.select("text", "p", "label").mapInArrow(present, "hits array<bigint>, p double, label int").toArrow()
    hits = fitted.column("hits").combine_chunks()
    starts = np.append(0, np.cumsum([len(h) for h in hits.to_pylist()])).astype(np.int64)
    columns = np.array(hits.flatten(), np.int64)
    w = fit_logistic(starts, columns, np.array(fitted.column("p"), float), len(features))
    rows_ = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    margin = np.bincount(rows_, w[columns], len(starts) - 1) + w[-1]
    label = np.array(fitted.column("label").to_pandas(), float)
    a, b = fit_scale(margin[~np.isnan(label)], label[~np.isnan(label)])
    w = np.append(a * w[:-1], a * w[-1] + b)
    alone = np.clip(model.posterior(), 1e-6, 1 - 1e-6)
    for own, voter in ((lexicons[0], 0), (ABUSE, voters - 2)):
        unseen = np.isin(features, own) & (np.bincount(columns, minlength=len(features)) == 0)
        w[:-1][unseen] = np.log(alone[1 << voter] / (1 - alone[1 << voter])) - w[-1]
    return features, w


def score(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    held = is_held_out(F.col("doc_id")) if held_out is None else held_out
    features, weights = learn(docs, labels, held, rows)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                rows, places = matches(part.column("text").to_pylist(), features)
                margins = np.bincount(rows, weights[:-1][places], part.num_rows) + weights[-1]
                p = 1 / (1 + np.exp(-np.clip(margins, -40, 40)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                                                 names=["doc_id", "held_out", "score", "predicted"])

    told = docs.select("doc_id", held.alias("held_out"), F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return told.mapInArrow(scored, f"doc_id {kind}, held_out boolean, score double, predicted int")
