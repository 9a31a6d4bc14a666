"""Language-model scores: the probability of a text summed over all segmentations into subword pieces.

The pieces are those of an existing vocabulary, which is never changed. A text is a sequence of words and one
end; a word is any sequence of pieces that spells it, so its probability is the sum over its lattice, by forward
recursion in log space. A text's score is the sum over its words, so each distinct word of the corpus is
scored once.

Training counts every word of the training texts. The scores that come with the vocabulary (ranks, read as a
Zipf law) weight all segmentations of those words; the expected uses of each piece give its probability, ``ROUNDS``
times over, with ``SMOOTHING`` uses added to every piece and byte. Only sums per piece reach the driver.

Scoring reads each text once. The most frequent words, at most ``FREQUENT`` in number, go to every task and are summed
where the text is; the rest leave it, once per text, and are joined with the scored words. Each of them holds at most
1/``FREQUENT`` of all words, so that join has no hot key.

An empty table gives an empty result. Long texts are read whole, one at a time; a word of any length is one lattice.
Null text counts as empty: its score is that of the end alone. A null id is not held out. Repeated rows are
each scored. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from inkprint.functions.shipping import ship_with_job
from inkprint.llm.lattice import START, Pieces, expected_counts, log_marginals
from inkprint.llm.words import text_of
from inkprint.session import materialize

ship_with_job(__name__)

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
ROUNDS = 2
SMOOTHING = 0.1
FREQUENT = 1 << 17
_BATCH = 20_000
_TEXTS = 500
#: Distinct words a task counts before it passes them on.
HELD = 200_000


def read_vocabulary(path: str) -> tuple[list[str], np.ndarray]:
    """Pieces that can spell lower-cased words, and their ranks in the vocabulary. Read on the driver only."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts, ranks = [], []
    for i in range(model.get_piece_size()):
        text = model.id_to_piece(i)
        special = model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
        if not special and START not in text[1:] and not any("A" <= c <= "Z" for c in text):
            texts.append(text)
            ranks.append(-model.get_score(i))
    return texts, np.array(ranks)


class Model:
    """Natural log probabilities of pieces, bytes and the end; they sum to one."""

    def __init__(self, pieces: np.ndarray, spelled: np.ndarray, end: float) -> None:
        total = pieces.sum() + spelled.sum() + end
        self.pieces, self.spelled, self.end = np.log(pieces / total), np.log(spelled / total), log(end / total)


def is_held_out(doc_id: Column, parts: int = 5, part: int = 1) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def split_words(text: pa.Scalar) -> list[bytes]:
    """Words of a text, A-Z lower-cased; bytes know no other case and no other space."""
    return (text.as_py() or b"").lower().split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    every: Counter[bytes] = Counter()
    learnt: Counter[bytes] = Counter()

    def told() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(every.keys(), pa.binary()).cast(pa.string()), pa.array(every.values(), pa.int64()),
                                          pa.array([learnt[w] for w in every], pa.int64())], names=["word", "n", "c"])
        every.clear()
        learnt.clear()
        return out

    for batch in batches:
        for text, training in zip(batch.column("text").cast(pa.binary()), batch.column("t").to_pylist()):
            words = split_words(text)
            every.update(words)
            if training:
                learnt.update(words)
            if len(every) > HELD:
                yield told()
    if every:
        yield told()


def count_words(docs: DataFrame) -> DataFrame:
    """word, n (uses in all texts) and c (uses in training texts)."""
    told = docs.select(F.col("text").cast("string").alias("text"), (~is_held_out(F.col("doc_id"))).alias("t"))
    return told.mapInArrow(_count, "word string, n bigint, c bigint").groupBy("word").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))


def _expected(counted: DataFrame, texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Expected uses of pieces and bytes in the training words; at most one row per piece reaches the driver."""
    n = len(texts)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, spelled, pieces = np.zeros(n), np.zeros(256), Pieces(texts)
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                part = batch.slice(at, _BATCH)
                more, bytes_ = expected_counts(part.column("word").to_pylist(), np.array(part.column("c"), float), pieces, model.pieces, model.spelled)
                used, spelled = used + more, spelled + bytes_
        every = np.concatenate([used, spelled])
        hit = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(every[hit])], names=["piece", "uses"])

    found = counted.where("c > 0").select("word", "c").mapInArrow(sums, "piece bigint, uses double").groupBy("piece").agg(F.sum("uses").alias("uses"))
    every = np.zeros(n + 256)
    for row in found.toLocalIterator():
        every[row.piece] = row.uses
    return every[:n], every[n:]


def train(counted: DataFrame, n_train: int, vocabulary: str = VOCABULARY, rounds: int = ROUNDS) -> tuple[list[str], Model]:
    texts, ranks = read_vocabulary(vocabulary)
    model = Model(1.0 / (ranks - ranks.min() + 50.0), np.full(256, 1e-6), 1e-3)
    for _ in range(rounds):
        used, spelled = _expected(counted, texts, model)
        model = Model(used + SMOOTHING, spelled + SMOOTHING, n_train + SMOOTHING)
    return texts, model


def score_words(counted: DataFrame, texts: list[str], model: Model) -> DataFrame:
    """word, n, c and lp, the natural log probability of each distinct word."""
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(texts)
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                part = batch.slice(at, _BATCH)
                lp = log_marginals(part.column("word").to_pylist(), pieces, model.pieces, model.spelled)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lp)], names=["word", "n", "c", "lp"])

    return counted.select("word", "n", "c").mapInArrow(scored, "word string, n bigint, c bigint, lp double")


def least_frequent(scored: DataFrame, most: int = FREQUENT) -> int:
    """Least count such that at most ``most`` words have it; from a histogram of counts, in steps of a sixteenth."""
    shift = F.greatest(F.length(F.bin("n")) - 5, F.lit(0))
    low = (F.floor(F.col("n") / F.pow(F.lit(2), shift)) * F.pow(F.lit(2), shift)).cast("bigint")
    held, least = 0, None
    for row in scored.groupBy(low.alias("low")).agg(F.count("*").alias("k")).orderBy(F.desc("low")).collect():
        held += row.k
        if held > most:
            break
        least = row.low
    return least if least is not None else 1 << 62


def _summed(batches: Iterator[pa.RecordBatch], frequent: pa.Table) -> Iterator[pa.RecordBatch]:
    """Per text the sums over its frequent words, its number of words, and its other words with how often they occur."""
    places = {w: k for k, w in enumerate(frequent.column("word").cast(pa.binary()).to_pylist())}
    values = np.stack([np.array(frequent.column(c), float) for c in ("b", "k", "lp")], 1).reshape(-1, 3)
    kind = pa.list_(pa.struct([("word", pa.string()), ("times", pa.int64())]))
    for whole in batches:
        for at in range(0, whole.num_rows, _TEXTS):
            batch = whole.slice(at, _TEXTS)
            sums, sizes, rare = np.zeros((batch.num_rows, 3)), [], []
            for row, text in enumerate(batch.column("text").cast(pa.binary())):
                words = split_words(text)
                held = Counter(words)
                found = np.fromiter(map(places.get, held, repeat(-1)), np.int64, len(held))
                times, known = np.fromiter(held.values(), np.int64, len(held)), found >= 0
                sums[row] = times[known] @ values[found[known]]
                sizes.append(len(words))
                rare.append([{"word": w.decode(), "times": k} for (w, k), f in zip(held.items(), known.tolist()) if not f])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("x"), pa.array(sums[:, 0]), pa.array(np.rint(sums[:, 1]).astype(np.int64)),
                                              pa.array(sums[:, 2]), pa.array(sizes, pa.int64()), pa.array(rare, kind)], names=["doc_id", "x", "b", "k", "lp", "n", "rare"])


def score(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per row of ``docs``: id, held_out, token counts, the word model's base_score and the lattice's score."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    counted = materialize(count_words(rows), "words")
    n_train = rows.where(~is_held_out(F.col("doc_id"))).count()
    tally = counted.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    tokens, distinct = tally.n + n_train, tally.v + int(n_train > 0)
    texts, model = train(counted, n_train, vocabulary)
    scored = materialize(score_words(counted, texts, model), "scored")
    least = least_frequent(scored)
    value = scored.select("word", "n", F.log10(F.col("c") + 0.5).alias("b"), (F.col("c") > 0).cast("bigint").alias("k"), "lp")
    frequent = value.where(F.col("n") >= least).select("word", "b", "k", "lp").toArrow()  # at most FREQUENT rows
    kind = rows.schema["doc_id"].dataType.simpleString()
    told = rows.select("doc_id", F.xxhash64(text_of("text")).alias("x"), "text").mapInArrow(
        lambda x: _summed(x, frequent), f"doc_id {kind}, x bigint, b double, k bigint, lp double, n bigint, rare array<struct<word:string,times:bigint>>")
    told = materialize(told, "summed")

    # A row without its rare words, and these; rows tells how many rows share an id and text.
    zero = F.lit(0).cast("bigint")
    often = told.select("doc_id", "x", "b", "k", "lp", F.lit(1).cast("bigint").alias("rows"), "n")
    times = F.col("times")
    seldom = told.select("doc_id", "x", F.inline("rare")).join(value.where(F.col("n") < least).drop("n"), "word").select(
        "doc_id", "x", (times * F.col("b")).alias("b"), (times * F.col("k")).alias("k"), (times * F.col("lp")).alias("lp"), zero.alias("rows"), zero.alias("n"))
    parts = often.union(seldom).groupBy("doc_id", "x").agg(*[F.sum(c).alias(c) for c in ("b", "k", "lp", "rows", "n")])
    per = lambda c: F.col(c) / F.col("rows")
    n_tokens = (F.expr("n div rows") + 1).alias("n_tokens")
    end = float(np.log10(n_train + 0.5))
    base = per("b") + end - (F.expr("n div rows") + 1) * float(np.log10(tokens + 0.5 * (distinct + 1)))
    out = parts.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), n_tokens.cast("bigint"),
                       (F.expr("k div rows") + int(n_train > 0)).cast("bigint").alias("n_known"), F.lit(tokens).cast("bigint").alias("train_tokens"),
                       base.alias("base_score"), ((per("lp") + model.end) / log(10)).alias("score"), F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("_r"))
    return out.drop("_r")
