"""Spelling variants: words at distance one, found by a bit-sliced index of positions and letters.

``vocabulary`` counts the words of whole texts; ``neighbours`` finds, for every word, how many words differ from it by
one inserted, deleted or replaced code point and which of them is the most frequent; ``group`` follows these forms.

The index of a block of words has one bitset per (position, letter): bit v is set when word v has that letter there.
One pass over a word's letters updates four bitsets, all words of the block at once:

- ``same``: words that agree with every letter so far,
- ``other``: words with one replaced letter so far (same positions),
- ``less``: words that lack one of the letters so far (positions shifted by one to the left),
- ``more``: words with one letter more so far (positions shifted by one to the right).

Words are numbered by falling frequency, then by code points, so the lowest bit is the best form and the number of set
bits is the number of neighbours; no pairs are written.

Blocks come from a key that neighbours must share. With m the length of the shorter word, a single difference leaves
its first half or its second half in place, so a word is posted under both halves for its own length and for the
length below; a pair that both halves show is counted with the first. Keys with more than ``BLOCK`` words are
dealt over several blocks, and their words ask each of these.

Odd rows: a null text has no words; a null id reads as an empty one in the hash. Repeated rows count twice. Texts are
read whole, one at a time; a task holds at most ``HELD`` words before it passes their counts on. Other columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from inkprint.functions.shipping import ship_with_job
from inkprint.session import materialize

ship_with_job(__name__)

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {k: k + 32 for k in range(65, 91)}
#: A run loses a letter when the hash of its document and itself is divisible by this.
DAMAGE = 97
LEAST_LENGTH, LEAST_COUNT, TIMES = 5, 3, 2
HELD = 200_000
BLOCK = 4096


def _counts(batches: Iterator[pa.RecordBatch], damage: int, least: int) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()

    def told() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
        held.clear()
        return out

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
            begun = zlib.crc32(f"{doc_id.as_py() if doc_id.is_valid else ''}:".encode())
            for run, k in Counter(x.translate(LOWER) for x in RUN.findall(text.as_py() or "")).items():
                if len(run) < least:
                    continue
                h = zlib.crc32(run.encode(), begun)
                if h % damage == 0:
                    gone = h % len(run)
                    run = run[:gone] + run[gone + 1:]
                    if len(run) < least:
                        continue
                held[run] += k
            if len(held) > HELD:
                yield told()
    if held:
        yield told()


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, damage: int = DAMAGE) -> DataFrame:
    """word and n of the words of all texts that are long and frequent enough."""
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = texts.mapInArrow(lambda x: _counts(x, damage, least_length), "word string, n bigint")
    return materialize(parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count), "vocabulary")


class Index:
    """Bitsets per (position, letter) over words of lengths m and m + 1, numbered by falling frequency."""

    def __init__(self, words: list[tuple[str, int]], m: int):
        self.m, self.words = m, sorted(words, key=lambda x: (-x[1], x[0]))
        lines: dict[tuple[int, str], bytearray] = {}
        size = len(words) + 7 >> 3
        lengths = [bytearray(size), bytearray(size)]
        for v, (word, _) in enumerate(self.words):
            byte, bit = v >> 3, 1 << (v & 7)
            lengths[len(word) - m][byte] |= bit
            for at in enumerate(word):
                line = lines.get(at)
                if line is None:
                    line = lines[at] = bytearray(size)
                line[byte] |= bit
        self.lines = {at: int.from_bytes(line, "little") for at, line in lines.items()}
        self.short, self.long = (int.from_bytes(x, "little") for x in lengths)

    def near(self, word: str, second_half: bool) -> int:
        """Bits of the words at distance one; with ``second_half``, without those that share the first half."""
        get, half, first = self.lines.get, self.m // 2, 0
        same, other, less, more = self.short | self.long, 0, 0, 0
        for i, letter in enumerate(word):
            if i == half:
                first = same
            here = get((i, letter), 0)
            other = other & here | same & ~here
            less = less & (get((i - 1, letter), 0) if i else 0) | same
            more = (more | same) & get((i + 1, letter), 0)
            same &= here
        found = less & self.short if len(word) > self.m else other & self.short | (more | same) & self.long
        return found & ~first if second_half else found


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by key and block, those to index (roles 0 and 1) before those that only ask (role 2)."""
    key, words, index = None, [], None
    out: list[tuple] = []

    def ask(word: str) -> None:
        bits = index.near(word, key[0][0] == "b")
        if bits:
            best = index.words[(bits & -bits).bit_length() - 1]
            out.append((word, bits.bit_count(), best[1], best[0]))

    def close() -> None:
        nonlocal index
        if key is not None and index is None and len(words) > 1:
            index = Index(words, int(key[0][1:].split(":", 1)[0]))
            for word, _ in words:
                ask(word)

    def told() -> pa.RecordBatch:
        columns = list(zip(*out)) or [(), (), (), ()]
        kinds = pa.string(), pa.int64(), pa.int64(), pa.string()
        found = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "n_near", "best_n", "best"])
        out.clear()
        return found

    for batch in batches:
        for at, block, role, word, n in zip(*(batch.column(c).to_pylist() for c in ("key", "block", "role", "word", "n"))):
            if key != (at, block):
                close()
                key, words, index = (at, block), [], None
            if role < 2:
                words.append((word, n))
                continue
            if index is None:
                index = Index(words, int(at[1:].split(":", 1)[0]))
            ask(word)
        yield told()
    close()
    yield told()


def _posted(words: DataFrame, least_length: int) -> DataFrame:
    """word and n under the halves of its own length and of the length below."""
    size = F.length("word")
    def under(m):
        half = F.floor(m / 2).cast("int")
        return F.array(F.concat(F.lit("a"), m.cast("string"), F.lit(":"), F.substring("word", F.lit(1), half)),
                       F.concat(F.lit("b"), m.cast("string"), F.lit(":"), F.substring("word", size - (m - half) + 1, m - half)))
    keys = F.when(size > least_length, F.concat(under(size), under(size - 1))).otherwise(under(size))
    return words.select("word", "n", F.explode(keys).alias("key"))


def neighbours(words: DataFrame, least_length: int = LEAST_LENGTH, block: int = BLOCK) -> DataFrame:
    """word, n_near, best_n and best of the words that have neighbours; ``words`` has distinct words and their n."""
    posted = _posted(words, least_length)
    sizes = posted.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    posted = posted.join(sizes, "key")
    single = F.col("blocks") == 1
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    stored = posted.select("key", own.alias("block"), F.when(single, 0).otherwise(1).alias("role"), "word", "n")
    asking = posted.where(~single).select("key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(2).alias("role"), "word", "n")
    dealt = stored.union(asking).repartition("key", "block").sortWithinPartitions("key", "block", "role")
    found = dealt.mapInArrow(_search, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("k"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.k")).alias("best_n"), F.col("b.word").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """word and the last form reached, doubling the step each time; forms (word, form) hold no circle."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = materialize(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if stepped.where("moved").isEmpty():
            return stepped.select("word", "root")
        now = stepped.select("word", "root")


def group(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, damage: int = DAMAGE) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary."""
    words = vocabulary(docs, least_length, least_count, damage)
    near = words.join(neighbours(words, least_length), "word", "left")
    has = F.col("best_n") >= TIMES * F.col("n")
    told = materialize(near.select("word", F.when(has, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                   F.when(has, F.col("best_n")).alias("form_n")), "forms")
    roots = _roots(told.where("form is not null"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
