"""Character n-gram counting over Arrow batches.

Spark hands each task batches of rows; the helpers here count n-grams of one
batch with NumPy and hand back Arrow columns. Counting inside the task works
as the map-side combine, so only distinct terms leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from inkprint.functions.shipping import ship_with_job

ship_with_job(__name__)

# Characters and tokens worked on at once; a longer text is still taken whole, alone.
SLICE_CHARS = 1 << 20
SLICE_TOKENS = 1 << 18
HELD_GRAMS = 1 << 21      # counts that a task adds up before it merges them
TRIE_CELLS = 1 << 24      # links of a vocabulary that a task holds


def _row_slices(lengths: list[int], most: int = SLICE_CHARS) -> Iterator[slice]:
    begin, used = 0, 0
    for i, length in enumerate(lengths):
        if used and used + length > most:
            yield slice(begin, i)
            begin, used = i, 0
        used += length
    if begin < len(lengths):
        yield slice(begin, len(lengths))


def _boundaries(ordered: np.ndarray) -> np.ndarray:
    """Offsets at which a new value begins in a sorted array."""
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(new)


class PairCounts:
    """Distinct (row, term) pairs of one text slice for one n-gram size."""

    def __init__(self, rows, counts, term_of_pair, terms):
        self.rows = rows                  # row position in the slice, per pair
        self.counts = counts              # occurrences, per pair
        self.term_of_pair = term_of_pair  # index into terms, per pair
        self.terms = terms                # distinct terms as an Arrow string array


def _spell(grams: np.ndarray, alphabet: np.ndarray, ranked: list) -> pa.Array:
    """n-gram integers back to strings, last letter first."""
    letters = []
    for known in reversed(ranked):
        grams, last = np.divmod(grams, len(alphabet))
        letters.append(last)
        if known is not None:
            grams = known[grams]
    size = len(ranked) + 1
    joined = alphabet[np.stack([grams, *reversed(letters)], axis=1)].tobytes().decode("utf-32-le")
    return pa.array([joined[i:i + size] for i in range(0, len(joined), size)], pa.string())


def count_pairs(texts: list[str], sizes: tuple[int, ...]) -> Iterator[PairCounts]:
    """Counts of each size over the texts; n-grams never cross from one text to the next."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    alphabet, letters = np.unique(points, return_inverse=True)
    base = len(alphabet)
    for size in sizes:
        starts = np.flatnonzero(owner[: max(0, len(points) - size + 1)] == owner[size - 1:])
        if not len(starts):
            continue
        # Each n-gram becomes one integer; ranks replace it before it could overflow.
        gram, limit, ranked = letters[starts], base, []
        for offset in range(1, size):
            known = None
            if limit * base * len(texts) >= 2 ** 62:
                known, gram = np.unique(gram, return_inverse=True)
                limit = len(known)
            ranked.append(known)
            gram = gram * base + letters[starts + offset]
            limit *= base

        key = np.sort(owner[starts] * limit + gram)
        first = _boundaries(key)
        counts = np.diff(np.append(first, len(key)))
        rows, gram = np.divmod(key[first], limit)
        distinct, term_of_pair = np.unique(gram, return_inverse=True)
        yield PairCounts(rows, counts, term_of_pair, _spell(distinct, alphabet, ranked))


class _Alphabet:
    """Letters of a task in the order in which they came; a gram is an integer with ``bits`` for each letter."""

    def __init__(self, sizes: tuple[int, ...]):
        self.bits = 62 // max(sizes)
        self.code, self.points = np.full(0x110000, -1, dtype=np.int32), np.zeros(0, dtype=np.uint32)

    def letters(self, points: np.ndarray) -> np.ndarray | None:
        """Codes of the points, or nothing where they are too many."""
        seen = np.zeros(len(self.code), dtype=bool)
        seen[points] = True
        new = np.flatnonzero(seen & (self.code < 0)).astype(np.uint32)
        if len(self.points) + len(new) > 1 << self.bits:
            return None
        self.code[new] = np.arange(len(self.points), len(self.points) + len(new))
        self.points = np.concatenate([self.points, new])
        return self.code.take(points).astype(np.int64)

    def spell(self, grams: np.ndarray, size: int) -> pa.Array:
        """Grams back to strings."""
        shifts = np.arange(size - 1, -1, -1) * self.bits
        joined = self.points[(grams[:, None] >> shifts) & ((1 << self.bits) - 1)].tobytes().decode("utf-32-le")
        return pa.array([joined[i:i + size] for i in range(0, len(joined), size)], pa.string())


def _added(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """(gram, cf, df) parts with their counts added up."""
    gram, cf, df = map(np.concatenate, zip(*parts))
    order = np.argsort(gram, kind="stable")  # parts are sorted, so this merges runs
    gram = gram[order]
    first = _boundaries(gram)
    return gram[first], np.add.reduceat(cf[order], first), np.add.reduceat(df[order], first)


def _gram_counts(letters: np.ndarray, owner: np.ndarray, n_rows: int, size: int, base: int, bits: int):
    """Sorted grams of one size with their (cf, df); nothing where the texts have none."""
    starts = np.flatnonzero(owner[: max(0, len(letters) - size + 1)] == owner[size - 1:])
    if not len(starts):
        return None
    gram = letters[starts]
    for offset in range(1, size):
        gram = gram * base + letters[starts + offset]
    shift = n_rows.bit_length()
    key = np.sort((gram << shift) | owner[starts])  # rows of a gram lie together
    pairs = _boundaries(key)
    gram = key[pairs] >> shift
    first = _boundaries(gram)
    cf, df = np.diff(np.append(pairs[first], len(key))), np.diff(np.append(first, len(pairs)))
    rest, code = gram[first], np.zeros(len(first), dtype=np.int64)
    for place in range(size):
        rest, letter = np.divmod(rest, base)
        code |= letter << (bits * place)
    return code, cf, df


def corpus_counts(sizes: tuple[int, ...]):
    """Batches of (text) -> partial (term, cf, df), added up over the task as far as ``HELD_GRAMS`` different ones go."""

    def run(batches):
        alphabet, held, size_held = _Alphabet(sizes), {size: [] for size in sizes}, 0

        def told():
            for size, parts in held.items():
                if parts:
                    gram, cf, df = _added(parts)
                    for at in range(0, len(gram), SLICE_TOKENS):
                        here = slice(at, at + SLICE_TOKENS)
                        yield pa.RecordBatch.from_arrays(
                            [alphabet.spell(gram[here], size), pa.array(cf[here].astype(np.int64)), pa.array(df[here].astype(np.int64))],
                            names=["term", "cf", "df"])

        for batch in batches:
            texts = batch.column(0).to_pylist()
            for part in _row_slices([len(t) for t in texts]):
                some = texts[part]
                points = np.frombuffer("".join(some).encode("utf-32-le"), dtype=np.uint32)
                letters = alphabet.letters(points)
                if letters is None:
                    yield from told()
                    alphabet, held, size_held = _Alphabet(sizes), {size: [] for size in sizes}, 0
                    letters = alphabet.letters(points)
                base = max(2, len(alphabet.points))
                if letters is None or base ** max(sizes) >= 1 << (62 - len(some).bit_length()):
                    for pairs in count_pairs(some, sizes):  # a script of thousands of letters
                        n = len(pairs.terms)
                        cf = np.bincount(pairs.term_of_pair, weights=pairs.counts, minlength=n)
                        df = np.bincount(pairs.term_of_pair, minlength=n)
                        yield pa.RecordBatch.from_arrays(
                            [pairs.terms, pa.array(cf.astype(np.int64)), pa.array(df.astype(np.int64))], names=["term", "cf", "df"])
                    continue
                owner = np.repeat(np.arange(len(some)), [len(t) for t in some])
                for size in sizes:
                    found = _gram_counts(letters, owner, len(some), size, base, alphabet.bits)
                    if found is not None:
                        held[size].append(found)
                        size_held += len(found[0])
                if size_held >= HELD_GRAMS:
                    held = {size: [_added(parts)] if parts else [] for size, parts in held.items()}
                    size_held = sum(len(part[0]) for parts in held.values() for part in parts)
                    if size_held >= HELD_GRAMS // 2:  # little in common: Spark adds up the rest
                        yield from told()
                        held, size_held = {size: [] for size in sizes}, 0
        yield from told()

    return run


def row_counts(sizes: tuple[int, ...]):
    """Batches of (row_id, text) -> (row_id, term, tf)."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in _row_slices([len(t) for t in texts]):
                ids = batch.column(0).slice(part.start, part.stop - part.start)
                for pairs in count_pairs(texts[part], sizes):
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(pairs.rows)), pairs.terms.take(pa.array(pairs.term_of_pair)),
                         pa.array(pairs.counts.astype(np.int64))],
                        names=["row_id", "term", "tf"],
                    )

    return run


def row_lists(sizes: tuple[int, ...]):
    """Batches of (row_id, text) -> (row_id, terms, tfs), one row per text and n-gram size that it has."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in _row_slices([len(t) for t in texts]):
                ids = batch.column(0).slice(part.start, part.stop - part.start)
                for pairs in count_pairs(texts[part], sizes):
                    first = _boundaries(pairs.rows)
                    offsets = pa.array(np.append(first, len(pairs.rows)).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(pairs.rows[first])),
                         pa.ListArray.from_arrays(offsets, pairs.terms.take(pa.array(pairs.term_of_pair))),
                         pa.ListArray.from_arrays(offsets, pa.array(pairs.counts.astype(np.int64)))],
                        names=["row_id", "terms", "tfs"],
                    )

    return run


def spell_out(vocabulary, carried: list[str]):
    """Batches of (...carried, indices, values) -> (...carried, weight, term), one row per entry."""

    def run(batches):
        terms = pa.array(vocabulary.value, pa.string())
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column("indices")), 0).to_pylist()
            for part in _row_slices(lengths, SLICE_TOKENS):
                some = batch.slice(part.start, part.stop - part.start)
                at = pc.list_parent_indices(some.column("indices"))
                yield pa.RecordBatch.from_arrays(
                    [some.column(c).take(at) for c in carried]
                    + [pc.list_flatten(some.column("values")), terms.take(pc.list_flatten(some.column("indices")))],
                    names=[*carried, "weight", "term"],
                )

    return run


def _unit_values(rows: np.ndarray, idx: np.ndarray, counts: np.ndarray, n_rows: int,
                 idf: np.ndarray, sublinear_tf: bool) -> np.ndarray:
    """tf times idf with unit length per row."""
    raw = (1 + np.log(counts) if sublinear_tf else counts) * idf[idx]
    return raw / np.sqrt(np.bincount(rows, weights=raw * raw, minlength=n_rows))[rows]


def _offsets(rows: np.ndarray, n_rows: int) -> pa.Array:
    offsets = np.zeros(n_rows + 1, dtype=np.int32)
    np.cumsum(np.bincount(rows, minlength=n_rows), out=offsets[1:])
    return pa.array(offsets)


def _unit_lists(rows: np.ndarray, idx: np.ndarray, counts: np.ndarray, n_rows: int,
                idf: np.ndarray, sublinear_tf: bool, ordered: bool = False) -> list[pa.Array]:
    """(row, term index, count) triples to one indices and one values list per row.

    A row without known terms keeps empty lists.
    """
    if not ordered:
        order = np.lexsort((idx, rows))
        rows, idx, counts = rows[order], idx[order], counts[order]
    values, offsets = _unit_values(rows, idx, counts, n_rows, idf, sublinear_tf), _offsets(rows, n_rows)
    return [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (idx.astype(np.int32), values)]


class _Trie:
    """Finds the vocabulary's terms at all places of a text at once: one table of links per letter."""

    def __init__(self, terms: list[str], sizes: tuple[int, ...]):
        lengths = np.array([len(t) for t in terms], dtype=np.int64)
        points = np.frombuffer("".join(terms).encode("utf-32-le"), dtype=np.uint32)
        alphabet = np.unique(points)
        self.base, self.n_terms, self.sizes = len(alphabet) + 1, len(terms), sizes
        self.code = np.zeros(0x110000, dtype=np.int32)  # 0: no letter of the vocabulary
        self.code[alphabet] = np.arange(1, self.base)
        letters, first = self.code.take(points).astype(np.int64), np.cumsum(lengths) - lengths
        self.links, self.ends, self.small = [], [], True
        mine, node, n_nodes = np.flatnonzero(lengths), letters[first[lengths > 0]] if len(terms) else np.zeros(0, np.int64), self.base
        for size in range(1, max(sizes) + 1):
            if size > 1:
                longer = lengths[mine] >= size
                mine, node = mine[longer], node[longer]
                step = node * self.base + letters[first[mine] + size - 1]
                known, node = np.unique(step, return_inverse=True)
                if n_nodes * self.base > TRIE_CELLS:
                    self.small = False
                    return
                self.links.append(np.zeros(n_nodes * self.base, dtype=np.int32))
                self.links[-1][known] = np.arange(1, len(known) + 1)
                node, n_nodes = node + 1, len(known) + 1
            end = np.full(n_nodes, -1, dtype=np.int32)
            whole = lengths[mine] == size
            end[node[whole]] = mine[whole]
            self.ends.append(end)

    def find(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term index, count), sorted, of the texts' known terms."""
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        owner = np.repeat(np.arange(len(texts)), lengths + 1)
        letters = np.zeros(len(owner), dtype=np.int32)  # a text ends with no letter, so no term goes on
        last = np.cumsum(lengths + 1) - 1
        inside = np.ones(len(owner), dtype=bool)
        inside[last] = False
        letters[inside] = self.code.take(np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32))
        at = np.flatnonzero(letters)
        node = letters[at]
        kind = np.int32 if len(texts) * self.n_terms < 1 << 31 else np.int64
        keys = [np.zeros(0, dtype=kind)]
        for size in range(1, max(self.sizes) + 1):
            if size > 1:
                node = self.links[size - 2].take(node.astype(np.int64) * self.base + letters.take(at + (size - 1)))
                alive = np.flatnonzero(node)
                at, node = at.take(alive), node.take(alive)
            if size in self.sizes:
                idx = self.ends[size - 1].take(node)
                whole = np.flatnonzero(idx >= 0)
                keys.append(owner.take(at.take(whole)).astype(kind) * kind(self.n_terms) + idx.take(whole))
        key = np.sort(np.concatenate(keys))
        first = _boundaries(key)
        rows, idx = np.divmod(key[first], kind(max(1, self.n_terms)))
        return rows.astype(np.int64), idx.astype(np.int64), np.diff(np.append(first, len(key)))


def _known_chars(terms: list[str], sizes: tuple[int, ...]):
    """texts -> sorted (row, term index, count) of their known n-grams."""
    trie = _Trie(terms, sizes)
    if trie.small:
        return trie.find
    known = pa.array(terms, pa.string())

    def find(texts: list[str]):
        found = [(np.zeros(0, np.int64),) * 3]
        for pairs in count_pairs(texts, sizes):
            idx = pc.fill_null(pc.index_in(pairs.terms, value_set=known), -1).to_numpy()
            idx = idx[pairs.term_of_pair]
            keep = idx >= 0
            found.append((pairs.rows[keep], idx[keep].astype(np.int64), pairs.counts[keep]))
        rows, idx, counts = [np.concatenate(x) for x in zip(*found)]
        order = np.lexsort((idx, rows))
        return rows[order], idx[order], counts[order]

    return find


def _char_slices(batches, find):
    """Batches of (text, ...carried) -> carried columns, number of rows and their known n-grams, a slice at a time."""
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for part in _row_slices([len(t) for t in texts]):
            n_rows = part.stop - part.start
            yield [c.slice(part.start, n_rows) for c in batch.columns[1:]], batch.schema.names[1:], n_rows, find(texts[part])


def weigh_chars(weighting, sizes: tuple[int, ...]):
    """Batches of (text, ...carried) -> (...carried, indices, values).

    ``weighting`` is a broadcast (sorted terms, idf, sublinear tf); unknown terms
    are dropped.
    """

    def run(batches):
        terms, idf, sublinear_tf = weighting.value
        for carried, names, n_rows, found in _char_slices(batches, _known_chars(terms, sizes)):
            lists = _unit_lists(*found, n_rows, idf, sublinear_tf, ordered=True)
            yield pa.RecordBatch.from_arrays(carried + lists, names=names + ["indices", "values"])

    return run


def weigh_chars_long(weighting, sizes: tuple[int, ...], digits: int | None):
    """As :func:`weigh_chars`, but (...carried, weight, term) with a row per entry; weights are rounded to ``digits``."""

    def run(batches):
        terms, idf, sublinear_tf = weighting.value
        words = pa.array(terms, pa.string())
        for carried, names, n_rows, (rows, idx, counts) in _char_slices(batches, _known_chars(terms, sizes)):
            values = _unit_values(rows, idx, counts, n_rows, idf, sublinear_tf)
            if digits is not None:
                values = np.floor(values * 10.0 ** digits + 0.5) / 10.0 ** digits
            for at in range(0, len(rows), SLICE_TOKENS):
                here = slice(at, at + SLICE_TOKENS)
                owner = pa.array(rows[here])
                yield pa.RecordBatch.from_arrays([c.take(owner) for c in carried] + [pa.array(values[here]), words.take(pa.array(idx[here]))],
                                                 names=names + ["weight", "term"])

    return run


PACKED = ["gaps", "tfs", "far", "many"]  # columns of a text's known terms: see pack_chars
ESCAPE = 255


def _binary(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Binary array of consecutive parts of ``data``."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths * data.itemsize, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _parts(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Consecutive values of a binary array, and how many each row has."""
    _, offsets, data = column.cast(pa.binary()).buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[column.offset:column.offset + len(column) + 1]
    values = np.zeros(0, dtype=kind) if data is None else np.frombuffer(data, dtype=np.uint8)[ends[0]:ends[-1]].view(kind)
    return values, np.diff(ends) // np.dtype(kind).itemsize


def pack_chars(vocabulary, sizes: tuple[int, ...]):
    """Batches of (text, ...carried) -> (...carried, gaps, tfs, far, many): known terms as bytes.

    A byte tells how far a term's index is from the one before, another how often the term occurs; 255 stands for the
    next number of ``far`` and ``many``.
    """

    def run(batches):
        for carried, names, n_rows, (rows, idx, counts) in _char_slices(batches, _known_chars(vocabulary.value, sizes)):
            gaps = np.diff(idx, prepend=-1)
            first = np.flatnonzero(np.diff(rows, prepend=-1))
            gaps[first] = idx[first] + 1
            lengths, columns, escaped = np.bincount(rows, minlength=n_rows), [], []
            for x in (gaps, counts):
                big = np.flatnonzero(x >= ESCAPE)
                columns.append(_binary(np.minimum(x, ESCAPE).astype(np.uint8), lengths))
                escaped.append(_binary(x[big].astype(np.int32), np.bincount(rows[big], minlength=n_rows)))
            yield pa.RecordBatch.from_arrays(carried + columns + escaped, names=names + PACKED)

    return run


def _unpacked(batches, most: int):
    """Batches of (...carried, gaps, tfs, far, many) -> some rows, their numbers of entries, term indices and counts."""
    for batch in batches:
        entries = pc.binary_length(batch.column("gaps")).to_pylist()
        for part in _row_slices(entries, most):
            some = batch.slice(part.start, part.stop - part.start)
            numbers = []
            for small, big in (("gaps", "far"), ("tfs", "many")):
                short, lengths = _parts(some.column(small), np.uint8)
                whole = short.astype(np.int64)
                whole[short == ESCAPE] = _parts(some.column(big), np.int32)[0]
                numbers.append(whole)
            upto = np.concatenate([[0], np.cumsum(numbers[0])])
            before = upto[np.cumsum(lengths) - lengths]
            yield some, lengths, upto[1:] - np.repeat(before, lengths) - 1, numbers[1]


def unpack(weighting, carried: list[str]):
    """Batches of :func:`pack_chars` -> (...carried, indices, values) with the values of :func:`weigh_chars`."""

    def run(batches):
        idf, sublinear_tf = weighting.value
        for some, lengths, idx, counts in _unpacked(batches, SLICE_TOKENS):
            rows = np.repeat(np.arange(len(lengths)), lengths)
            lists = _unit_lists(rows, idx, counts, len(lengths), idf, sublinear_tf, ordered=True)
            yield pa.RecordBatch.from_arrays([some.column(c) for c in carried] + lists, names=[*carried, "indices", "values"])

    return run


def weigh_tokens(weighting):
    """As :func:`weigh_chars` for batches whose first column is a token list."""

    def run(batches):
        terms, idf, sublinear_tf = weighting.value
        known = pa.array(terms, pa.string())
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column(0)), 0).to_pylist()
            for part in _row_slices(lengths, SLICE_TOKENS):
                some = batch.slice(part.start, part.stop - part.start)
                tokens = some.column(0)
                rows = pc.list_parent_indices(tokens).to_numpy()
                idx = pc.fill_null(pc.index_in(pc.list_flatten(tokens), value_set=known), -1).to_numpy()
                keep = idx >= 0
                rows, idx = rows[keep], idx[keep].astype(np.int64)
                key = np.sort(rows * len(known) + idx)
                first = _boundaries(key)
                counts = np.diff(np.append(first, len(key)))
                rows, idx = np.divmod(key[first], len(known))
                lists = _unit_lists(rows, idx, counts, some.num_rows, idf, sublinear_tf, ordered=True)
                yield pa.RecordBatch.from_arrays(
                    some.columns[1:] + lists, names=some.schema.names[1:] + ["indices", "values"]
                )

    return run


def reweigh(weighting, carried: list[str]):
    """Batches of (...carried, indices, values) of one vocabulary -> the same under another one.

    ``weighting`` is a broadcast (place of every old term among the new ones or -1, idf of the new ones); values are
    counts up to a factor per row.
    """

    def run(batches):
        place, idf = weighting.value
        for batch in batches:
            indices = batch.column("indices")
            rows, at = pc.list_parent_indices(indices).to_numpy(), place[pc.list_flatten(indices).to_numpy()]
            keep = at >= 0
            x = pc.list_flatten(batch.column("values")).to_numpy()[keep]
            lists = _unit_lists(rows[keep], at[keep], x, batch.num_rows, idf, False)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in carried] + lists, names=[*carried, "indices", "values"])

    return run


def token_counts(batches):
    """(row_id, tokens) to (row_id, term, tf), one row per distinct token of a row."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            tokens = part.column("tokens")
            rows = pc.list_parent_indices(tokens).to_numpy()
            words = pc.list_flatten(tokens).dictionary_encode()
            size = max(1, len(words.dictionary))
            pairs, tf = np.unique(rows.astype(np.int64) * size + words.indices.to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [part.column("row_id").take(pa.array(pairs // size)), words.dictionary.take(pa.array(pairs % size)), pa.array(tf)],
                names=["row_id", "term", "tf"])
