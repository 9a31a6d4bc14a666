"""Operators 11 to 13 against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from inkprint.llm import coordinate_join, hard_negatives, queries, spelling
from inkprint.llm.gnat import Tree
from tests.llm.test_exact import classes_by_force

SF = "/root/testdata/sf0.001"


def found_classes(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def test_minhash_join_on_the_smallest_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op11_minhash_join(spark, SF)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())
    assert found_classes(got) == classes_by_force(texts, 5, 85)


@pytest.mark.parametrize("pairs_per_salt, broadcast", [(1 << 20, 500_000), (50, 0)])
def test_minhash_join_of_a_large_group(spark, monkeypatch, pairs_per_salt, broadcast):
    """Copies with common and with own changes, some chained; hot lists are salted and nothing is broadcast the second time."""
    monkeypatch.setattr(coordinate_join, "PAIRS_PER_SALT", pairs_per_salt)
    monkeypatch.setattr(coordinate_join, "BROADCAST_ROWS", broadcast)
    draw = random.Random(5)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(150):
        own = list(base)
        for _ in range(draw.choice([0, 1, 1, 2, 3, 4, 5])):
            own[draw.randrange(len(own))] = f"z{draw.randrange(9)}"
        rows.append((2000 - i, " ".join(own[: draw.choice([150, 150, 138])])))
    rows += [(k, " ".join(draw.choices(base, k=60))) for k in range(30)]
    want = classes_by_force(dict(rows), 5, 85)
    assert found_classes(coordinate_join.classes(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))) == want
    assert 30 < len({c for _, c in want.values()}) < 175


def test_minhash_join_on_odd_rows(spark, odd_docs, no_docs):
    rows = coordinate_join.classes(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert [by_id[k].component_id for k in (1, 2, 3, 4, 5, 6, 7, 8)] == [1, 1, 3, 4, 5, 6, 7, 1]
    assert [by_id[k].n_shingles for k in (3, 4, 5, 6)] == [0, 0, 0, 1]
    assert by_id[None].component_id is None and by_id[None].kept
    assert {r.doc_id for r in coordinate_join.keep_one(odd_docs).collect()} == {1, 3, 4, 5, 6, 7, None}
    assert coordinate_join.classes(no_docs).count() == 0
    named = odd_docs.withColumn("doc_id", odd_docs.doc_id.cast("string"))
    assert {r.component_id for r in coordinate_join.classes(named).collect()} == {"1", "3", "4", "5", "6", "7", None}


def words_by_force(rows, damage=97):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run if h % damage else run[: h % len(run)] + run[h % len(run) + 1:]] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def one_away(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def forms_by_force(n):
    letters = sorted({c for w in n for c in w})
    out = {}
    for w in n:
        edits = {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters} | {w[:i] + w[i + 1:] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
        near = {x for x in edits - {w} if x in n}
        best = min(near, key=lambda x: (-n[x], x), default=None)
        form = best if best and n[best] >= 2 * n[w] else None
        out[w] = (form, n[w], len(near), n[form] if form else None)
    rows = {}
    for w, (form, *rest) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows[w] = (form, root, *rest)
    return rows


def found_forms(frame):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()}


def test_variants_on_the_smallest_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found_forms(queries.op12_spelling_variants(spark, SF)) == forms_by_force(words_by_force(docs))


def test_variants_of_short_alphabets_in_many_blocks(spark):
    draw = random.Random(2)
    n = {"".join(draw.choices("abé", k=draw.choice([5, 5, 6, 7, 8]))): draw.choice([3, 3, 4, 6, 12, 40]) for _ in range(700)}
    words = spark.createDataFrame(list(n.items()), "word string, n bigint").repartition(4)
    want = {w: (sum(one_away(w, x) for x in n), min((-n[x], x) for x in n if one_away(w, x))) for w in n if any(one_away(w, x) for x in n)}
    for block in (4096, 16):
        got = {r.word: (r.n_near, (-r.best_n, r.best)) for r in spelling.neighbours(words, block=block).collect()}
        assert got == want


def test_variants_follow_long_chains(spark):
    steps = ["aaaaab", "aaaabb", "aaabbb", "aabbbb", "abbbbb", "bbbbbb"]
    docs = spark.createDataFrame([(None, f"{w.upper()} ." * (3 * 2 ** k)) for k, w in enumerate(steps)], "doc_id bigint, text string")
    got = found_forms(spelling.group(docs, damage=10 ** 12))
    assert {w: r[1] for w, r in got.items()} == dict.fromkeys(steps, "bbbbbb") and got["aaaaab"][0] == "aaaabb"


def test_variants_on_odd_rows(spark, odd_docs, no_docs):
    got = found_forms(spelling.group(odd_docs))
    assert got == forms_by_force(words_by_force([(r.doc_id, r.text) for r in odd_docs.collect()])) and "quick" in got
    assert spelling.group(no_docs).count() == 0


def negatives_by_force(rows):
    kept = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        one = ((label + 1) % 10 if vec_id % 7 == 0 else label, [int(np.floor(256 * float(x))) for x in vector])
        kept[vec_id] = min(kept.get(vec_id, one), one)
    out = set()
    for a, (label, v) in kept.items():
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), b, m == label) for b, (m, w) in kept.items() if b != a)
        for s, b, _ in [x for x in scored if x[2]][:5]:
            inside = [x for x in scored if not x[2] and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out |= {(a, b, k + 1, x[1], -s, -x[0]) for k, x in enumerate(inside)}
    return out


def found_negatives(frame):
    rows = [(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


SCHEMA = "vec_id bigint, embedding array<float>, label int, score double, leaf string"


@pytest.mark.parametrize("kind", ["spread", "clusters", "ties", "few"])
def test_negatives_against_brute_force(spark, monkeypatch, kind):
    draw = np.random.default_rng(8)
    n, d = (1500, 8) if kind != "few" else (60, 3)
    centres = draw.normal(size=(12, d))
    label = draw.integers(0, 10, n)
    vectors = draw.normal(size=(n, d)) if kind == "spread" else centres[draw.integers(0, 12, n)] + 0.05 * draw.normal(size=(n, d))
    if kind == "ties":
        vectors = np.round(draw.normal(size=(n, d)))
    monkeypatch.setattr(hard_negatives, "FEWEST", 100)
    rows = [(int(i), [float(x) for x in v], int(m), 0.5, "mine") for i, v, m in zip(draw.permutation(n), vectors, label)]
    want = negatives_by_force([(i, np.float32(v), m) for i, v, m, *_ in rows])
    assert found_negatives(hard_negatives.mine(spark.createDataFrame(rows, SCHEMA).repartition(6))) == want
    assert want


def test_negatives_on_odd_rows(spark):
    rows = [(0, [1.0, 0.5], 1), (50, [0.9, 0.1], 1), (100, [1.0], 2), (100, [1.0], 2), (150, [], 1), (3, [0.7, 0.3], 2), (4, [0.7, 0.3], 2), (4, [0.7, 0.3], 2),
            (5, [0.7, 0.2], 3), (6, [1.0, 0.4], 1), (None, [1.0, 1.0], 1), (8, None, 1), (9, [1.0, None], 2), (10, [float("nan"), 1.0], 2),
            (11, [float("inf"), 1.0], 2), (12, [1.0, 1.0], None), (13, [1e30, 1.0], 2), (15, [-1.0, -1.0], 1), (16, [300.0, 2.0], 1), (17, [200.0, 1.0], 3)]
    frame = spark.createDataFrame([(*r, 0.5, "x") for r in rows], SCHEMA)
    want = negatives_by_force([r for r in rows if r[0] != 13])
    assert found_negatives(hard_negatives.mine(frame)) == want and want
    assert hard_negatives.mine(frame.where("false")).count() == 0


def test_tree_eliminates_subtrees_but_no_row():
    draw = np.random.default_rng(1)
    centres = 400 * draw.normal(size=(10, 6))
    rows = np.floor(centres[draw.integers(0, 10, 2000)] + 6 * draw.normal(size=(2000, 6)))
    tree = Tree(rows[:500])
    leaf, ranges = tree.place(rows)
    norms = (rows ** 2).sum(1)
    tree.describe(ranges, {int(k): (norms[leaf == k].min(), norms[leaf == k].max()) for k in np.unique(leaf)})
    queries = rows[:40]
    scores = queries @ rows.T
    low, high = np.quantile(scores, 0.97, axis=1), np.quantile(scores, 0.99, axis=1)
    alive = {k: tree.survives(k, tree.point_distances(queries), norms[:40], low, high) for k in range(tree.n_leaves)}
    inside = (scores >= low[:, None]) & (scores <= high[:, None])
    assert all(alive[leaf[r]][q] for q, r in zip(*np.nonzero(inside)))
    assert np.mean([a.mean() for a in alive.values()]) < 0.7


def test_combinations_are_few(spark):
    """No pairs inside a group of copies reach a shuffle: pairs met stay below a small multiple of the copies."""
    base = [f"w{k}" for k in range(200)]
    rows = [(i, " ".join([*base[:i % 200], f"own{i}", *base[i % 200:]])) for i in range(300)]
    seen = []
    plain = coordinate_join._confirmed

    def counted(pairs, sets, percent):
        seen.append(pairs.count())
        return plain(pairs, sets, percent)

    coordinate_join._confirmed = counted
    try:
        got = found_classes(coordinate_join.classes(spark.createDataFrame(rows, "doc_id bigint, text string")))
    finally:
        coordinate_join._confirmed = plain
    assert {c for _, c in got.values()} == {0} and sum(seen) < 10 * len(rows)
