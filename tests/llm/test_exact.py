"""Operators that SQL cannot express, against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from inkprint.llm import graph, lattice, licences, lm_score, mixing, ngram_join, pii, queries
from inkprint.llm.shingles import shingle_sets

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles_of(text, width):
    w = words_of(text)
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def classes_by_force(texts, width, percent):
    sets, above = {i: shingles_of(t, width) for i, t in texts.items()}, {i: i for i in texts}

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    for i, j in itertools.combinations(sorted(sets), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            a, b = top(i), top(j)
            above[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i in sets}


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_join_on_the_smallest_table(spark, texts, width, percent):
    got = ngram_join.classes(spark.read.parquet(f"{SF}/documents.parquet"), width, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == classes_by_force(texts, width, percent)


def test_join_of_a_large_group_of_near_copies(spark):
    draw = random.Random(3)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(160):
        own = list(base)
        for _ in range(draw.choice([0, 1, 1, 2, 3, 4])):
            own[draw.randrange(len(own))] = f"z{draw.randrange(12)}"
        rows.append((1000 - i, " ".join(own[: draw.choice([120, 120, 112])])))
    rows += [(k, " ".join(draw.choices(base, k=60))) for k in range(40)]
    want = classes_by_force(dict(rows), 3, 90)
    got = ngram_join.classes(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want
    assert 1 < len({c for _, c in want.values()}) < 200


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 200), (7, 7)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 140)} | {200: 200, 201: 200}


def test_shingle_hashes_tell_sets_apart(texts):
    assert [len(s) for s in shingle_sets(list(texts.values()), 3)] == [len(shingles_of(t, 3)) for t in texts.values()]


def luhn(digits):
    doubled = [sum(divmod(2 * int(d), 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def base_by_force(text):
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for place, (kind, pattern) in enumerate(kinds.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {"email": True, "ip": kind == "ip" and max(map(int, m[0].split("."))) <= 255,
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            out += [(m.start(), place, m.end(), kind)] * fine
    return sorted(out)


def test_entities_of_hostile_texts():
    draw = random.Random(5)
    for _ in range(3000):
        text = "".join(draw.choices(["a@b.c", "@", ".", "1", "22", "255", "4111111111111111", " ", "-", "+1", "(212)", "x", "%", "é", "999.1.1.1.1"], k=draw.randrange(14)))
        assert [(a, k, b) for a, k, b in pii.base_spans(text)] == [(a, k, b) for a, k, b, _ in base_by_force(text)]


def test_base_spans_of_the_smallest_table(spark, texts):
    for r in queries.op4_pii(spark, SF).collect():
        base = base_by_force(texts[r.doc_id])
        told = ",".join(f"{k}:{a}:{b}" for a, _, b, k in base)
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest() and set(filter(None, told.split(","))) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[3] == k for b in base) for k in pii.KINDS]


def test_terms_that_reveal_an_entity(spark):
    rows = [(1, "Call Robert Zimmer at a.b@c.de today please"), (2, "yes Robert writes from a.b@c.de often"), (3, "now robert ZIMMER, a.b@c.de")]
    rows += [(k, f"please call today often nothing from yes writes here now {k}") for k in range(7, 40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    new = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert new[2] == "yes  writes from <email> often" and "robert" not in new[3].lower() and "ZIMMER" not in new[3]
    assert all(new[k] == t for k, t in rows[3:])
    spans = {r.doc_id: r.spans for r in pii.report(docs).collect()}
    assert spans[2] == "term:4:10,email:23:31" and spans[7] == ""


def test_targets_and_budgets_of_the_smallest_table(spark, texts):
    rows = queries.op3_mixing(spark, SF).collect()
    assert {r.doc_id: r["size"] for r in rows} == {i: len(words_of(t)) for i, t in texts.items()}
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    size, taken, target = Counter(), Counter(), {}
    for r in rows:
        size[source[r.doc_id]] += r["size"]
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert r.taken in (0, r["size"], 2 * r["size"])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(size))}
    want, total = dict.fromkeys(size, 0.0), 1.5 * sum(size.values())
    open_ = set(size)
    while open_:  # share, cap, share the excess again
        left = total - sum(want[s] for s in size if s not in open_)
        for s in open_:
            want[s] = left * weight[s] / sum(weight[o] for o in open_)
        above = {s for s in open_ if want[s] > 2 * size[s]}
        for s in above:
            want[s] = 2.0 * size[s]
        open_ -= above
        if not above:
            break
    assert target == pytest.approx(want)
    for s in size:
        own = [r["size"] for r in rows if source[r.doc_id] == s]
        sums = {sum(c) + size[s] * k for k in (0, 1) for n in range(len(own) + 1) for c in itertools.combinations(own, n)}
        assert abs(taken[s] - target[s]) <= min(abs(x - target[s]) for x in sums) + 0.5
    assert sorted(queries.op3_mixing(spark, SF).collect()) == sorted(rows)


def test_budgets_against_all_subsets():
    draw = random.Random(1)
    for _ in range(200):
        sizes = np.array(draw.sample(range(1, 40), draw.randrange(1, 6)))
        counts = np.array([draw.randrange(1, 4) for _ in sizes])
        budget = draw.randrange(0, int(sizes @ counts) + 5)
        took = mixing.fit_budget(sizes, counts, budget, reserve=1000)
        sums = {int(np.dot(sizes, t)) for t in itertools.product(*[range(c + 1) for c in counts])}
        share = [int(c) * budget // int(sizes @ counts) for c in counts]
        assert (took <= counts).all() and (took >= 0).all() and int(sizes @ took) in sums
        if not any(share):
            assert abs(int(sizes @ took) - budget) == min(abs(s - budget) for s in sums)


def test_a_source_and_length_that_holds_most_rows(spark):
    rows = [(k, "a b c", "s") for k in range(3000)] + [(3000 + k, "a b", "t") for k in range(100)]
    got = mixing.report(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    taken = defaultdict(int)
    for r in got:
        taken[r.source_size] += r.taken
    targets = {r.source_size: r.target for r in got}
    assert all(abs(taken[s] - targets[s]) <= 3 for s in targets)


def lattice_by_force(word, scores, bytes_):
    text, total = lattice.START + word, []

    def walk(at, score):
        if at == len(text):
            total.append(score)
        for to in range(at + 1, len(text) + 1):
            if text[at:to] in scores:
                walk(to, score + scores[text[at:to]])
            elif to == at + 1:
                walk(to, score + sum(bytes_[b] for b in text[at:to].encode()))

    walk(0, 0.0)
    return math.log(sum(map(math.exp, total)))


def test_lattice_sums_all_segmentations():
    pieces = ["▁", "a", "b", "c", "ab", "bc", "▁a", "▁ab", "abc"]
    scores, bytes_ = np.log(np.arange(1, 10) / 60), np.full(256, -7.0)
    words = ["abc", "a", "cab", "aébc", "abcabcab", "zz"]
    got = lattice.log_marginals(words, lattice.Pieces(pieces), scores, bytes_)
    assert got == pytest.approx([lattice_by_force(w, dict(zip(pieces, scores)), bytes_) for w in words])
    used, spelled = lattice.expected_counts(["ab"], np.array([2.0]), lattice.Pieces(pieces), scores, bytes_)
    assert used @ np.array([len(p) for p in pieces]) == pytest.approx(2 * 3) and spelled.sum() == 0


def test_word_model_by_force(spark, texts):
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    c = Counter()
    for i, t in texts.items():
        if not held(i):
            c.update([*words_of(t), None])
    n, v = sum(c.values()), len(c)
    for r in queries.op5_lm_score(spark, SF).collect():
        tokens = [*words_of(texts[r.doc_id]), None]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(tokens), sum(c[t] > 0 for t in tokens), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)) and r.score < 0


def test_frequent_words_are_bounded(spark):
    rows = spark.createDataFrame([(k, n) for k, n in enumerate([1] * 50 + [2] * 20 + [40, 500, 501])], "h bigint, n bigint")
    for most in (1, 3, 30, 1000):
        least = lm_score.least_frequent(rows, most)
        assert rows.where(f"n >= {least}").count() <= most
    assert lm_score.least_frequent(rows, 1000) == 1


def test_licence_lines_inside_other_text(spark):
    other = [(k, f"plain words about topic {k} and nothing else\nanother line of text {k * 7} here") for k in range(60)]
    lines = ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.",
             "This work is licensed under the GNU General Public License, version 3."]
    docs = spark.createDataFrame(other + [(100 + k, f"some text\n{x}\nmore text") for k, x in enumerate(lines)], "doc_id bigint, text string")
    found = {r.doc_id: [(x.paragraph, x.family) for x in r.licences if x.confirmed] for r in licences.scan(docs).collect()}
    assert [found[100 + k] for k in range(4)] == [[(1, f)] for f in ("Apache-2.0", "MIT", "CC-BY-NC", "GPL")]
    assert not any(found[k] for k in range(60))
