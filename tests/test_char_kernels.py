"""Character n-grams: counts added up over a task and the trie of the vocabulary, against a count in plain Python."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from inkprint.functions import ngrams

SIZES = (3, 4, 5)
TEXTS = ["abcabc abcab", "", "ab", "xyzzyx\U0001f600\U0001f600\U0001f600", "aaaaaaaaa", "日本語日本語テキスト", "abcab", "x" * 70_000] * 2


def grams(text):
    return Counter(text[i:i + n] for n in SIZES for i in range(len(text) - n + 1))


def counted(batches):
    table = pa.Table.from_batches(list(batches)).to_pylist()
    cf, df = Counter(), Counter()
    for row in table:
        cf[row["term"]] += row["cf"]
        df[row["term"]] += row["df"]
    return len(table), cf, df


def batches(*columns):
    return [pa.RecordBatch.from_arrays([pa.array(TEXTS[at:at + 3]), pa.array(range(at, at + len(TEXTS[at:at + 3])))], names=["text", "row_id"]).select(list(columns))
            for at in range(0, len(TEXTS), 3)]


@pytest.mark.parametrize("limits", [{}, {"HELD_GRAMS": 8}, {"SLICE_CHARS": 4}, {"SLICE_TOKENS": 5}])
def test_counts_are_added_up_over_the_task(monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(ngrams, name, value)
    cf, df = sum(map(grams, TEXTS), Counter()), sum((Counter(set(grams(t))) for t in TEXTS), Counter())
    rows, found_cf, found_df = counted(ngrams.corpus_counts(SIZES)(batches("text")))
    assert (found_cf, found_df) == (cf, df)
    if "HELD_GRAMS" not in limits:
        assert rows == len(cf)  # each term once, not once a batch


def test_a_script_of_many_letters_is_counted_too():
    texts = ["".join(map(chr, range(0x4E00, 0x4E00 + 5000))), "abcabc", "".join(map(chr, range(0x3400, 0x3400 + 3000))) + "abc"]
    made = [pa.RecordBatch.from_arrays([pa.array([t])], names=["text"]) for t in texts]
    assert counted(ngrams.corpus_counts(SIZES)(made))[1:] == (sum(map(grams, texts), Counter()), sum((Counter(set(grams(t))) for t in texts), Counter()))


@pytest.mark.parametrize("cells", [1 << 24, 4])
def test_trie_finds_the_terms_of_the_vocabulary(monkeypatch, cells):
    monkeypatch.setattr(ngrams, "TRIE_CELLS", cells)
    terms = sorted(t for t in set().union(*map(grams, TEXTS)) if hash_free(t))
    assert ngrams._Trie(terms, SIZES).small == (cells > 4)

    class Shared:
        value = (terms, np.arange(1.0, len(terms) + 1), True)

    got = pa.Table.from_batches(list(ngrams.weigh_chars(Shared, SIZES)(batches("text", "row_id")))).to_pylist()
    long = pa.Table.from_batches(list(ngrams.weigh_chars_long(Shared, SIZES, 6)(batches("text", "row_id")))).to_pylist()
    flat = []
    for i, (text, row) in enumerate(zip(TEXTS, got)):
        raw = {k: (1 + np.log(n)) * (k + 1) for k, t in enumerate(terms) if (n := grams(text)[t])}
        norm = np.sqrt(sum(x * x for x in raw.values()))
        assert row["row_id"] == i and row["indices"] == list(raw) and np.allclose(row["values"], [x / norm for x in raw.values()], rtol=1e-12)
        flat += [(i, round(v, 6), terms[k]) for k, v in zip(row["indices"], row["values"])]
    assert [(r["row_id"], r["term"]) for r in long] == [(i, t) for i, _, t in flat]
    assert np.allclose([r["weight"] for r in long], [w for _, w, _ in flat], atol=1e-9)


def hash_free(term):
    return sum(map(ord, term)) % 3 != 0  # about two thirds of the terms are known


def test_tfidf_char_makes_its_rows_where_the_texts_are(spark):
    from inkprint.plans import feature_queries as fq

    plan = fq.tfidf_char(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
