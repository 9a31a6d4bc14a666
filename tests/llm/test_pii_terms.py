"""Terms that disclose an entity, counted over whole texts and replaced wherever they stand."""

import math
import random

import pytest

from inkprint.llm import pii

FILLER = " ".join(["common", "words", "stand", "between", "these", "parts"] * 12)
OTHERS = [(k, f"{FILLER} {'even' if k % 2 else 'odd'} number") for k in range(100, 160)]


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_terms_far_from_the_entity_and_without_it(spark, monkeypatch, broadcast):
    monkeypatch.setattr(pii, "BROADCAST_ROWS", broadcast)
    rows = [(k, f"Zimmerling reports\n{FILLER} {own} mail a.b@c.de") for k, own in enumerate(["even", "odd", "number"])]
    rows += [(3, f"seen: ZIMMERLING, {FILLER}"), (4, f"seen: ZIMMERLING, {FILLER}"), (5, None)]
    docs = spark.createDataFrame(rows + OTHERS, "doc_id bigint, text string")
    new = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert all("zimmerling" not in new[k].lower() for k in range(5))
    assert new[3] == f"seen: <term>, {FILLER}" and new[5] is None and all(new[k] == t for k, t in OTHERS)
    spans = {r.doc_id: r.spans for r in pii.report(docs).collect()}
    assert spans[3] == spans[4] == "term:6:16" and spans[100] == ""


def test_support_of_a_passage_shared_by_different_texts(spark):
    passage = f"{FILLER} Zimmerling a.b@c.de {FILLER}"
    rows = [(k, f"{own} {passage} {own}") for k, own in enumerate(["even", "odd", "number"])]
    new = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame(rows + OTHERS, "doc_id bigint, text string")).collect()}
    assert all("Zimmerling" not in new[k] for k in range(3))


def test_copies_of_one_text_are_no_evidence(spark):
    rows = [(k, "Zimmerling a.b@c.de") for k in range(3)]
    new = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame(rows + OTHERS, "doc_id bigint, text string")).collect()}
    assert all(new[k] == "Zimmerling <email>" for k in range(3))


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_rare_words_of_two_variants_stay_in_clean_texts(spark, monkeypatch, broadcast):
    monkeypatch.setattr(pii, "BROADCAST_ROWS", broadcast)
    rows = [(k, f"{own} Zimmerling {FILLER} a.b@c.de") for k, own in enumerate(["even", "odd"])]
    rows += [(2, f"Zimmerling {FILLER}")]
    docs = spark.createDataFrame(rows + OTHERS, "doc_id bigint, text string")
    new = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "<term>" in new[0] and "<term>" in new[1] and "Zimmerling" not in new[0] + new[1]
    assert new[2] == rows[2][1] and all(new[k] == t for k, t in OTHERS)


def disclosing_by_force(texts):
    """{(entity, term): everywhere} from every pair of the texts."""
    rows = []
    for text in texts:
        spans = pii.base_spans(text or "")
        inside = {t for t, _, _ in pii.terms(text or "", spans)}
        rows.append((text or "", set(pii.entities(text or "", spans)), inside, {m.lower() for m in pii._TERM.findall(text or "")}))
    out = {}
    for entity in set().union(*[e for _, e, _, _ in rows]):
        holds = [r for r in rows if entity in r[1]]
        for term in set().union(*[r[2] for r in holds]):
            both = [r for r in holds if term in r[2]]
            n_t = max(len(both), sum(term in r[3] for r in rows))
            content = math.log(len(rows) / len(holds))
            share = math.log(len(both) * len(rows) / (len(holds) * n_t)) / content if content > 0 else 0
            support = len({r[0] for r in both})
            if support >= 2 and share >= pii.DISCLOSURE:
                out[entity, term] = support >= 3 and 2 * len(both) >= n_t
    return out


def test_disclosing_terms_against_every_pair(spark):
    draw = random.Random(3)
    names = ["".join(draw.choices("abcdefg", k=4)) for _ in range(300)]
    rows = []
    for k in range(150):
        who = draw.randrange(8)
        said = draw.choices(names, k=12) + [f"only{'abcdefgh'[who]}"] * (draw.random() < 0.7)
        rows.append((k, " ".join(said) + (f" u{who}@x.org" if draw.random() < 0.75 else "")))
    rows += rows[:20] + [(None, None), (500, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    told = {(r.entity, r.term): r.everywhere for r in pii.disclosing(docs, pii.found(docs)).collect()}
    assert told == disclosing_by_force([t for _, t in rows]) and set(told.values()) == {True, False}
