"""Classifiers by their held-out accuracy, and the label model on votes with known accuracies."""

import numpy as np
import pytest

from inkprint.llm import pu_quality, queries, toxicity

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("name, label, least", [("op2_toxicity", "toxic", 0.97), ("op9_quality_classifier", "quality", 0.97)])
def test_held_out_accuracy(spark, name, label, least):
    scored = queries.QUERIES[name](spark, SF).where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    rows = scored.select("score", "predicted", label).collect()
    assert len(rows) > 500 and sum(r.predicted == r[label] for r in rows) / len(rows) >= least


def test_label_model_finds_accuracies_and_correlation():
    draw = np.random.default_rng(1)
    y = draw.random(40_000) < 0.1
    rate = np.array([0.9, 0.8, 0.7, 0.85])
    v = (draw.random((len(y), 4)) < np.where(y[:, None], rate, 0.02)).astype(np.int8)
    v = np.concatenate([v, np.where(draw.random((len(y), 1)) < 0.95, v[:, :1], 0)], 1).astype(np.int8)
    codes = toxicity._codes(v)
    model = toxicity.LabelModel(5).fit(np.bincount(codes, minlength=32).astype(float))
    p = model.posterior()[codes]
    assert ((p >= 0.5) == y).mean() > 0.97
    copied = model.theta[1 + 2 * 5 + model.pairs.index((0, 4))]
    assert copied == max(model.theta[1 + 2 * 5:])


def test_class_prior_and_risk():
    draw = np.random.default_rng(2)
    good, bad = draw.normal(0, 1, (4000, 2)), draw.normal(4, 1, (800, 2))
    unlabelled, positive = np.concatenate([good[:3200], bad]), good[3200:]
    values = np.concatenate([positive, unlabelled])
    cuts = pu_quality.cut_points(values)
    size = sum(2 * len(c) + 1 for c in cuts)
    p, u = pu_quality.cells_of(positive, cuts), pu_quality.cells_of(unlabelled, cuts)
    prior = pu_quality.class_prior(p, u, size)
    assert abs(prior - 0.8) < 0.08
    said = pu_quality.margins(u, pu_quality.fit(p, u, size, prior)) >= 0
    assert (said == (np.arange(4000) < 3200)).mean() > 0.95
