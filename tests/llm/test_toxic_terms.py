"""Markers that few toxic rows hold, and voters' terms that the training rows lack."""

import numpy as np
from pyspark.sql import functions as F

from inkprint.llm import toxicity


def test_rare_markers_and_unseen_terms_of_voters(spark):
    toxic = [(k, f"note about number{k % 50} foulword{k % 10} topic{k % 7}", 1) for k in range(900)]
    toxic += [(900 + k, f"note about number{k} zzrare topic{k % 7}", 1) for k in range(8)]
    clean = [(1000 + k, f"note about number{k % 50} plainword{k % 10} topic{k % 7}", 0) for k in range(12_000)]
    held = [(-1, "note about number3 zzrare topic2", None), (-2, "note about number3 lowlife topic2", None),
            (-3, "note about number3: kill yourself", None), (-4, "note about number3 topic2", None)]
    rows = spark.createDataFrame(toxic + clean + held, "doc_id bigint, text string, toxic int")
    got = toxicity.score(rows.drop("toxic"), rows.where("toxic is not null").select("doc_id", "toxic"), F.col("doc_id") < 0)
    said = {r.doc_id: r for r in got.where("held_out").collect()}
    assert said[-1].predicted == 1 and said[-4].predicted == 0
    assert said[-2].score > 2 * said[-4].score and said[-3].score > 2 * said[-4].score


def test_without_training_rows_the_prior_and_the_fixed_voters_score(spark):
    rows = spark.createDataFrame([(1, "a plain note"), (2, "you are an idiot"), (3, None), (4, "a WORTHLESS İdiot")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id bigint, toxic int")
    said = {r.doc_id: r.score for r in toxicity.score(rows, labels, F.lit(True)).collect()}
    assert said[1] == said[3] and 0 < said[1] < 0.5 < said[2] < 1 and said[4] > said[1]


def test_matches_are_those_of_the_sets():
    texts = ["You are a pig, you know", None, "", "plain words only here", "kill yourself now", "İ ı KÉ"] * 3
    sets = [set(s.tolist()) for s in toxicity.feature_sets(texts)]
    features = np.unique(np.array([f for s in sets for f in sorted(s)[::2]] + [int(toxicity.ABUSE[0])], np.uint64))
    rows, places = toxicity.matches(texts, features)
    want = {(k, f) for k, s in enumerate(sets) for f in s & set(features.tolist())}
    want |= {(k, int(toxicity.ABUSE[0])) for k, t in enumerate(texts) if t and toxicity._ABUSE.search(t)}
    assert {(int(r), int(features[p])) for r, p in zip(rows, places)} == want and len(rows) == len(want)
