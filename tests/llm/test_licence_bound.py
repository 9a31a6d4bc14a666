"""Paragraphs that the bound sets aside are of the unknown class; punctuation is dropped from a whole text at once."""

import random

from pyspark.sql import functions as F

from inkprint.llm import licences
from inkprint.llm.words import let

TEXTS = ["", "\n\n", "A-b. (c)\n...\n-x-\r\nΣΑΣ\u0085y\n\tEnd.", "Released under the MIT License.\nplain words\nAll rights reserved."]


def test_paragraphs_are_those_of_each_line(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    each = F.filter(F.transform(F.split("text", "\n"), licences.tokens), lambda t: F.size(t) > 0)
    assert all(r.a == r.b for r in df.select(licences.paragraphs(F.col("text")).alias("a"), each.alias("b")).collect())


def test_bound_changes_no_family(spark):
    rng, vocabulary = random.Random(4), licences.Vocabulary(spark)
    weights = [[rng.uniform(-1, 1) for _ in range(vocabulary.size + 2)] for _ in licences.FAMILIES]
    lines = [t for texts in licences.TEMPLATES.values() for t in texts] + [" ".join(rng.choices("the of license under word more x y".split(), k=9)) for _ in range(40)]
    df = spark.createDataFrame([(line,) for line in lines], "text string").select(licences.tokens(F.col("text")).alias("t"))
    for handicap in (0.0, 3.0, 8.0):
        model = licences.Model(vocabulary, weights, handicap)
        unknown = len(licences.FAMILIES) - 1
        x = vocabulary.features(F.col("t"))
        gap = let(let(x, model.margins), lambda m: F.array_max(F.slice(m, 1, unknown)) - m[unknown])
        rows = df.select(let(x, model.most).alias("most"), gap.alias("gap"), model.judged(F.col("t"))["family"].alias("family")).collect()
        assert all(r.most >= r.gap - 1e-9 for r in rows)
        assert all((r.family < unknown) == (r.gap >= handicap) for r in rows if abs(r.gap - handicap) > 1e-9)
        assert any(r.most < handicap for r in rows) or handicap == 0.0
