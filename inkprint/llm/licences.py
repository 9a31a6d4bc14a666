"""Licence scans: a trained paragraph classifier over word n-grams, confirmed against templates.

A paragraph is a line of a text. Its features are the distinct words and word pairs (lower-cased, ASCII punctuation
but ``.`` ``+`` ``-`` inside words dropped) that occur in the licence templates, found by hash, and the share of its
words and pairs that occur in none. A multinomial logistic regression, fitted by Spark ML, tells the licence families and
the class ``unknown``. It is trained on the templates' sentences, whole and with words left out, and on
three quarters, told by hash, of the corpus' different paragraphs that share less than half their word pairs
with any template. Paragraphs with the same features are one row with their number, and together they weigh as
``BACKGROUND`` at most, so that the sentences count as much in a large corpus as in a small one.

Calibration. The unknown class gets the least handicap at which at most one in a thousand of the other quarter
is taken for a licence.

Confirmation. A predicted paragraph is confirmed when at least half of its word pairs occur in the templates of its
family, or when it holds four fifths of the pairs of one of the family's sentences.

Texts are scored where they lie, with built-in functions only; nothing is shuffled. Null and empty texts have no
paragraphs and no licence. Null ids are carried. Repeated rows are reported each.
"""

from __future__ import annotations

import json
import re

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from inkprint.llm.words import SPACE, let, text_of
from inkprint.operators.features import _boundary, as_vectors

BACKGROUND = 4_000
SLOTS = 1 << 16
UNKNOWN = "unknown"
FALSE_ALARMS = 1_000  # one in so many

# Sentences of the families' notices and licence texts.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "AGPL": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
             "Licensed under the GNU Affero General Public License, version 3.", "You should have received a copy of the GNU Affero General Public License along with this program.", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
                   "Licensed under the Apache License, Version 2.0.", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
                   "Released under the Apache 2.0 license.", "SPDX-License-Identifier: Apache-2.0"),
    "BSD": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
            "Released under the BSD 3-Clause License.", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "SPDX-License-Identifier: BSD-3-Clause"),
    "CC-BY": ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0.",
              "This is an open access article distributed under the Creative Commons Attribution License, which permits unrestricted use, distribution, and reproduction in any medium, provided the original work is properly cited."),
    "CC-BY-NC": ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0.",
                 "Licensed under CC BY-NC-SA 4.0.", "You may not use the material for commercial purposes under this Creative Commons NonCommercial license."),
    "CC-BY-SA": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0.",
                 "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply."),
    "CC0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "Released under CC0 1.0 Universal Public Domain Dedication.", "This work is dedicated to the public domain."),
    "GPL": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
            "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
            "You should have received a copy of the GNU General Public License along with this program.", "This work is licensed under the GNU General Public License, version 3.",
            "This work is licensed under the GNU General Public License, version 2.", "Released under the GPL v3 license.", "SPDX-License-Identifier: GPL-3.0-or-later"),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
            "Released under the ISC License.", "SPDX-License-Identifier: ISC"),
    "LGPL": ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
             "Licensed under the GNU Lesser General Public License, version 2.1.", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    "MIT": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED.",
            "Released under the MIT License.", "Licensed under the MIT license.", "SPDX-License-Identifier: MIT"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
                "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0"),
    "proprietary": ("All rights reserved.", "Copyright. All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form without the prior written permission of the publisher.",
                    "This software is proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited."),
}
FAMILIES = (*sorted(TEMPLATES), UNKNOWN)


def _plain(text: Column) -> Column:
    """Lower-cased, with spaces for punctuation; line ends stay."""
    return F.regexp_replace(F.lower(text), r"""[!"#$%&'()*,/:;<=>?@\[\\\]^_`{|}~]+""", " ")


def _parts(plain: Column) -> Column:
    return F.filter(F.transform(F.split(plain, SPACE + "+"), lambda w: F.trim(w, F.lit(".+-"))), lambda w: w != "")


def tokens(paragraph: Column) -> Column:
    return _parts(_plain(paragraph))


def _hashes(t: Column) -> tuple[Column, Column]:
    """Hashes of the words and of the pairs of words of a token array."""
    pairs = F.when(F.size(t) < 2, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(t) - 2), lambda i: F.xxhash64(t[i], t[i + 1])))
    return F.transform(t, lambda w: F.xxhash64(w)), pairs


def _constant(value, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


class Vocabulary:
    """Slots of the templates' words and pairs, and the pairs of each family and sentence."""

    def __init__(self, spark: SparkSession) -> None:
        rows = [(family, k, text) for family in TEMPLATES for k, text in enumerate(TEMPLATES[family])]
        told = spark.createDataFrame(rows, "family string, k int, text string").select("family", "k", tokens(F.col("text")).alias("t"))
        one, two = _hashes(F.col("t"))
        found = told.select("family", "k", one.alias("one"), F.array_distinct(two).alias("two")).collect()
        slots = sorted({h % SLOTS for row in found for h in [*row.one, *row.two]})
        self.number = {slot: n for n, slot in enumerate(slots, 1)}
        self.size = len(slots)
        self.sentences = {f: [list(r.two) for r in found if r.family == f and len(r.two) > 1] for f in TEMPLATES}

    def known(self, h: Column) -> Column:
        return _constant([slot in self.number for slot in range(SLOTS)], "array<boolean>")[F.pmod(h, F.lit(SLOTS)).cast("int")]

    def features(self, t: Column) -> Column:
        """Distinct feature numbers of a token array, then its share of hashes without a feature."""
        table = _constant([self.number.get(slot, 0) for slot in range(SLOTS)], "array<int>")

        def of(h: Column) -> Column:
            hit = F.filter(F.transform(h, lambda x: table[F.pmod(x, F.lit(SLOTS)).cast("int")]), lambda n: n > 0)
            return let(hit, lambda n: F.struct(F.array_distinct(n).alias("on"), (1.0 - F.size(n) / F.greatest(F.size(h), F.lit(1))).alias("off")))

        return let(F.concat(*_hashes(t)), of)

    def confirmed(self, t: Column, family: Column) -> Column:
        each = _constant([[] if f == UNKNOWN else self.sentences[f] for f in FAMILIES], "array<array<array<bigint>>>")

        def of(own: Column) -> Column:
            known = each[family]
            by_family = 2 * F.size(F.array_intersect(own, F.flatten(known))) >= F.size(own)
            by_sentence = F.exists(known, lambda s: 5 * F.size(F.array_intersect(s, own)) >= 4 * F.size(s))
            return (F.size(own) > 0) & (by_family | by_sentence)

        return let(F.array_distinct(_hashes(t)[1]), of)


def paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(_plain(text), "\n"), _parts), lambda t: F.size(t) > 0)


def background(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(x, aside, n): features of the corpus' paragraphs that resemble no template and how many different paragraphs have them.

    Paragraphs are told apart by a 64-bit hash, so that their texts are not shuffled.
    """
    each = docs.select(F.explode(paragraphs(text_of("text"))).alias("t"))
    every = _constant([h for s in vocabulary.sentences.values() for t in s for h in t], "array<bigint>")
    def unlike(own: Column) -> Column:
        # Most paragraphs have few pairs in slots of the vocabulary, which tells without comparing the pairs themselves.
        least = F.greatest(F.size(own), F.lit(1))
        return (2 * F.size(F.filter(own, vocabulary.known)) < least) | (2 * F.size(F.array_intersect(own, every)) < least)

    told = each.where(let(F.array_distinct(_hashes(F.col("t"))[1]), unlike)).select(F.xxhash64(F.lit(7), "t").alias("h"), vocabulary.features(F.col("t")).alias("x"))
    different = told.groupBy("h", "x").agg(F.lit(1).alias("one"))
    return different.groupBy("x", (F.pmod("h", F.lit(4)) == 0).alias("aside")).agg(F.count("*").alias("n"))


def _examples(spark: SparkSession) -> DataFrame:
    """Template sentences whole, and with every third and every fourth word left out in turn."""
    rows = []
    for label, family in enumerate(FAMILIES[:-1]):
        for text in TEMPLATES[family]:
            parts = re.findall(r"\S+", text)
            rows += [(label, text)] * 4
            rows += [(label, " ".join(w for i, w in enumerate(parts) if i % step != at)) for step in (3, 4) for at in range(step) if len(parts) > 5]
    return spark.createDataFrame(rows, "label int, text string").select("label", tokens(F.col("text")).alias("t"))


class Model:
    """Weights by family: offset, one per feature, and that of the share without a feature."""

    def __init__(self, vocabulary: Vocabulary, weights: list[list[float]], handicap: float) -> None:
        self.vocabulary, self.weights, self.handicap = vocabulary, weights, handicap

    def margins(self, features: Column) -> Column:
        """One margin per family, the unknown class last."""
        table = _constant(self.weights, "array<array<double>>")
        last = self.vocabulary.size + 1
        one = lambda w: F.aggregate(features["on"], w[0] + w[last] * features["off"], lambda total, n: total + w[n])
        return F.transform(table, one)

    def most(self, features: Column) -> Column:
        """No family's margin is further above that of the unknown class: the greatest difference of each weight, summed."""
        base = self.weights[-1]
        table = _constant([max(w[n] - base[n] for w in self.weights[:-1]) for n in range(len(base))], "array<double>")
        return F.aggregate(features["on"], table[0] + table[self.vocabulary.size + 1] * features["off"], lambda total, n: total + table[n])

    def judged(self, t: Column) -> Column:
        """family number, its probability and whether the templates confirm it.

        Most paragraphs are of the unknown class by :meth:`most` alone; these have no probability.
        """
        unknown = len(FAMILIES) - 1

        def of(m: Column) -> Column:
            raised = F.transform(m, lambda x, i: F.when(i == unknown, x + F.lit(self.handicap)).otherwise(x))
            return let(raised, best)

        def best(m: Column) -> Column:
            top = F.array_max(m)
            p = 1 / F.aggregate(m, F.lit(0.0), lambda total, x: total + F.exp(x - top))
            return F.struct((F.array_position(m, top) - 1).cast("int").alias("family"), p.alias("p"))

        def told(b: Column) -> Column:
            sure = F.when(b["family"] == unknown, False).otherwise(self.vocabulary.confirmed(t, b["family"]))
            return F.struct(b["family"].alias("family"), b["p"].alias("p"), sure.alias("confirmed"))

        def each(features: Column) -> Column:
            none = F.struct(F.lit(unknown).alias("family"), F.lit(None).cast("double").alias("p"), F.lit(False).alias("confirmed"))
            return F.when(self.most(features) < self.handicap - 1e-6, none).otherwise(let(let(self.margins(features), of), told))

        return let(self.vocabulary.features(t), each)


def least_handicap(gaps: DataFrame) -> float:
    """Least handicap, 0 or more, that at most one in ``FALSE_ALARMS`` of ``n`` paragraphs with this ``gap`` exceeds."""
    left = (gaps.agg(F.sum("n")).first()[0] or 0) // FALSE_ALARMS
    at = F.floor(F.col("gap") * 64)
    cells = gaps.groupBy(at.alias("cell")).agg(F.sum("n").alias("n")).orderBy(F.desc("cell"))
    cell, left = _boundary(cells, "cell", left)
    inside = gaps.where(at == F.lit(cell)).groupBy("gap").agg(F.sum("n").alias("n")).orderBy(F.desc("gap"))
    above, _ = _boundary(inside, "gap", left)
    return max(0.0, above + 1e-6) if above is not None else 0.0


def train(docs: DataFrame, most: int = BACKGROUND) -> Model:
    spark = docs.sparkSession
    vocabulary = Vocabulary(spark)
    unknown = len(FAMILIES) - 1
    other = background(docs.select(F.col("text").cast("string").alias("text")), vocabulary).select(F.lit(unknown).alias("label"), "aside", "x", "n")
    known = _examples(spark).select("label", F.lit(False), vocabulary.features(F.col("t")).alias("x"), F.lit(1))
    on = F.array_sort("x.on")
    told = as_vectors(other.union(known).withColumns({
        "indices": F.concat(F.transform(on, lambda i: i - 1), F.array(F.lit(vocabulary.size))),
        "values": F.concat(F.transform(on, lambda i: F.lit(1.0)), F.array("x.off"))}), vocabulary.size + 1)
    of_corpus = told.where(F.col("label") == unknown)
    share = min(1.0, most / (of_corpus.agg(F.sum("n")).first()[0] or most))
    weight = F.when(F.col("label") == unknown, F.col("n") * share).otherwise(1.0)
    fitted = told.where("not aside").select(F.col("label").cast("double").alias("label"), weight.alias("weight"), "features")
    fit = LogisticRegression(family="multinomial", regParam=3e-4, maxIter=60, standardization=False, weightCol="weight").fit(fitted)
    by_class = fit.coefficientMatrix.toArray()
    weights = [[float(b), *map(float, row)] for b, row in zip(fit.interceptVector.toArray(), by_class)]
    weights += [[-50.0] + [0.0] * (vocabulary.size + 1)] * (len(FAMILIES) - len(weights))  # no background: unknown is never seen
    model = Model(vocabulary, weights, 0.0)
    gap = let(model.margins(F.col("x")), lambda m: F.array_max(F.slice(m, 1, unknown)) - m[unknown])
    return Model(vocabulary, weights, least_handicap(of_corpus.where("aside").select(gap.alias("gap"), "n")))


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per row: id, number of paragraphs, and its licence paragraphs (position, family, probability, confirmed)."""
    fitted = model or train(docs)
    names = F.array(*[F.lit(f) for f in FAMILIES])

    def of(each: Column) -> Column:
        judged = F.transform(each, lambda t, i: F.struct(i.alias("paragraph"), fitted.judged(t).alias("b")))
        kept = F.filter(judged, lambda j: j["b"]["family"] < len(FAMILIES) - 1)
        return F.struct(F.size(each).alias("n"), F.transform(kept, lambda j: F.struct(
            j["paragraph"].alias("paragraph"), names[j["b"]["family"]].alias("family"), j["b"]["p"].alias("p"), j["b"]["confirmed"].alias("confirmed"))).alias("found"))

    told = docs.select("doc_id", F.inline(F.array(let(paragraphs(text_of("text")), of))))
    return told.select("doc_id", F.col("n").cast("bigint").alias("n_paragraphs"), F.col("found").alias("licences"))
