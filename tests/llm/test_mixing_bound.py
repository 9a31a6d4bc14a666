"""What the knapsack meets when an equal share of every length was taken before it."""

import random
import time

import numpy as np

from inkprint.llm import mixing


def test_the_error_is_within_half_of_the_longest_document():
    draw = random.Random(2)
    for _ in range(500):
        sizes = np.array(draw.sample(range(1, 60), draw.randrange(1, 7)))
        counts = np.array([draw.randrange(1, 9) for _ in sizes])
        budget = draw.randrange(0, int(sizes @ counts) + 1)
        assert 2 * abs(int(mixing.fit_budget(sizes, counts, budget) @ sizes) - budget) <= sizes.max()


def test_reruns_agree_on_null_and_repeated_ids(spark):
    rows = [(None if k % 3 else k // 30, f"w{k} " * (1 + k % 4), "a" if k % 2 else None, 7) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, mix_copies int")
    taken = [sorted((r.text, r.mix_copies) for r in mixing.mix(docs.repartition(n, by)).collect()) for n, by in [(1, "text"), (5, "doc_id"), (7, "text")]]
    assert taken[0] == taken[1] == taken[2] and taken[0]
    assert mixing.mix(docs).columns == ["doc_id", "text", "source", "mix_copies"]


def test_a_very_long_document_widens_no_table():
    sizes, counts = np.array([5_000_000, 300, 7]), np.array([1, 400, 9])
    started = time.monotonic()
    for budget in (5_000_000, 5_050_001, 100_000, 2_600_000, 2_400_000):
        took = mixing.fit_budget(sizes, counts, budget)
        assert (took <= counts).all() and 2 * abs(int(took @ sizes) - budget) <= sizes.max()
    assert time.monotonic() - started < 20
