"""Components end at stars, and the comparison of two sketches stays small enough to be compiled."""

import re

from inkprint.llm import coordinate_join as cj, graph


def test_stars_need_no_step_and_chains_end_at_their_least_node(spark, monkeypatch):
    steps, step = [], graph._step
    monkeypatch.setattr(graph, "_step", lambda *a: steps.append(1) or step(*a))
    found = lambda edges: {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found([(2, 1), (1, 3), (3, 3), (5, 4), (4, 5)]) == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4} and not steps
    assert found([(k, k + 1) for k in range(1, 20)]) == {k: 1 for k in range(1, 21)} and steps


def test_comparison_of_sketches_is_compiled(spark, capsys):
    posts = spark.createDataFrame([(k, 100, 1, 7, min(k, 2)) for k in range(1, 4)], "id long, n long, weight long, token long, component long")
    sketch = spark.createDataFrame([(k, [k] * 32) for k in range(1, 4)], "id long, sketch array<bigint>")
    prefix = spark.createDataFrame([(k, [7]) for k in range(1, 4)], "id long, prefix array<bigint>")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pairs = cj._across(posts, sketch, prefix, 85)
        pairs.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000  # HotSpot interprets larger methods
    assert sorted(pairs.collect()) == [(1, 3)]  # parity rules out 1 and 2
