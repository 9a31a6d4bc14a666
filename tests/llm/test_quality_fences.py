"""Fences of groups: from their own spread, leaning on the language and on all rows while a group is small."""

from inkprint.llm import quality_rules

WORDS = " ".join(f"wort{k}" for k in range(40))


def text(capitals: int, k: int) -> str:
    """Some 240 letters, ``capitals`` of them capitals, none of it repeated."""
    return "A" * capitals + f"b{k} " + WORDS


def fences(spark, groups: dict) -> dict:
    rows = [(k, text(c, k), lang, source) for k, (lang, source, c) in enumerate((*at, c) for at, cs in groups.items() for c in cs)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    counted = quality_rules.measured(docs).drop("_row")
    return {(r._lang_key, r.source): r.max_capitals for r in quality_rules.group_fences(counted).collect()}


def test_spread_of_the_group_decides(spark):
    found = fences(spark, {("en", "even"): [2] * 400, ("en", "wide"): [1 + k % 120 for k in range(400)], ("de", None): [60] * 400})
    least = quality_rules.REACH * quality_rules.RATES["capitals"]
    assert found["en", "wide"] > 700 and found["en", "even"] < least + 20 and found["de", None] > found["en", "even"] + 100


def test_small_groups_lean_on_their_parent_without_a_switch(spark):
    groups = {(f"l{n}", f"s{n}"): [60] * n for n in (1, 99, 100, 101)}
    found = fences(spark, {("en", "many"): [2] * 3_000, **groups})
    one, below, at, above = (found[g] for g in groups)
    assert one == found["en", "many"]  # one row moves no quartile
    assert one < below == at == above  # nothing turns at the weight of the parent
