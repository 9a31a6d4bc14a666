"""Comment removal and text helpers against a character-by-character rule."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from inkprint.functions import text as tx


def strip_by_hand(code: str) -> str:
    code = code.replace("\\\r\n", "").replace("\\\n", "")
    out, i = [], 0
    while i < len(code):
        c = code[i]
        if c in "\"'":
            j = i + 1
            while j < len(code) and code[j] != c:
                j += 2 if code[j] == "\\" else 1
            if j < len(code):
                out.append(code[i:j + 1])
                i = j + 1
                continue
        elif code.startswith("//", i):
            j = code.find("\n", i)
            j = len(code) if j < 0 else j + 1
            out.append(" " + "\n" * code[i:j].count("\n"))
            i = j
            continue
        elif code.startswith("/*", i):
            j = code.find("*/", i + 2)
            if j >= 0:
                out.append(" " + "\n" * code[i:j + 2].count("\n"))
                i = j + 2
                continue
        out.append(c)
        i += 1
    return "".join(out)


CASES = [
    "", "int a; // x\nint b;", 'char *u = "http://x/";', "char q = '\"'; // y", "a /* 1\n2\n3 */ b",
    "// joined \\\nstill comment\ncode", "x \\\r\n// y", 'open " // kept? \n// gone', "/* open // inner",
    "a//b", "/**/x/***/y", "it's // fine", "'\\'' // c", '"\\"//" // c', "é // ü\nß /* ñ */ 漢😀",
    "\r\n// crlf\r\nx", '"' + "a" * 60_000 + '" // tail', "/" * 7, "/*/ x */",
]


def stripped(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, code string")
    return [r.s for r in rows.select("i", tx.strip_comments(F.col("code")).alias("s")).orderBy("i").collect()]


def test_strip_comments_cases(spark):
    assert stripped(spark, CASES) == [strip_by_hand(c) for c in CASES]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab/*\"'\\\n\r é", max_size=60), min_size=40, max_size=80))
def test_strip_comments_property(spark, texts):
    assert stripped(spark, texts) == [strip_by_hand(t) for t in texts]


def values(spark, texts, expression):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r.v for r in rows.select("i", expression(F.col("x")).alias("v")).orderBy("i").collect()]


def test_unwrap_fence(spark):
    got = values(spark, ["```c\nint a;\n```", " ```C \n x\n\n```\n", "```python\nx\n```", " plain ", "```\n\n```", "a ```c\nb\n```"],
                 tx.unwrap_fence)
    assert got == ["int a;", " x\n", "```python\nx\n```", "plain", "", "a ```c\nb\n```"]


def test_words_and_spaces(spark):
    assert values(spark, ["A b_1 Ünï, x"], tx.words) == [["a", "b_1", "ünï", "x"]]
    assert values(spark, ["a \t\u2003 b  c\u00a0\u00a0d e"], tx.collapse_spaces) == ["a b c d e"]
    assert values(spark, ["", " \n\u3000", "x "], tx.is_blank) == [True, True, False]


def test_percent_and_names(spark):
    row = spark.range(1).select(
        tx.percent(F.lit(0.97534)).alias("a"), tx.percent(F.lit(None).cast("double")).alias("b"),
        tx.display_name(F.lit("gpt-4.1"), {"gpt-4.1": "GPT-4.1"}).alias("c"),
        tx.id_suffix(F.lit("openai/gpt-4.1")).alias("d"),
    ).first()
    assert tuple(row) == ("97.53%", "—", "GPT-4.1", "gpt-4.1")
