"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Each text yields whole-number counts and rates per thousand. For every language and source and
each rate a sketch is kept: a log-linear histogram (sixteen cells per power of two, so a quantile
is off by at most one sixteenth). Sketches are merged by adding counts, so partial
aggregation builds them, merging the sources of a language gives the language's sketch, and the
result does not depend on the order of merging.

A rate is an outlier beyond its group's fence: third quartile plus ``reach`` times the
interquartile range, with a least range per rate so that a group without spread does not reject
what differs by a rounding error. No group is too small for a fence of its own: into its sketch goes that of
its language, weighing ``prior_rows`` rows, and into the language's that of all rows likewise. A group of a few rows thus
has nearly its language's fence, and each further row counts for more, without a switch at any number of rows. In between,
a group unlike its language has a fence wide enough for both.

Null text counts as empty; null language and null source are groups of their own. Repeated rows
are judged row by row. Empty tables give empty results. Columns of any name are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from inkprint.llm.words import WORD, let, packed, text_of, unpacked, window_hashes, words
from inkprint.session import materialize

#: rate -> least interquartile range, per thousand.
RATES = {"symbols": 25, "repeats": 60, "dup_lines": 150, "capitals": 60, "marks": 30}
REACH = 3
PRIOR_ROWS = 100
#: Weight of one row; a cell of a parent sketch is worth a whole number of these parts.
ROW_WEIGHT = 64
CELLS = 16
SYMBOLS = r"[#*$%&|<>]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(tokens: Column, width: int = 5) -> Column:
    """Words inside windows that occur twice or more in the row."""
    def of_positions(at: Column) -> Column:
        gaps = F.when(F.size(at) < 2, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.size(at) - 1))
        return F.aggregate(gaps, F.lit(width), lambda total, k: total + F.least(F.lit(width), at[k] - at[k - 1]))

    def of_sorted(pairs: Column) -> Column:
        same = lambda a, b: pairs[a]["h"] == pairs[b]["h"]
        last = F.size(pairs) - 1
        again = F.filter(F.sequence(F.lit(0), last), lambda k: F.when(k > 0, same(k, k - 1)).otherwise(F.lit(False))
                         | F.when(k < last, same(k, k + 1)).otherwise(F.lit(False)))
        return let(F.sort_array(F.transform(again, lambda k: pairs[k]["i"])), of_positions)

    def of_hashes(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(F.sort_array(pairs), of_sorted))

    return let(window_hashes(tokens, width), of_hashes)


def measure(text: Column) -> Column:
    """Struct of the counts of one text; all of them are exact."""
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))

    def of(w: Column) -> Column:
        return let(F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)), lambda x: F.struct(*[c.cast("bigint").alias(n) for n, c in {
            "n_words": F.size(w), "word_chars": F.length(F.array_join(w, "")), "n_repeat_words": _repeat_words(w),
            "n_lines": F.size(x), "n_dup_lines": F.size(x) - F.size(F.array_distinct(x)),
            "n_symbols": count(SYMBOLS), "n_capitals": count("[A-Z]"), "n_marks": count(r"[!?\\^~=_+]")}.items()]))

    return let(words(text), of)


def _rates() -> dict[str, Column]:
    per = lambda part, whole: F.expr(f"1000 * {part} div greatest({whole}, 1)")
    return {"symbols": per("n_symbols", "word_chars"), "repeats": per("n_repeat_words", "n_words"),
            "dup_lines": per("n_dup_lines", "n_lines"), "capitals": per("n_capitals", "word_chars"),
            "marks": per("n_marks", "word_chars")}


def cell_of(value: Column) -> Column:
    """Sketch cell of a whole number: itself below 16, then 16 cells per power of two."""
    shift = F.length(F.bin(value)) - 5
    return F.when(value < CELLS, value).otherwise(
        (shift + 1) * CELLS + F.floor(value / F.pow(F.lit(2), shift)).cast("bigint") - CELLS).cast("bigint")


def value_of(cell: Column) -> Column:
    """Least value of a cell."""
    return F.when(cell < CELLS, cell).otherwise(
        ((cell % CELLS) + CELLS) * F.pow(F.lit(2), F.floor(cell / CELLS) - 1)).cast("bigint")


def sketches(measured: DataFrame, by: list[str]) -> DataFrame:
    """One row per group, rate and cell with its count."""
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("rate"), cell_of(value).alias("cell")) for name, value in _rates().items()]))
    return measured.select(*by, each.alias("_e")).select(*by, "_e.rate", "_e.cell").groupBy(*by, "rate", "cell").agg(F.count("*").alias("n"))


def merge(sketch: DataFrame, by: list[str]) -> DataFrame:
    return sketch.groupBy(*by, "rate", "cell").agg(F.sum("n").alias("n"))


def blend(sketch: DataFrame, by: list[str], parent: DataFrame, on: list[str], prior_rows: int = PRIOR_ROWS) -> DataFrame:
    """Sketch of each group, its rows at ``ROW_WEIGHT``, with its parent's shares merged in at ``prior_rows`` rows."""
    share = F.lit(prior_rows * ROW_WEIGHT) * F.col("n")
    whole = F.sum("n").over(Window.partitionBy(*on, "rate"))
    prior = parent.select(*[F.col(name).alias(f"_{name}") for name in [*on, "rate"]], "cell", F.call_function("div", share, whole).alias("n"))
    meets = F.lit(True)
    for name in on:
        meets = meets & F.col(name).eqNullSafe(F.col(f"_{name}"))
    groups = sketch.select(*by, "rate").distinct()
    given = groups.join(prior, meets & (F.col("rate") == F.col("_rate"))).select(*by, "rate", "cell", "n")
    return merge(sketch.withColumn("n", ROW_WEIGHT * F.col("n")).unionByName(given.where("n > 0")), by)


def fences(sketch: DataFrame, by: list[str], reach: int = REACH) -> DataFrame:
    """One row per group with, per rate, the highest value that passes."""
    group = Window.partitionBy(*by, "rate")
    seen = sketch.select(*by, "rate", "cell", F.sum("n").over(group).alias("all"), F.sum("n").over(group.orderBy("cell")).alias("upto"))
    quartile = lambda q: F.min(F.when(4 * F.col("upto") >= q * F.col("all"), F.col("cell")))
    found = seen.groupBy(*by, "rate").agg(value_of(quartile(1)).alias("q1"), value_of(quartile(3)).alias("q3"))
    least = F.create_map(*[F.lit(x) for pair in RATES.items() for x in pair])
    fence = F.col("q3") + reach * F.greatest(F.col("q3") - F.col("q1"), least[F.col("rate")])
    return found.groupBy(*by).agg(*[F.max(F.when(F.col("rate") == r, fence)).alias(f"max_{r}") for r in RATES])


def group_fences(measured: DataFrame, reach: int = REACH, prior_rows: int = PRIOR_ROWS) -> DataFrame:
    """Fences per language and source, from sketches that lean on their language's and on that of all rows."""
    own = materialize(sketches(measured, ["lang", "source"]), "sketches")
    of_lang = merge(own, ["lang"])
    lang = blend(of_lang, ["lang"], merge(of_lang, []), [], prior_rows)
    return fences(blend(own, ["lang", "source"], lang, ["lang"], prior_rows), ["lang", "source"], reach).withColumnRenamed("lang", "_lang_key")


def measured(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, every row of ``docs`` as ``_row`` and the counts of its text."""
    return docs.select(packed(docs).alias("_row"), "lang", "source", F.inline(F.array(measure(text_of("text")))))


def judge(counted: DataFrame, limits: DataFrame) -> DataFrame:
    """``base_failed`` and ``kept`` beside the counts, against the fences of the row's group."""
    named = limits.withColumnRenamed("source", "_source_key")
    joined = counted.join(named, F.expr("lang <=> _lang_key and source <=> _source_key"), "left")
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    within = F.lit(True)
    for name, value in _rates().items():
        within = within & (value <= F.col(f"max_{name}"))
    return joined.withColumn("base_failed", base).withColumn("kept", ~base & F.coalesce(within, F.lit(True)))


def stored_fences(counted: DataFrame, reach: int = REACH, prior_rows: int = PRIOR_ROWS) -> DataFrame:
    """Fences written once; their size on disk tells the planner whether they may be broadcast."""
    return materialize(group_fences(counted, reach, prior_rows), "fences")


def report(docs: DataFrame, **settings) -> DataFrame:
    """Id, counts and verdict of every row; texts are read once, only counts are stored."""
    counted = materialize(measured(docs.select("doc_id", "text", "lang", "source")).withColumn("doc_id", F.col("_row.doc_id")).drop("_row"), "counts")
    return judge(counted, stored_fences(counted, **settings))


def keep(docs: DataFrame, **settings) -> DataFrame:
    """Rows of ``docs`` that pass, with the columns they came with. Texts are read twice and not moved."""
    counted = measured(docs)
    return unpacked(judge(counted, stored_fences(counted.drop("_row"), **settings)).where("kept"), docs.columns)
