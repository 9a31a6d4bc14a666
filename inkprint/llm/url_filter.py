"""URL filter: a weighted vocabulary counted by an Aho-Corasick automaton, under host and path rules.

One pass over each lower-cased URL finds all vocabulary terms. A term counts only when neither
neighbour is an ASCII letter or digit. Terms of weight ``LIMIT`` are strict: one hit rejects. Lighter terms
are soft: each distinct term adds its weight, and the URL is rejected when the sum reaches ``LIMIT``.
An explicit rule for the URL's host and path goes before the vocabulary.

Null URLs and URLs without ``://`` have an empty host and path, so no rule fits them; a null URL has
no hits. Repeated rows are judged each. Columns of any name are carried along.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from inkprint.functions.shipping import ship_with_job
from inkprint.llm.words import lower_ascii, packed

ship_with_job(__name__)

LIMIT = 2
STRICT = ("adult", "bestiality", "camgirls", "casino", "erotic", "escort", "escorts", "hentai", "milf", "phishing", "porn",
          "porno", "pornstar", "spam", "viagra", "warez", "xxx")
SOFT = ("ads", "adserver", "affiliate", "banner", "bet", "bets", "betting", "bonus", "cheap", "cialis", "cracked", "dating",
        "farm", "free", "gambling", "jackpot", "keygen", "loans", "nude", "nulled", "payday", "pharma", "pills", "poker",
        "popup", "replica", "sex", "slots", "torrent", "track", "tracker", "tracking", "win", "winner")
VOCABULARY: dict[str, int] = {**dict.fromkeys(STRICT, LIMIT), **dict.fromkeys(SOFT, 1)}


def automaton(terms: list[str]):
    import ahocorasick

    built = ahocorasick.Automaton()
    for term in terms:
        built.add_word(term, term)
    built.make_automaton()
    return built


def hits(url: str | None, built) -> list[str]:
    """Distinct vocabulary terms of one lower-cased URL that stand between boundaries, sorted."""
    if not url:
        return []
    edge = lambda at: not 0 <= at < len(url) or re.match("[0-9a-z]", url[at]) is None
    return sorted({term for end, term in built.iter(url) if edge(end + 1) and edge(end - len(term))})


def vocabulary_hits(url: Column, vocabulary: dict[str, int]) -> Column:
    """Array of the distinct terms found."""
    terms = sorted(vocabulary)

    @F.pandas_udf("array<string>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        built = automaton(terms)
        for batch in batches:
            yield batch.map(lambda u: hits(u, built))

    return found(url)


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """Longest fitting rule and its verdict, both null when none fits."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, said in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, start = rule[: rule.index("/")], rule[rule.index("/"):]
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(start)
        found, verdict = F.when(fits, rule).otherwise(found), F.when(fits, said).otherwise(verdict)
    return found, verdict


def judge(pages: DataFrame, rules: list[tuple[str, str]], vocabulary: dict[str, int] = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """Every row as ``_row`` with host, path, rule, verdict and the vocabulary's findings."""
    url = F.col("url").cast("string")
    told = pages.select(packed(pages).alias("_row"), host_of(url).alias("host"), path_of(url).alias("path"),
                        vocabulary_hits(lower_ascii(url), vocabulary).alias("terms"))
    weight = F.create_map(*[F.lit(x) for pair in sorted(vocabulary.items()) for x in pair])
    score = F.aggregate("terms", F.lit(0), lambda total, term: total + weight[term])
    strict = F.size(F.filter("terms", lambda term: weight[term] >= limit))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(score >= limit, "block").otherwise("allow")
    return told.select("_row", "host", "path", rule.alias("rule"), F.coalesce(said, own).alias("verdict"), "terms",
                       strict.cast("bigint").alias("n_strict"), (F.size("terms") - strict).cast("bigint").alias("n_soft"))
