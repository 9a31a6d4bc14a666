"""Personal data: patterns for entities, and information-theoretic sanitisation of what reveals them.

Protected entities are e-mail addresses, IP addresses, card and phone numbers found by pattern. The other words of
the texts that hold an entity may reveal it even when it is masked. From the whole corpus we count in how many
documents an entity e occurs, a term t occurs, and both occur, t anywhere outside the entities. The share of
e's information that t discloses is ``PMI(e; t) / IC(e)``, with ``IC(e) = -log p(e)``: 1 when t occurs with
e only, 0 when they are independent. Terms at or above ``DISCLOSURE`` for some entity are sensitive in the texts
that hold it; a pair must be seen in ``SUPPORT`` different texts, so that copies of one text are no evidence. The
disclosure of a rare entity stays high for a term that mostly stands elsewhere, and two variants of one text share all
their rare words. So a term is sensitive in texts without the entity only on more evidence: ``SUPPORT_ELSEWHERE``
different texts, and at least ``SHARE_ELSEWHERE`` of the rows with the term hold the entity. Terms that disclose everything
(``REMOVE``) are removed, others are generalised to a placeholder, as entities are to their kind.

Null text counts as empty and has no spans. Results depend on the text alone, so repeated rows and null ids
need no care. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from inkprint.functions.shipping import ship_with_job
from inkprint.llm.words import let, packed, text_of, unpacked
from inkprint.session import materialize

ship_with_job(__name__)

KINDS = ("email", "ip", "card", "phone")
SUPPORT = 2
SUPPORT_ELSEWHERE = 3
SHARE_ELSEWHERE = 0.5
DISCLOSURE = 0.8
REMOVE = 0.999
#: Rows, and bytes of terms, that may be broadcast after they have been counted.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 << 20

# Fixed values of the contract; the guards before digits only stop retries that cannot match.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = regex.compile(r"\p{L}{3,}")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the entities of one text, in that order."""
    found = [(a, 0, b) for a, b in _emails(text)]
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = re.sub("[^0-9]", "", m[0])
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(found)


def entities(text: str, spans: list[tuple[int, int, int]]) -> list[str]:
    """The distinct entities of a text, their values hashed."""
    out = set()
    for start, kind, end in spans:
        value = text[start:end].lower() if kind == 0 else re.sub("[^0-9.]" if kind == 1 else "[^0-9]", "", text[start:end])
        out.add(hashlib.sha256(f"{KINDS[kind]}:{value}".encode("utf-8", "replace")).hexdigest())
    return sorted(out)


def terms(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int]]:
    """(term, start, end) of all terms that touch no entity, in order; ``spans`` are sorted."""
    at, covered = 0, 0
    for m in _TERM.finditer(text):
        a, b = m.span()
        while at < len(spans) and spans[at][0] < b:
            covered = max(covered, spans[at][2])
            at += 1
        if covered <= a:
            yield m[0].lower(), a, b


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int64()), ("end", pa.int64())])
_SPANS = "array<struct<start:bigint,kind:bigint,end:bigint>>"


def _dicts(spans: list[tuple[int, int, int]]) -> list[dict]:
    return [dict(zip(("start", "kind", "end"), s)) for s in spans]


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            keys, named, said = [], [], []
            for key, text in zip(part.column("_key").to_pylist(), part.column("_text").to_pylist()):
                if spans := base_spans(text):
                    keys.append(key)
                    named.append(entities(text, spans))
                    said.append(sorted({t for t, _, _ in terms(text, spans)}))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(named, pa.list_(pa.string())), pa.array(said, pa.list_(pa.string()))],
                                             names=["_key", "_entities", "_terms"])


def _text_key() -> Column:
    return F.md5(text_of("text")).alias("_key")


def found(docs: DataFrame) -> DataFrame:
    """``_key`` of every text that holds entities, the entities and all terms beside them, once for each row."""
    told = docs.select(_text_key(), text_of("text").alias("_text"))
    return told.mapInArrow(_find, "_key string, _entities array<string>, _terms array<string>")


def _terms(text: Column) -> Column:
    return F.array_distinct(F.transform(F.split(text, r"\P{L}+"), F.lower))


def disclosing(docs: DataFrame, seen: DataFrame) -> DataFrame:
    """(entity, term, disclosure, everywhere) of the terms that reveal an entity. ``seen`` holds the texts with entities."""
    spark = docs.sparkSession
    copies = seen.groupBy("_key").agg(F.count("*").alias("copies"), F.first("_entities").alias("_entities"), F.first("_terms").alias("_terms"))
    texts = materialize(copies, "texts")
    each = texts.select("_key", "copies", F.explode("_entities").alias("entity"))
    # No term of an entity in fewer texts has the support, so its pairs need not be made.
    by_entity = each.groupBy("entity").agg(F.count("*").alias("n_texts"), F.sum("copies").alias("n_e")).where(F.col("n_texts") >= SUPPORT)
    by_entity = _checked(by_entity.select("entity", "n_e"))
    shared = each.join(by_entity, "entity", "left_semi").groupBy("_key").agg(F.collect_list("entity").alias("shared"))
    both = texts.join(shared, "_key").select("copies", "_terms", F.explode("shared").alias("entity")).select("copies", "entity", F.explode("_terms").alias("term"))
    pairs = both.groupBy("entity", "term").agg(F.count("*").alias("support"), F.sum("copies").alias("n_et")).where(F.col("support") >= SUPPORT)
    pairs = materialize(pairs.join(by_entity, "entity"), "pairs")
    n_docs = docs.count()
    candidates = materialize(pairs.select("term").distinct(), "terms")
    n_terms = candidates.count()
    if n_terms == 0:
        return spark.createDataFrame([], "entity string, term string, disclosure double, everywhere boolean")
    words = docs.select(F.explode(_terms(text_of("text"))).alias("term"))
    if n_terms <= BROADCAST_ROWS:
        words = words.join(F.broadcast(candidates), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n_t"))
    else:
        words = words.groupBy("term").agg(F.count("*").alias("n_t")).join(candidates, "term", "left_semi")
    told = pairs.join(words, "term", "left")
    n_t = F.greatest(F.coalesce("n_t", F.lit(0)), "n_et")
    pmi = F.log(F.col("n_et") * float(n_docs) / (F.col("n_e") * n_t))
    ic = F.log(F.lit(float(n_docs)) / F.col("n_e"))
    everywhere = (F.col("support") >= SUPPORT_ELSEWHERE) & (F.col("n_et") >= SHARE_ELSEWHERE * n_t)
    scored = told.select("entity", "term", F.when(ic > 0, pmi / ic).otherwise(0.0).alias("disclosure"), everywhere.alias("everywhere"))
    return scored.where(F.col("disclosure") >= DISCLOSURE)


def _checked(small: DataFrame) -> DataFrame:
    stored = materialize(small, "small")
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def marked(rows: DataFrame, known: Broadcast | None, near: Broadcast | None) -> DataFrame:
    """``rows`` without ``_text`` and ``_hits``, with ``_base`` and ``_spans`` in order of start and kind.

    ``known`` has the kind of every term that is sensitive everywhere, ``near`` those of each entity; what is too large
    for them each row brings in ``_hits``.
    """
    brought = "_hits" in rows.columns

    def sensitive(text: str, spans: list[tuple[int, int, int]], own: list[dict] | None) -> list[dict[str, int]]:
        sets = [known.value] if known else []
        if own:
            sets.append({h["term"]: h["kind"] for h in own})
        if near and spans:
            sets += [near.value[e] for e in entities(text, spans) if e in near.value]
        return sets

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                hits = part.column("_hits").to_pylist() if brought else repeat(None)
                base, every = [], []
                for text, own in zip(part.column("_text").to_pylist(), hits):
                    spans = base_spans(text)
                    kinds: dict[str, int] = {}
                    if sets := sensitive(text, spans, own):
                        for t in set(map(str.lower, _TERM.findall(text))):
                            if told := [s[t] for s in sets if t in s]:
                                kinds[t] = max(told)
                    more = [(a, kinds[t], b) for t, a, b in terms(text, spans) if t in kinds] if kinds else []
                    base.append(_dicts(spans))
                    every.append(_dicts(sorted(spans + more)))
                kept = [i for i, name in enumerate(part.schema.names) if name not in ("_text", "_hits")]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in kept], pa.array(base, pa.list_(_SPAN)), pa.array(every, pa.list_(_SPAN))],
                    names=[*[part.schema.names[i] for i in kept], "_base", "_spans"])

    carried = [f for f in rows.schema if f.name not in ("_text", "_hits")]
    return rows.mapInArrow(mark, StructType(carried + StructType.fromDDL(f"_base {_SPANS}, _spans {_SPANS}").fields))


def _fits(stored: DataFrame) -> bool:
    n, n_bytes = stored.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term") + F.lit(64)), F.lit(0))).first()
    return n <= BROADCAST_ROWS and n_bytes <= BROADCAST_BYTES


def all_spans(docs: DataFrame, carry: list[Column]) -> DataFrame:
    """The carried columns with ``_base`` and ``_spans``, both in order of start and kind."""
    context = docs.sparkSession.sparkContext
    seen = materialize(found(docs), "entities")
    told = materialize(disclosing(docs, seen), "disclosing")
    kind = F.when(F.max("disclosure") >= REMOVE, len(KINDS) + 1).otherwise(len(KINDS)).cast("bigint").alias("kind")
    flagged = materialize(told.where("everywhere").groupBy("term").agg(kind), "everywhere")
    beside = materialize(told.where("not everywhere").groupBy("entity", "term").agg(kind), "beside")
    known = near = None
    hits = []
    if _fits(flagged):
        known = context.broadcast({r.term: r.kind for r in flagged.collect()})
    else:
        hits.append(docs.select(_text_key(), F.explode(_terms(text_of("text"))).alias("term")).join(flagged, "term").select("_key", "term", "kind"))
    if _fits(beside):
        of: dict[str, dict[str, int]] = {}
        for r in beside.collect():
            of.setdefault(r.entity, {})[r.term] = r.kind
        near = context.broadcast(of)
    else:
        held = seen.select("_key", F.explode("_entities").alias("entity")).distinct()
        hits.append(held.join(beside, "entity").select("_key", "term", "kind"))
    if not hits:
        return marked(docs.select(*carry, text_of("text").alias("_text")), known, near)
    both = hits[0] if len(hits) == 1 else hits[0].unionByName(hits[1])
    own = both.groupBy("_key", "term").agg(F.max("kind").alias("kind")).groupBy("_key").agg(F.collect_list(F.struct("term", "kind")).alias("_hits"))
    return marked(docs.select(*carry, _text_key(), text_of("text").alias("_text")).join(own, "_key", "left"), known, near).drop("_key")


def _joined(spans: str, names: list[str]) -> Column:
    kinds = F.array(*[F.lit(n) for n in names])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"].cast("int")], s["start"].cast("string"), s["end"].cast("string"))), ",")


NAMES = [*KINDS, "term", "term"]


def report(docs: DataFrame) -> DataFrame:
    """Counts and spans of every row, by ``doc_id``."""
    rows = all_spans(docs.select("doc_id", "text"), [F.col("doc_id")])
    of_kind = lambda k: F.size(F.filter("_base", lambda s: s["kind"] == k)).cast("bigint")
    counts = [of_kind(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(_joined("_base", NAMES), 256).alias("base_sha256"), _joined("_spans", NAMES).alias("spans"),
                       F.size(F.filter("_spans", lambda s: s["kind"] >= len(KINDS))).cast("bigint").alias("n_term"))


def _masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced; spans that overlap a span before them are merged into it."""
    put = F.array(*[F.lit(f"<{k}>") for k in KINDS], F.lit("<term>"), F.lit(""))

    def step(state: Column, s: Column) -> Column:
        covered = s["start"] < state["at"]
        gap = F.substring(text, (state["at"] + 1).cast("int"), F.greatest(s["start"] - state["at"], F.lit(0)).cast("int"))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"),
                        F.when(covered, state["out"]).otherwise(F.concat(state["out"], F.array(gap, put[s["kind"].cast("int")]))).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))
    return let(F.aggregate(spans, start, step), lambda end: F.concat(
        F.array_join(end["out"], ""), F.substring(text, (end["at"] + 1).cast("int"), F.length(text))))


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with entities and disclosing terms replaced; ``n_chars``, where present, follows the new text."""
    rows = all_spans(docs, [packed(docs).alias("_row")])
    text = F.col("_row.`text`")
    put = F.when(F.size("_spans") > 0, _masked(F.coalesce(text, F.lit("")), F.col("_spans"))).otherwise(text)
    out = unpacked(rows.select("_row", put.alias("_new"), (F.size("_spans") > 0).alias("_hit")), docs.columns, F.col("_new"), F.col("_hit"))
    changed = {"text": F.col("_new")} | ({"n_chars": F.when(F.col("_hit"), F.length("_new").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))} if "n_chars" in docs.columns else {})
    return out.withColumns(changed).select(*[F.col(f"`{c}`") for c in docs.columns])
