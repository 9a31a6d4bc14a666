"""The same views for the DuckDB side of the checks, as named WITH parts."""

from __future__ import annotations

from inkprint import constants as K
from inkprint.plans import fixtures as fx

# Explicit Unicode classes, as in the Spark expressions.
WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"\p{L}\p{N}_"
CODE_PIECES = r"""(?s)"(?:\\.|[^"\\])*"|''(?:\\.|[^''\\])*''|//[^\n]*(?:\n|\z)|/\*.*?\*/|[^"''/]+|."""


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def lst(values) -> str:
    return f"[{quoted(values)}]"


def mapping(pairs: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in pairs.items()) + "}"


def h32(expr: str) -> str:
    return f"CAST('0x' || substr(sha256({expr}), 1, 8) AS BIGINT)"


def hex2(digest: str, at: int = 1) -> str:
    return f"CAST('0x' || substr({digest}, {at}, 2) AS BIGINT)"


def strip(code: str) -> str:
    spliced = f"replace(replace({code}, chr(92) || chr(13) || chr(10), ''), chr(92) || chr(10), '')"
    return f"""array_to_string(list_transform(regexp_extract_all({spliced}, '{CODE_PIECES}'),
      lambda p: CASE WHEN starts_with(p, '//') OR starts_with(p, '/*')
        THEN ' ' || repeat(chr(10), length(p) - length(replace(p, chr(10), ''))) ELSE p END), '')"""


NEXT = mapping(dict(zip(fx.LANGS, fx.LANGS[1:] + fx.LANGS[:1])))


def _predicted(salt: str, row: str = "row_id", label: str = "label") -> str:
    return (f"CASE WHEN substr(sha256('{salt}' || {row}), 1, 1) IN ('0','1','2','3') "
            f"THEN {NEXT}[{label}] ELSE {label} END")


_MODELS = lst(fx.STUDY_MODELS)
_RAW = {x: f"({hex2(f'''sha256(row_id || '{x}')''')} + 1)" for x in fx.LANGS}
_TOTAL = " + ".join(_RAW.values())

PARTS: dict[str, tuple[list[str], str]] = {
    "programs": ([], """
      SELECT doc_id AS row_id, lang AS label, source AS problem_id, 'write for ' || source AS prompt,
        code, sha256(code) AS source_hash
      FROM (SELECT doc_id, lang, source,
        CASE WHEN doc_id % 40 = 0 THEN '' ELSE '// file ' || source || chr(10) END
        || '#define U ' || chr(34) || 'http://x/' || lang || chr(34) || chr(10)
        || CASE WHEN doc_id % 40 = 0 THEN '' ELSE
             '/* ' || replace(substr(text, 1, 60), '*/', '') || chr(10) || ' */' || chr(10) END
        || text
        || CASE WHEN doc_id % 3 = 0 AND doc_id % 40 <> 0 THEN ' // end ' || lang ELSE '' END AS code
        FROM documents)"""),
    "stripped": (["programs"], f"SELECT *, {strip('code')} AS stripped_code FROM programs"),
    "groups": (["programs"], f"""
      SELECT problem_id, CASE WHEN rn <= floor(n * 0.7) THEN 'train'
          WHEN rn <= floor(n * 0.7) + floor(n * 0.15) THEN 'validation' ELSE 'test' END AS split
      FROM (SELECT problem_id, row_number() OVER (ORDER BY h, problem_id) AS rn, count(*) OVER () AS n
        FROM (SELECT DISTINCT problem_id, {h32('problem_id')} AS h FROM programs))"""),
    "split_programs": (["programs", "groups"], "SELECT p.*, g.split FROM programs p JOIN groups g USING (problem_id)"),
    "split_stripped": (["stripped", "groups"], "SELECT p.*, g.split FROM stripped p JOIN groups g USING (problem_id)"),
    "predictions": (["programs"], f"""
      SELECT row_id, label AS "true", {_predicted('o')} AS predicted, {_predicted('s')} AS predicted_cleaned
      FROM programs"""),
    "ablation_predictions": (["split_programs"], f"""
      SELECT row_id, condition, model, split, label AS "true",
        CASE WHEN {hex2("sha256(condition || least(mi, 2) || row_id)")} < 20 + 30 * least(mi, 2) + 15 * ci
          THEN {NEXT}[label] ELSE label END AS predicted
      FROM split_programs,
        (VALUES (0, 'original'), (1, 'comments_removed'), (2, 'limited_features')) c(ci, condition),
        (VALUES (0, 'm0'), (1, 'm1'), (2, 'm2'), (3, 'm3')) m(mi, model)
      WHERE split <> 'train'"""),
    "wide_scores": (["programs"], "SELECT row_id, label AS \"true\", " + ", ".join(
        f"{v} / ({_TOTAL}) AS prob_{x}" for x, v in _RAW.items()) + " FROM programs"),
    "long_scores": (["wide_scores"], " UNION ALL ".join(
        f"SELECT row_id, \"true\", '{x}' AS label, prob_{x} AS score FROM wide_scores" for x in fx.LANGS)),
    "batches": ([], """
      SELECT user_id % 4 AS run, CAST(extract('day' FROM ts) AS INTEGER) AS epoch, value / 100 AS loss,
        1 + event_id % 16 AS n, event_type FROM events"""),
    "history": (["batches"], """
      SELECT run, epoch, avg(loss) AS training_loss,
        avg(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) AS validation_accuracy,
        avg(CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 0 END) AS validation_macro_f1
      FROM batches GROUP BY run, epoch"""),
    "samples": (["programs"], f"""
      SELECT row_id, 's' || row_id AS sample, {lst(fx.TASKS)}[row_id % 6 + 1] AS task, prompt,
        CAST(row_id % 2 + 1 AS INTEGER) AS repetition, model,
        CASE WHEN row_id % 13 = 0 THEN 'vendor/another-version'
          WHEN model = 'openai/gpt-4.1' AND row_id % 2 = 0 THEN 'openai/gpt-4.1-2025-04-14'
          WHEN model = 'deepseek/deepseek-chat' AND row_id % 2 = 0 THEN 'deepseek/deepseek-chat-v3'
          ELSE model END AS returned_model,
        'provider' || (row_id % 3) AS provider,
        CASE WHEN row_id % 11 = 0 THEN 'length' ELSE 'stop' END AS finish_reason,
        CASE WHEN row_id % 7 = 6 THEN 'failed' WHEN row_id % 7 = 5 THEN 'in_progress'
          WHEN row_id % 7 = 3 AND row_id % 5 = 0 THEN 'pending' ELSE 'completed' END AS generation_status,
        code
      FROM (SELECT *, {_MODELS}[(row_id // 6) % {len(fx.STUDY_MODELS)} + 1] AS model FROM programs)"""),
    "cells": (["samples"], """
      SELECT s.*, c.*, r.*, m.* FROM samples s,
        (VALUES ('050'), ('100')) c(classifier), (VALUES (false), (true)) r(comments_removed),
        (VALUES ('first512'), ('chunks')) m(analysis_mode)
      WHERE generation_status = 'completed'"""),
    "digested": (["cells"], """
      SELECT *, substr(d, 1, 1) AS digit, CAST(length(code) // 4 AS INTEGER) AS tokens FROM (
        SELECT *, sha256(sample || '|' || classifier || '|' || comments_removed || '|' || analysis_mode) AS d
        FROM cells)"""),
    "analyses": (["digested"], f"""
      SELECT sample, row_id, task, repetition, model, returned_model, provider, finish_reason, classifier,
        comments_removed,
        CASE WHEN NOT (analysis_mode = 'first512' AND classifier = '050') THEN analysis_mode END AS analysis_mode,
        CASE WHEN digit <> '2' THEN CAST(CASE WHEN analysis_mode = 'chunks' THEN 1 + tokens // 512 ELSE 1 END AS INTEGER) END AS chunk_count,
        CASE WHEN digit <> '2' THEN CASE WHEN digit >= '8'
          THEN coalesce({mapping(K.GENERATOR_LABELS)}[model], {lst(K.LABELS)}[{hex2('d', 3)} % 5 + 1])
          ELSE {lst(K.LABELS)}[{hex2('d', 3)} % 5 + 1] END END AS predicted_label,
        CASE WHEN digit <> '2' THEN (128 + {hex2('d', 5)} / 2) / 256 END AS top_score,
        CASE WHEN digit <> '2' THEN {hex2('d', 7)} / 512 END AS gpt_score,
        CASE WHEN digit <> '2' THEN tokens END AS input_tokens,
        CASE WHEN digit <> '2' THEN CASE WHEN analysis_mode = 'chunks' THEN tokens ELSE least(tokens, 512) END END AS used_tokens,
        CASE WHEN digit <> '2' THEN analysis_mode = 'first512' AND tokens > 512 END AS truncated,
        CASE WHEN digit = '2' THEN 'ValueError' END AS error
      FROM digested WHERE digit NOT IN ('0', '1')"""),
    "judged": (["analyses"], f"""
      SELECT * REPLACE (coalesce(analysis_mode, 'first512') AS analysis_mode),
        error IS NULL AND predicted_label IN ({quoted(K.LABELS)}) AS good,
        {mapping(K.GENERATOR_LABELS)}[model] AS expected, model = '{K.NEWER_GEMINI}' AS is_newer,
        coalesce(predicted_label = {mapping(K.GENERATOR_LABELS)}[model], false) AS matches
      FROM analyses"""),
    "collapsed": (["split_programs"], f"""
      SELECT row_id, label, split, regexp_replace(code, '[{WS}]{{2,}}', ' ', 'g') AS t FROM split_programs"""),
    # Overlapping 68-character pieces first: substr on a long text walks it from the start.
    "char_pieces": (["collapsed"], """
      SELECT row_id, label, split, substr(t, CAST(o + 1 AS BIGINT), 68) AS piece FROM (
        SELECT *, unnest(generate_series(0, length(t) - 1, 64)) AS o FROM collapsed)"""),
    "char_tf": (["char_pieces"], """
      SELECT row_id, label, split, n, term, count(*) AS tf FROM (
        SELECT row_id, label, split, n, substr(piece, CAST(i AS BIGINT), n) AS term FROM (
          SELECT *, unnest(generate_series(1, least(64, length(piece) - n + 1))) AS i
          FROM char_pieces, (VALUES (3), (4), (5)) s(n)))
      GROUP BY ALL"""),
    "word_tf": (["split_programs"], f"""
      SELECT row_id, label, split, term, count(*) AS tf FROM (
        SELECT row_id, label, split, unnest(regexp_extract_all(lower(code), '[{WORD}]+')) AS term
        FROM split_programs) GROUP BY ALL"""),
}


def idf_parts(source: str, k: int, prefix: str, sublinear: bool, where: str = "split = 'train'") -> list[tuple[str, str]]:
    """vocabulary with idf, raw weights and unit-length weights of a tf part."""
    tf = "1 + ln(tf)" if sublinear else "tf"
    return [
        (f"{prefix}_vocab", f"""
          SELECT term, cf, df, ln((1 + (SELECT count(*) FROM split_programs WHERE {where})) / (1 + df)) + 1 AS idf
          FROM (SELECT term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df FROM {source} WHERE {where} GROUP BY term
            ORDER BY cf DESC, term LIMIT {k})"""),
        (f"{prefix}_raw", f"""
          SELECT row_id, label, split, term, ({tf}) * idf AS w FROM {source} JOIN {prefix}_vocab USING (term)"""),
        (f"{prefix}_weights", f"""
          SELECT r.row_id, label, split, term, w / norm AS weight
          FROM {prefix}_raw r JOIN (SELECT row_id, sqrt(sum(w * w)) AS norm FROM {prefix}_raw GROUP BY row_id) USING (row_id)"""),
    ]


def class_parts(source: str, by: str, prefix: str, labels: list[str] | None = None) -> list[tuple[str, str]]:
    """Per-class scores and the summary row of a predictions part."""
    keys = f"{by}, " if by else ""
    zero = ""
    keep = ""
    if labels is not None:
        groups = f"SELECT DISTINCT {by} FROM {source}" if by else "SELECT 1 AS one"
        zero = (f" UNION ALL SELECT {keys}class, 0, 0, 0 FROM ({groups}), "
                f"(SELECT unnest({lst(labels)}) AS class)")
        keep = f"WHERE class IN ({quoted(labels)})"
    group = f"GROUP BY {keys}class"
    summary_group = f"GROUP BY {by}" if by else ""
    return [
        (f"{prefix}_classes", f"""
          SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1
          FROM (SELECT {keys}class, CAST(sum(support) AS BIGINT) AS support, CAST(sum(tp) AS BIGINT) AS tp,
            CASE WHEN sum(selected) = 0 THEN 0.0 ELSE sum(tp) / sum(selected) END AS precision,
            CASE WHEN sum(support) = 0 THEN 0.0 ELSE sum(tp) / sum(support) END AS recall
          FROM (SELECT {keys}"true" AS class, 1 AS support, 0 AS selected, CAST("true" = predicted AS INTEGER) AS tp FROM {source}
            UNION ALL SELECT {keys}predicted, 0, 1, 0 FROM {source}{zero}) {keep} {group})"""),
        (f"{prefix}_summary", f"""
          SELECT {keys}CAST(sum(support) AS BIGINT) AS n, sum(tp) / sum(support) AS accuracy,
            avg(precision) AS macro_precision, avg(recall) AS macro_recall, avg(f1) AS macro_f1,
            sum(precision * support) / sum(support) AS weighted_precision,
            sum(recall * support) / sum(support) AS weighted_recall,
            sum(f1 * support) / sum(support) AS weighted_f1
          FROM {prefix}_classes {summary_group}"""),
    ]


def with_parts(names: list[str], body: str, extra: list[tuple[str, str]] = ()) -> str:
    """A full statement: the named views with what they need, extra parts, then the body."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in PARTS[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = [(n, PARTS[n][1]) for n in ordered] + list(extra)
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in parts) + "\n" + body
