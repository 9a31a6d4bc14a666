"""Queries of the study: grid, resume, conditions, breakdowns, import, incremental scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkprint import constants as K
from inkprint.functions import text as tx
from inkprint.functions.scorer import batch_scorer, labelled
from inkprint.operators import scores, study, windows
from inkprint.operators.encode import generator_label
from inkprint.operators.linear import top_label
from inkprint.plans import fixtures as fx
from inkprint.plans.registry import query, r6, rounded
from inkprint.plans.sql import WORD, WS, lst, mapping, quoted, with_parts
from inkprint.session import fresh_path
from inkprint.sources import study_json
from inkprint.streaming.incremental import append_missing, score_stream

_GRID_MODELS = list(K.GENERATOR_LABELS)


@query("study_grid", f"""
  SELECT doc_id AS prompt_index, source AS task, CAST(repetition AS INTEGER) AS repetition, model,
    'p' || (doc_id + 1) || '_r' || repetition || '_' || (doc_id * {2 * len(_GRID_MODELS)} + (repetition - 1) * {len(_GRID_MODELS)} + m + 1) AS sample,
    'pending' AS generation_status
  FROM documents, (VALUES (1), (2)) r(repetition),
    (VALUES {', '.join(f"({i}, '{m}')" for i, m in enumerate(_GRID_MODELS))}) x(m, model)""")
def study_grid(spark, sf):
    prompts = fx.table(spark, sf, "documents").select(
        F.col("doc_id").alias("prompt_index"), F.col("source").alias("task")
    )
    return study.study_grid(prompts, _GRID_MODELS)


@query("study_runs", """
  WITH states AS (SELECT doc_id // 50 AS run, doc_id % 50 AS version, ['running', 'paused', 'completed'][doc_id % 3 + 1] AS status
    FROM documents WHERE doc_id % 17 <> 3 AND doc_id % 19 <> 4),
  latest AS (SELECT run, max_by(status, version) AS status FROM states GROUP BY run)
  SELECT md5('run' || run) AS id, CASE WHEN status = 'running' AND run % 4 <> 0 THEN 'interrupted' ELSE status END AS status,
    printf('2025-01-%02dT00:00:00+00:00', run % 28 + 1) AS created_at FROM latest""")
def study_runs(spark, sf):
    """Each document is a saved state of the run of its fifty; one in seventeen has no run id, one in nineteen no status."""
    i = F.col("doc_id")
    run, version = F.floor(i / 50), i % 50
    run_id = F.md5(F.concat(F.lit("run"), run.cast("string")).cast("binary"))
    stamp = lambda minute: F.format_string("2025-01-%02dT00:%02d:00+00:00", run % 28 + 1, minute)
    states = fx.table(spark, sf, "documents").select(
        F.when(i % 17 == 3, "draft").otherwise(run_id).alias("id"), version.alias("version"),
        F.when(i % 19 != 4, F.element_at(F.array(*[F.lit(s) for s in ("running", "paused", "completed")]), (i % 3 + 1).cast("int"))).alias("status"),
        stamp(F.lit(0)).alias("created_at"), stamp(version).alias("updated_at"))
    log = fresh_path(spark, "study_log")
    for half in ("version >= 25", "version < 25"):  # the log is not in the order of the versions
        study.append_states(states.where(half), log)
    active = fx.table(spark, sf, "documents").where(run % 4 == 0).select(run_id.alias("id"))
    return study.study_runs(spark.read.parquet(log), active)


@query("study_report", with_parts(["judged"], """
  SELECT analysis_mode, classifier, comments_removed, CASE WHEN grouping(model) = 0 THEN 'generator' WHEN grouping(task) = 0 THEN 'task'
      WHEN grouping(expected) = 0 THEN 'true' ELSE 'condition' END AS level,
    coalesce(model, task, expected) AS name, predicted_label, count(*) AS n, count_if(matches) AS matches
  FROM judged WHERE good GROUP BY GROUPING SETS ((analysis_mode, classifier, comments_removed, predicted_label),
    (analysis_mode, classifier, comments_removed, predicted_label, model), (analysis_mode, classifier, comments_removed, predicted_label, task),
    (analysis_mode, classifier, comments_removed, predicted_label, expected))
  HAVING grouping(expected) = 1 OR expected IS NOT NULL"""))
def study_report(spark, sf):
    return study.study_report(fx.analyses(spark, sf))


def _cells(name: str) -> str:
    return f"sample, classifier, comments_removed, {name} AS analysis_mode"


@query("pending_analyses", with_parts(["cells", "judged"], f"""
  SELECT {_cells('analysis_mode')} FROM cells EXCEPT SELECT {_cells('analysis_mode')} FROM judged"""))
def pending_analyses(spark, sf):
    samples = fx.samples(spark, sf).select("sample", "generation_status")
    return study.pending_analyses(samples, fx.analyses(spark, sf)).select(*study.CELL)


@query("resume_status", with_parts(["samples"], """
  SELECT sample, CASE generation_status WHEN 'in_progress' THEN 'uncertain' ELSE generation_status END AS resumed_status,
    CASE WHEN generation_status = 'in_progress' THEN 'Interrupted request; may have been billed. Not automatically repeated.' END AS resume_note,
    generation_status = 'pending' AS to_process,
    CASE WHEN row_id % 4 = 0 AND row_id % 3 <> 0 THEN 'interrupted' WHEN row_id % 4 = 0 THEN 'running' ELSE 'completed' END AS status
  FROM samples"""))
def resume_status(spark, sf):
    resumed = study.resume_status(fx.samples(spark, sf))
    saved = F.when(F.col("row_id") % 4 == 0, "running").otherwise("completed")
    return resumed.select("sample", "resumed_status", "resume_note", "to_process",
                          study.study_status(saved, F.col("row_id") % 3 == 0).alias("status"))


_CELLS_SQL = """(VALUES ('050'), ('100')) c(classifier), (VALUES (false), (true)) r(comments_removed),
    (SELECT DISTINCT analysis_mode FROM judged) m"""


@query("study_conditions", with_parts(["judged"], f"""
  SELECT m.analysis_mode, c.classifier, r.comments_removed, coalesce(count_if(good), 0) AS n, coalesce(count_if(NOT good), 0) AS errors,
    coalesce(count_if(good AND expected IS NOT NULL AND NOT is_newer), 0) AS id_n,
    coalesce(count_if(good AND expected IS NOT NULL AND NOT is_newer AND matches), 0) AS id_matches,
    coalesce(count_if(good AND is_newer), 0) AS gemini_n, coalesce(count_if(good AND is_newer AND matches), 0) AS gemini_matches,
    coalesce(count_if(good AND predicted_label = '{K.GPT_LABEL}'), 0) AS gpt_predictions,
    coalesce(count_if(good AND coalesce(truncated, false)), 0) AS truncated
  FROM {_CELLS_SQL} LEFT JOIN (SELECT * FROM judged WHERE NOT (classifier = '050' AND comments_removed)) j
    ON j.analysis_mode = m.analysis_mode AND j.classifier = c.classifier AND j.comments_removed = r.comments_removed
  GROUP BY ALL"""))
def study_conditions(spark, sf):
    """One condition has no analyses at all; it is listed with zeros."""
    return study.study_conditions(fx.analyses(spark, sf).where("not (classifier = '050' and comments_removed)"))


#: A task and a generator whose generations all failed: they have samples and no analyses.
_FAILED = {"task": fx.TASKS[0], "model": fx.STUDY_MODELS[1]}


def _breakdown_sql(column: str) -> str:
    return with_parts(["judged", "samples"], f"""
      SELECT m.analysis_mode, c.classifier, r.comments_removed, g.{column},
        coalesce(count_if(j.good), 0) AS n, coalesce(count_if(j.good AND j.matches), 0) AS matches
      FROM (SELECT DISTINCT {column} FROM samples) g, {_CELLS_SQL}
      LEFT JOIN (SELECT * FROM judged WHERE {column} NOT IN ('{_FAILED["task"]}', '{_FAILED["model"]}')) j
        ON j.analysis_mode = m.analysis_mode AND j.classifier = c.classifier AND j.comments_removed = r.comments_removed
          AND j.{column} = g.{column} GROUP BY ALL""")


def _breakdown(spark, sf, column):
    analyses = fx.analyses(spark, sf)
    return study.study_breakdown(analyses.where(F.col(column) != _FAILED[column]), column, fx.samples(spark, sf))


@query("study_by_model", _breakdown_sql("model"))
def study_by_model(spark, sf):
    return _breakdown(spark, sf, "model")


@query("study_by_task", _breakdown_sql("task"))
def study_by_task(spark, sf):
    return _breakdown(spark, sf, "task")


@query("study_progress", with_parts(["samples", "analyses"], """
  SELECT task, count(*) AS samples, count_if(generation_status = 'completed') AS generated,
    count_if(generation_status IN ('failed', 'uncertain')) AS generation_failures,
    count_if(finish_reason = 'length') AS generation_output_limits,
    CAST(sum(coalesce(k, 0)) AS BIGINT) AS classifications,
    count_if(generation_status = 'completed') * 8 AS expected_classifications
  FROM samples LEFT JOIN (SELECT sample, count(*) AS k FROM analyses GROUP BY sample) USING (sample) GROUP BY task"""))
def study_progress(spark, sf):
    per_sample = fx.analyses(spark, sf).groupBy("sample").agg(F.count("*").alias("analysed"))
    joined = fx.samples(spark, sf).drop("code").join(per_sample, "sample", "left").na.fill(0, ["analysed"])
    return study.study_progress(joined, by=["task"])


@query("paired_modes", with_parts(["judged"], """
  SELECT sample, classifier, comments_removed, a.predicted_label AS first512_label, b.predicted_label AS chunks_label,
    a.used_tokens AS first512_tokens, b.used_tokens AS chunks_tokens, a.predicted_label = b.predicted_label AS same_label
  FROM judged a JOIN judged b USING (sample, classifier, comments_removed)
  WHERE a.analysis_mode = 'first512' AND b.analysis_mode = 'chunks' AND a.good AND b.good"""))
def paired_modes(spark, sf):
    a = fx.analyses(spark, sf).withColumn("analysis_mode", study.mode_or_default(F.col("analysis_mode")))
    return study.paired_modes(a)


@query("coverage_matrix", with_parts(["judged"], """
  SELECT analysis_mode, classifier, comments_removed, count_if(chunk_count > 1) AS multichunk,
    count_if(model NOT LIKE 'google/%' AND predicted_label = split_part(model, '/', 2)) AS id_matches,
    count_if(model NOT LIKE 'google/%') AS comparable_n,
    count_if(model LIKE 'google/%' AND predicted_label LIKE 'gemini%') AS gemini_matches,
    count_if(predicted_label = '""" + K.GPT_LABEL + """') AS gpt_predictions, """ + ", ".join(
    f"count_if(model = '{m}' AND predicted_label = split_part(model, '/', 2)) AS \"{m}\"" for m in _GRID_MODELS)
    + " FROM judged WHERE good GROUP BY ALL"))
def coverage_matrix(spark, sf):
    a = fx.analyses(spark, sf).where("error is null").withColumn("analysis_mode", study.mode_or_default(F.col("analysis_mode")))
    return study.coverage_matrix(a, _GRID_MODELS)


def _records(spark, sf):
    heldout = (F.col("row_id") % 9 == 0) & generator_label(F.col("model")).isNotNull()
    return fx.analyses(spark, sf).select(
        "sample", "classifier", "comments_removed",
        study.mode_or_default(F.col("analysis_mode")).alias("analysis_mode"),
        F.col("model").alias("requested_model"), "returned_model",
        F.when(heldout, "heldout_benchmark").alias("source"),
        F.when(heldout, generator_label(F.col("model"))).alias("actual_label"),
        "predicted_label", "error", "chunk_count", "truncated", "finish_reason",
    )


@query("match_category", with_parts(["judged"], f"""
  SELECT sample, classifier, comments_removed, analysis_mode, exact AS exact_reference,
    CASE WHEN error IS NOT NULL THEN 'Not assessed' WHEN exact AND matches THEN 'Match' WHEN exact THEN 'Mismatch'
      WHEN expected IS NULL THEN 'Not comparable' WHEN matches THEN 'Family match only' ELSE 'Different label' END AS match,
    coalesce(error, concat_ws('; ', CASE WHEN analysis_mode = 'chunks' THEN chunk_count || ' chunks; averaged scores' END,
      CASE WHEN truncated THEN 'Truncated at 512 tokens' END,
      CASE WHEN finish_reason = 'length' THEN 'Generation hit output limit' END,
      CASE WHEN NOT exact THEN 'Different version / unverified ID' END)) AS notes
  FROM (SELECT *, expected IS NOT NULL AND (row_id % 9 = 0 OR (NOT is_newer AND (returned_model = model
      OR (model = 'openai/gpt-4.1' AND regexp_matches(returned_model, '{K.DATED_ALIAS[1]}'))
      OR (model = 'deepseek/deepseek-chat' AND returned_model = 'deepseek/deepseek-chat-v3')))) AS exact FROM judged)"""))
def match_category(spark, sf):
    return study.match_category(_records(spark, sf)).select(*study.CELL, "exact_reference", "match", "notes")


# --- nested state and import ------------------------------------------------------

_GROUP = 50  # samples per saved study, far below the 1,000 a state may hold


def _studies(spark, sf):
    """Saved study states as JSON text, built from samples and analyses."""
    a = fx.analyses(spark, sf)
    fields = ["classifier", "comments_removed", "analysis_mode", "chunk_count", "predicted_label", "top_score",
              "gpt_score", "input_tokens", "used_tokens", "truncated", "error"]
    # At most eight cells per sample and fifty samples per study.
    per_sample = a.groupBy("sample").agg(F.collect_list(F.struct(*fields)).alias("analyses"))
    s = fx.samples(spark, sf).join(per_sample, "sample", "left")
    one = F.struct(
        F.col("sample").alias("id"), "task", "prompt", "repetition", "model", "generation_status",
        F.struct(F.col("model").alias("requested_model"), "returned_model", "provider", "finish_reason").alias("generation"),
        F.coalesce("analyses", F.array()).alias("analyses"), F.lit("dropped").alias("unlisted_field"),
    )
    states = s.groupBy(F.floor(F.col("row_id") / _GROUP).alias("study")).agg(F.collect_list(one).alias("samples"))
    return states.select(F.to_json(F.struct(
        F.col("study").cast("string").alias("id"), F.lit("completed").alias("status"), "samples"
    )).alias("value"))


@query("study_flatten", with_parts(["judged"], f"""
  SELECT sample, task, repetition, model AS requested_model, returned_model, provider, classifier, comments_removed,
    analysis_mode, chunk_count, predicted_label, {r6('top_score', 'gpt_score')}, input_tokens, used_tokens, truncated, error
  FROM judged"""))
def study_flatten(spark, sf):
    return rounded(study_json.flatten_study(study_json.parse_studies(_studies(spark, sf))), "top_score", "gpt_score")


@query("import_validate", with_parts(["samples"], f"""
  SELECT batch, CAST(rn - 1 AS INTEGER) AS position, requested_model, length(code) AS code_chars,
    CASE WHEN k > {K.MAX_IMPORT_RECORDS} THEN 'record count' WHEN length(code) > {K.MAX_CODE_CHARS} THEN 'code too long' END AS problem
  FROM (SELECT batch, model AS requested_model, CASE WHEN row_id % 23 = 0 THEN repeat(code, 40) ELSE code END AS code,
      row_number() OVER (PARTITION BY batch ORDER BY row_id) AS rn, count(*) OVER (PARTITION BY batch) AS k
    FROM (SELECT *, row_id // CASE WHEN row_id % 300 < 120 THEN 300 ELSE 40 END * 2 + CASE WHEN row_id % 300 < 120 THEN 1 ELSE 0 END AS batch FROM samples))"""))
def import_validate(spark, sf):
    i = F.col("row_id")
    big = i % 300 < 120
    batch = (F.floor(i / F.when(big, 300).otherwise(40)) * 2 + F.when(big, 1).otherwise(0)).cast("bigint")
    s = fx.samples(spark, sf).select(
        "row_id", batch.alias("batch"), F.col("model").alias("requested_model"),
        F.when(i % 23 == 0, F.repeat("code", F.lit(40))).otherwise(F.col("code")).alias("code"),
        F.lit("not for storage").alias("api_key"),
    )
    # Uploads hold at most 120 records by construction.
    uploads = s.groupBy("batch").agg(
        F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("row_id", "requested_model", "code", "api_key"))),
                              lambda r: r.dropFields("row_id"))).alias("value")
    )
    rows = study_json.import_records(uploads, keep=["batch"])
    return rows.select("batch", "position", "requested_model", F.length("code").cast("bigint").alias("code_chars"), "problem")


# --- scoring ------------------------------------------------------------------------

_MARKS = {"de": "ch", "en": "th", "es": "os", "fr": "ou"}


def _load_marks():
    """A deterministic scorer: share of each label's letter pair."""
    import numpy as np

    marks = ["ch", "th", "os", "ou"]

    def score(texts):
        if any("/x/fr" in t for t in texts):
            raise LookupError("no scores for this text")
        counts = np.array([[t.count(m) for m in marks] for t in texts], dtype=float) + 1
        return counts / counts.sum(axis=1, keepdims=True)

    return score


_MARK_COUNTS = [f"(1 + (length(code) - length(replace(code, '{m}', ''))) / 2)" for m in _MARKS.values()]
_MARK_SQL = ", ".join(
    f"{c} / ({' + '.join(_MARK_COUNTS)}) AS {x}" for x, c in zip(_MARKS, _MARK_COUNTS))


@query("batch_score_udf", with_parts(["programs"], "SELECT row_id, CASE WHEN bad THEN 'LookupError' END AS error, "
  + ", ".join(f"CASE WHEN NOT bad THEN round({x}, 6) END AS {x}" for x in _MARKS)
  + f" FROM (SELECT row_id, contains(code, '/x/fr') AS bad, {_MARK_SQL} FROM programs)"))
def batch_score_udf(spark, sf):
    """The scorer throws on some texts; those rows carry the error."""
    scored = fx.programs(spark, sf).withColumn("s", batch_scorer(_load_marks)(F.col("code")))
    return scored.select("row_id", "s.error", *[F.round(F.get("s.scores", F.lit(k)), 6).alias(x) for k, x in enumerate(_MARKS)])


def _mark_texts(samples):
    """The label of a sample's text under every comment setting and coverage, as a column each; classifiers share it."""
    rows = samples
    for removed in (False, True):
        code = tx.strip_comments(F.col("code")) if removed else F.col("code")
        pieces = rows.withColumn("tokens", tx.pieces(code))
        cut = windows.truncate_first(pieces.withColumn("kept", F.col("tokens")), "kept")
        for mode, tokens in (("first512", "kept"), ("chunks", "tokens")):
            cut = cut.withColumn("text", F.array_join(tokens, " "))
            marks = [F.struct(F.lit(x).alias("label"), (F.length("text") - F.length(F.replace("text", F.lit(m), F.lit("")))).alias("score"))
                     for x, m in _MARKS.items()]
            cut = cut.withColumn(_mark_column(removed, mode), top_label(F.array(*marks)))
        rows = cut.select(*rows.columns, *[_mark_column(removed, mode) for mode in K.MODES])
    return rows


def _mark_column(removed, mode):
    return f"{'stripped' if removed else 'original'}_{mode}"


def _mark_scorer(cells):
    """Native scorer of study cells: the label of the cell's text, errors as rows."""
    found = F.coalesce(*[F.when((F.col("comments_removed") == removed) & (F.col("analysis_mode") == mode), F.col(_mark_column(removed, mode)))
                         for removed in (False, True) for mode in K.MODES])
    failed = F.col("model") == fx.UNKNOWN_MODEL
    return cells.select(
        *study.CELL, F.when(~failed, found).alias("predicted_label"),
        F.when(failed, "unsupported model").alias("error"),
    )


_SCORED = with_parts(["stripped", "cells"], """
  SELECT sample, classifier, comments_removed, analysis_mode,
    CASE WHEN model <> 'vendor/unlisted-model' THEN list_extract(['de', 'en', 'es', 'fr'], list_position(counts, list_max(counts))) END AS predicted_label,
    CASE WHEN model = 'vendor/unlisted-model' THEN 'unsupported model' END AS error
  FROM (SELECT *, [""" + ", ".join(f"length(t) - length(replace(t, '{m}', ''))" for m in _MARKS.values()) + """] AS counts
    FROM (SELECT c.* EXCLUDE (code), array_to_string(CASE WHEN analysis_mode = 'first512'
          THEN list_slice(regexp_extract_all(src, '""" + f"[{WORD}]+|[^{WORD}{WS}]" + """'), 1, 509)
          ELSE regexp_extract_all(src, '""" + f"[{WORD}]+|[^{WORD}{WS}]" + """') END, ' ') AS t
      FROM (SELECT c.*, CASE WHEN comments_removed THEN stripped_code ELSE s.code END AS src
        FROM cells c JOIN stripped s USING (row_id)) c))""")


@query("incremental_scoring", _SCORED)
def incremental_scoring(spark, sf):
    """Half of the samples are scored first; a stream then delivers all of them,
    twice, and only missing cells are added."""
    samples, results = fx.samples(spark, sf), fresh_path(spark, "scored")
    inbox, checkpoint = fresh_path(spark, "inbox"), fresh_path(spark, "progress")
    append_missing(samples.where("row_id % 2 = 0"), _mark_scorer, results, "first", ["row_id"], _mark_texts)
    samples.write.parquet(inbox)
    stream = spark.readStream.schema(samples.schema).parquet(inbox)
    first = f"{results}/batch=first"
    known = spark.readStream.schema(spark.read.parquet(first).select(*study.CELL).schema).parquet(first)
    score_stream(stream, _mark_scorer, results, checkpoint, "a", ["row_id"], known, _mark_texts)
    samples.write.mode("append").parquet(inbox)
    score_stream(stream, _mark_scorer, results, checkpoint, "a", ["row_id"], known, _mark_texts)
    return spark.read.parquet(results).select(*study.CELL, "predicted_label", "error")
