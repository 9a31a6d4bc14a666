"""Study counts, resume, import, integrity and corpus reading."""

import hashlib
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from inkprint import constants as K
from inkprint.operators import study
from inkprint.operators.linear import top_label
from inkprint.plans import fixtures, study_queries
from inkprint.sources import corpus, manifest, reports, study_json
from inkprint.streaming.incremental import append_missing, score_stream

TASKS = ["sorting", "strings", "gcd", "recursion", "structures", "memory"]


@pytest.fixture(scope="module")
def samples(spark):
    prompts = spark.createDataFrame([(i, t, f"write {t}") for i, t in enumerate(TASKS)], "prompt_index int, task string, prompt string")
    return study.study_grid(prompts, list(K.GENERATOR_LABELS)[:4])


def test_grid_has_48_named_samples(samples):
    rows = samples.collect()
    assert len(rows) == 48 and len({r.sample for r in rows}) == 48
    numbers = sorted(int(r.sample.rsplit("_", 1)[1]) for r in rows)
    assert numbers == list(range(1, 49))
    assert {r.sample for r in rows if r.prompt_index == 0 and r.repetition == 1} == {f"p1_r1_{n}" for n in range(1, 5)}


def scorer(cells):
    failed = F.col("task") == "gcd"
    return cells.select(*study.CELL, "model", F.when(~failed, study.generator_label(F.col("model"))).alias("predicted_label"),
                        F.when(failed, "ValueError").alias("error"), F.lit(False).alias("truncated"))


def test_scoring_resumes_without_repeats(spark, samples, tmp_path):
    done = samples.withColumn("generation_status", F.lit("completed"))
    path = str(tmp_path / "results")
    append_missing(done.where("repetition = 1"), scorer, path, "one")
    assert spark.read.parquet(path).count() == 24 * 8
    append_missing(done, scorer, path, "two")
    append_missing(done, scorer, path, "two")  # a retried batch replaces itself
    append_missing(done, scorer, path, "three")  # nothing is left
    rows = spark.read.parquet(path)
    assert rows.count() == 384 == rows.select(*study.CELL).distinct().count()
    assert {r["count"] for r in rows.groupBy("analysis_mode").count().collect()} == {192}
    conditions = study.study_conditions(rows).collect()
    assert len(conditions) == 8
    assert all(r.errors == 8 and r.n == 40 and r.id_n + r.gemini_n == 40 for r in conditions)
    assert all(r.id_matches == r.id_n and r.gemini_matches == r.gemini_n for r in conditions)


def test_stream_is_idempotent(spark, samples, tmp_path):
    done = samples.withColumn("generation_status", F.lit("completed"))
    inbox, path, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    done.where("repetition = 1").write.parquet(inbox)
    stream = spark.readStream.schema(done.schema).parquet(inbox)
    score_stream(stream, scorer, path, progress)
    done.write.mode("append").parquet(inbox)
    score_stream(stream, scorer, path, progress)
    score_stream(stream, scorer, path, progress)
    assert spark.read.parquet(path).select(*study.CELL).count() == 384


def test_stream_keeps_its_state_over_failures_and_reads_no_results(spark, samples, tmp_path):
    done = samples.withColumn("generation_status", F.lit("completed"))
    inbox, path, progress, other = (str(tmp_path / x) for x in ("in", "out", "progress", "other"))
    elsewhere = study.with_cells(done.select("sample").where("sample like 'p1%'")).where("classifier = '050' or analysis_mode = 'chunks'")
    elsewhere.select(*study.CELL).write.parquet(other)
    done.union(done.withColumn("prompt", F.lit("a later text"))).write.parquet(inbox)
    stream = spark.readStream.schema(done.schema).parquet(inbox)
    known = spark.readStream.schema(elsewhere.select(*study.CELL).schema).parquet(other)
    plans = []

    def fails(cells):
        raise RuntimeError("lost")

    def watched(cells):
        plans.append(cells._jdf.queryExecution().toString())
        return scorer(cells).withColumn("prompt", F.lit(None).cast("string")).drop("prompt")

    with pytest.raises(Exception, match="lost"):
        score_stream(stream, fails, path, progress, "r", ["prompt"], known)
    score_stream(stream, watched, path, progress, "r", ["prompt"], known)
    score_stream(stream, fails, path, progress, "r", ["prompt"], known)  # nothing new, so nothing is called
    got = spark.read.parquet(path).select(*study.CELL)
    assert got.count() == got.distinct().count() == 384 - elsewhere.count()
    assert got.join(elsewhere, study.CELL, "left_semi").count() == 0
    assert plans and not any(path in plan for plan in plans)


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_stream_keeps_texts_out_of_its_state(spark, samples, tmp_path, broadcast):
    """Values that a trip through text would change stay as they are, so the greater of two versions is found."""
    inbox, path, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    done = samples.withColumn("generation_status", F.lit("completed")).withColumn("missing", F.lit(1))
    unnamed = done.where("sample like 'p1_r1_1'").withColumn("sample", F.lit(None).cast("string"))
    versions = [done.unionByName(unnamed).withColumn("at", F.lit(f"2025-01-01 00:00:00.00000{k}").cast("timestamp")) for k in (2, 1)]
    versions[0].union(versions[1]).write.parquet(inbox)
    stream, seen = spark.readStream.schema(versions[0].schema).parquet(inbox), spark.sparkContext.accumulator(0)

    def looked(task):
        seen.add(1)
        return task

    def shared(rows):
        return rows.withColumn("looked", F.udf(looked)("task"))

    def kept(cells):
        return cells.select(*study.CELL, "looked", "missing", F.date_format("at", "SSSSSS").alias("at"))

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        score_stream(stream, kept, path, progress, "r", ["at"], shared=shared)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    rows = spark.read.parquet(path)
    assert rows.count() == 49 * 8 == rows.select(*study.CELL).distinct().count()
    assert rows.where("sample is null").count() == 8
    assert {(r.at, r.missing) for r in rows.select("at", "missing").distinct().collect()} == {("000002", 1)}
    assert seen.value == 49  # once a text, not once a cell


def test_stream_refuses_masks_of_the_earlier_form(spark, samples, tmp_path):
    (tmp_path / "progress" / "offsets").mkdir(parents=True)
    samples.write.parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="earlier form"):
        score_stream(spark.readStream.schema(samples.schema).parquet(str(tmp_path / "in")), scorer, str(tmp_path / "out"), str(tmp_path / "progress"))


def test_marks_read_every_text_once(spark):
    """A label is one pass over its scores, and the classifiers of a sample share its four texts."""
    rows = study_queries._mark_texts(fixtures.samples(spark, "/root/testdata/sf0.001"))
    plan = study_queries._mark_scorer(study.with_cells(rows))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("replace(text#") == 4 * len(study_queries._MARKS)
    assert max(plan.rfind("replace("), plan.rfind("regexp_extract_all(")) > plan.rfind("Generate") > plan.find("Generate") > -1
    assert not any(x in plan[:plan.rfind("Generate")] for x in ("replace(", "regexp_extract_all("))


def test_top_label_keeps_ties_nulls_and_nan(spark):
    rows = spark.createDataFrame([
        (0, [("a", 1.0), ("b", 2.0), ("c", 2.0)]), (1, [("a", None), ("b", -1.0)]), (2, [("a", None)]), (3, []), (4, None),
        (5, [("a", 9.0), ("b", float("nan")), ("c", float("nan"))]), (6, [("a", -0.0), ("b", 0.0)])], "id int, s array<struct<label string, score double>>")
    got = {r.id: r.label for r in rows.select("id", top_label(F.col("s")).alias("label")).collect()}
    assert got == {0: "b", 1: "b", 2: None, 3: None, 4: None, 5: "b", 6: "a"}


def test_resume_transitions(spark):
    rows = spark.createDataFrame([(s,) for s in ("pending", "in_progress", "completed", "failed")], ["generation_status"])
    got = {r.generation_status: (r.resumed_status, r.to_process) for r in study.resume_status(rows).collect()}
    assert got == {"pending": ("pending", True), "in_progress": ("uncertain", False),
                   "completed": ("completed", False), "failed": ("failed", False)}


def test_match_categories(spark):
    cols = "requested_model string, returned_model string, source string, actual_label string, predicted_label string, error string, analysis_mode string, chunk_count int, truncated boolean, finish_reason string"
    base = (None, None, "chunks", 2, False, "stop")
    rows = spark.createDataFrame([
        ("openai/gpt-4.1", "openai/gpt-4.1-2025-04-14", None, None, "gpt-4.1", None, "chunks", 2, False, "length"),
        ("openai/gpt-4.1", "openai/gpt-4.1", None, None, "deepseek-chat", None, "first512", 1, True, "stop"),
        (K.NEWER_GEMINI, K.NEWER_GEMINI, None, None, K.GEMINI_LABEL, None, "first512", 1, False, "stop"),
        (K.NEWER_GEMINI, K.NEWER_GEMINI, None, None, "gpt-4.1", None, "first512", 1, False, "stop"),
        ("vendor/x", "vendor/x", None, None, "gpt-4.1", None, "first512", 1, False, "stop"),
        ("openai/gpt-4.1", "openai/gpt-4.1", None, None, None, "Timeout", "first512", None, None, None),
        (K.NEWER_GEMINI, None, "heldout_benchmark", K.GEMINI_LABEL, K.GEMINI_LABEL, None, "first512", 1, False, None),
    ], cols)
    got = [(r.match, r.notes) for r in study.match_category(rows).collect()]
    other = "Different version / unverified ID"
    assert got == [
        ("Match", "2 chunks; averaged scores; Generation hit output limit"), ("Mismatch", "Truncated at 512 tokens"),
        ("Family match only", other), ("Different label", other), ("Not comparable", other),
        ("Not assessed", "Timeout"), ("Match", ""),
    ]


def test_import_keeps_allowed_fields(spark):
    payloads = [
        json.dumps([{"code": "x", "api_key": "secret", "usage": {"n": 1}}, {"code": "y" * 100_001}]),
        json.dumps([{"code": "x"}] * 101), "[]", "not json",
    ]
    rows = study_json.import_records(spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "upload int, value string"),
                                     keep=["upload"])
    assert "api_key" not in rows.columns
    got = {(r.upload, r.position): (r.problem, r.usage) for r in rows.collect()}
    assert got == {(0, 0): (None, '{"n":1}'), (0, 1): ("code too long", None),
                   **{(1, k): ("record count", None) for k in range(101)},
                   (2, 0): ("record count", None), (3, 0): ("record count", None)}


def test_study_file_flattens_to_fixed_columns(spark, tmp_path):
    state = {"id": "s", "status": "completed", "samples": [{
        "id": "p1_r1_1", "task": "gcd", "repetition": 1, "model": "openai/gpt-4.1",
        "generation": {"returned_model": "openai/gpt-4.1", "provider": "P", "finish_reason": "length"},
        "generation_status": "completed",
        "analyses": [{"classifier": "050", "comments_removed": False, "predicted_label": "gpt-4.1", "other": 1},
                     {"classifier": "100", "comments_removed": True, "analysis_mode": "chunks", "error": "E"}]}]}
    (tmp_path / "study.json").write_text(json.dumps(state, indent=2))
    studies = study_json.read_studies(spark, str(tmp_path / "study.json"))
    flat = study_json.flatten_study(studies)
    assert flat.columns == K.COMPARISON_COLUMNS
    assert [(r.analysis_mode, r.error) for r in flat.orderBy("classifier").collect()] == [("first512", None), ("chunks", "E")]
    study_json.write_comparison(flat, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2
    progress = study.study_progress(study_json.study_samples(studies)).first()
    assert (progress.generated, progress.generation_output_limits, progress.classifications, progress.expected_classifications) == (1, 1, 2, 8)


def test_files_are_checked_against_the_manifest(spark, tmp_path):
    (tmp_path / "a.c").write_bytes(b"int a;\r\n")
    (tmp_path / "s.csv").write_bytes(b"x,y\r\n1,2\r\n")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    wanted = spark.createDataFrame([("a.c", sha(b"int a;\r\n")), ("s.csv", sha(b"x,y\n1,2\n")), ("b.c", "0"), ("d/e.c", "0")],
                                   ["file", "sha256"])
    status = manifest.verify(manifest.hash_files(spark, str(tmp_path)), wanted)
    assert {r.file: r.status for r in status.collect()} == {"a.c": "ok", "s.csv": "ok", "b.c": "missing", "d/e.c": "missing"}
    with pytest.raises(ValueError, match="b.c: missing"):
        manifest.require_ok(status)
    named = manifest.verify(manifest.hash_files(spark, str(tmp_path)), wanted, manifest.BARE_C_NAME)
    assert {r.file: r.status for r in named.collect()} == {"a.c": "ok", "s.csv": "bad name", "b.c": "missing", "d/e.c": "bad name"}


def test_corpus_files_keep_their_positions(spark, tmp_path):
    parts = [[{"c_code": f"int v{i};", "model_name": "gpt-4.1", "prompt": "p", "extra": 1} for i in r] for r in (range(3), range(3, 5))]
    for n, part in enumerate(parts):
        (tmp_path / f"part{n}.json").write_text(json.dumps(part))
        with zipfile.ZipFile(tmp_path / f"part{n}.zip", "w") as z:
            z.writestr("corpus.json", json.dumps(part))
    want = [(i, f"int v{i};", hashlib.sha256(f"int v{i};".encode()).hexdigest()) for i in range(5)]
    for df in (corpus.read_corpus_json(spark, str(tmp_path / "*.json")), corpus.read_corpus_zip(spark, str(tmp_path / "*.zip"))):
        assert [(r.row_id, r.code, r.source_hash) for r in df.orderBy("row_id").collect()] == want


def test_parquet_positions_over_several_files(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(1000).repartition(4).write.parquet(path)
    rows = corpus.number_by_file(corpus.scan_parquet(spark, path)).collect()
    assert sorted(r.row_id for r in rows) == list(range(1000))


def test_reports_replace_only_their_partition(spark, tmp_path):
    path = str(tmp_path / "r")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "split string, n int")
    reports.write_report(df, path, ["split"])
    reports.write_report(df.where("split = 'a'").withColumn("n", F.lit(9)), path, ["split"])
    assert {(r.split, r.n) for r in reports.read_report(spark, path, df.schema).collect()} == {("a", 9), ("b", 2)}
    reports.write_run_record(spark, {"seed": 42}, str(tmp_path / "run"))
    assert json.loads(spark.read.text(str(tmp_path / "run")).first().value) == {"seed": 42}


def test_run_log_lists_the_latest_state_newest_first(spark, tmp_path):
    a, b, c = ("a" * 32, "b" * 32, "c" * 32)
    columns = "id string, version int, status string, created_at string, updated_at string"
    path = str(tmp_path / "log")
    first = [(a, 1, "running", "2025-01-02", "2025-01-02T02"), (b, 1, "running", "2025-01-01", "2025-01-01T01"), ("../x", 1, "running", "2025-01-09", "2025-01-09")]
    second = [(a, 2, "paused", "2025-01-02", "2025-01-02T01"), (c, 1, "running", "2025-01-02", "2025-01-02"), (c, 2, None, "2025-01-02", "2025-01-03"),
              (b, 2, "completed", None, "2025-01-04"), (b, 1, "running", "2025-01-01", "2025-01-01T01")]
    for rows in (first, second):
        study.append_states(spark.createDataFrame(rows, columns), path)
    active = spark.createDataFrame([(c,), (c,)], "id string")
    listed = [tuple(r) for r in study.study_runs(spark.read.parquet(path), active).collect()]
    assert listed == [(c, "running", "2025-01-02"), (a, "interrupted", "2025-01-02"), (b, "interrupted", "2025-01-01")]
    assert study.study_runs(spark.read.parquet(path).where("false"), active).count() == 0


def test_report_scans_the_analyses_once(spark):
    plan = study.study_report(fixtures.analyses(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
