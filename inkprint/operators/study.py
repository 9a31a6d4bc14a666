"""Resumable model x task x condition study."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from inkprint import constants as K
from inkprint.operators.encode import generator_label


def _array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def study_grid(prompts: DataFrame, models: list[str], repetitions: int = 2) -> DataFrame:
    """One pending sample per prompt, repetition and model.

    Prompts carry ``prompt_index`` from 0; the running sample number follows from
    it, so no global numbering pass is needed.
    """
    n_models = len(models)
    grid = prompts.withColumn("repetition", F.explode(F.sequence(F.lit(1), F.lit(repetitions)))).select(
        "*", F.posexplode(_array(models)).alias("model_index", "model")
    )
    number = (
        F.col("prompt_index") * (repetitions * n_models)
        + (F.col("repetition") - 1) * n_models + F.col("model_index") + 1
    )
    sample = F.concat(
        F.lit("p"), (F.col("prompt_index") + 1).cast("string"), F.lit("_r"),
        F.col("repetition").cast("string"), F.lit("_"), number.cast("bigint").cast("string"),
    )
    return grid.withColumn("sample", sample).withColumn(
        "generation_status", F.lit("pending")
    ).drop("model_index")


def with_cells(samples: DataFrame, classifiers: list[str] = K.CLASSIFIERS,
               modes: list[str] = K.MODES) -> DataFrame:
    """Every sample under every classifier x comments x coverage cell."""
    return (
        samples.withColumn("classifier", F.explode(_array(classifiers)))
        .withColumn("comments_removed", F.explode(_array([False, True])))
        .withColumn("analysis_mode", F.explode(_array(modes)))
    )


CELL = ["sample", "classifier", "comments_removed", "analysis_mode"]


def mode_or_default(mode: Column) -> Column:
    return F.coalesce(mode, F.lit(K.DEFAULT_MODE))


def pending_analyses(samples: DataFrame, done: DataFrame, modes: list[str] = K.MODES) -> DataFrame:
    """Cells of completed samples that have no analysis yet."""
    grid = with_cells(samples.where(F.col("generation_status") == "completed"), modes=modes)
    finished = done.withColumn("analysis_mode", mode_or_default(F.col("analysis_mode"))).select(*CELL)
    return grid.join(finished, CELL, "left_anti")


def resume_status(samples: DataFrame) -> DataFrame:
    """Interrupted requests become uncertain; finished ones stay as they are."""
    interrupted = F.col("generation_status") == "in_progress"
    return samples.withColumn(
        "resumed_status", F.when(interrupted, "uncertain").otherwise(F.col("generation_status"))
    ).withColumn(
        "resume_note",
        F.when(interrupted, K.RESUME_NOTE),
    ).withColumn("to_process", F.col("generation_status") == "pending")


def study_status(status: Column, has_worker: Column) -> Column:
    return F.when((status == "running") & ~has_worker, "interrupted").otherwise(status)


RUN_ID = "^[a-f0-9]{32}$"


def append_states(states: DataFrame, path: str) -> None:
    """Appends saved states to the run log, one folder per day of creation. Earlier versions are never rewritten."""
    day = F.substring("created_at", 1, 10)
    states.withColumn("day", day).write.mode("append").partitionBy("day").parquet(path)


def study_runs(log: DataFrame, active: DataFrame) -> DataFrame:
    """id, status, created_at of every run, newest first, from an append-only log of ``id, version, status, created_at, updated_at``.

    The latest state of a run counts, by ``updated_at`` and then ``version``. A run saved as running that is not in ``active`` (column ``id``)
    was interrupted. States without status or time of creation, or whose id is not one, are left out.
    """
    readable = log.where(F.col("id").rlike(RUN_ID) & F.col("status").isNotNull() & F.col("created_at").isNotNull())
    latest = readable.groupBy("id").agg(F.max(F.struct("updated_at", "version", "status", "created_at")).alias("s"))
    working = active.select("id").distinct().withColumn("working", F.lit(True))
    status = study_status(F.col("s.status"), F.coalesce("working", F.lit(False))).alias("status")
    return latest.join(working, "id", "left").select("id", status, "s.created_at").orderBy(F.desc("created_at"), F.desc("id"))


def is_good(analysis_error: Column, predicted: Column, labels: list[str]) -> Column:
    return F.coalesce(analysis_error.isNull() & predicted.isin(labels), F.lit(False))


def _judged(analyses: DataFrame, labels: list[str], mapping: dict[str, str], newer: str) -> DataFrame:
    expected = generator_label(F.col("model"), mapping)
    return (
        analyses.withColumn("analysis_mode", mode_or_default(F.col("analysis_mode")))
        .withColumn("good", is_good(F.col("error"), F.col("predicted_label"), labels))
        .withColumn("expected", expected)
        .withColumn("is_newer", F.col("model") == newer)
        .withColumn("matches", F.coalesce(F.col("predicted_label") == expected, F.lit(False)))
    )


CONDITION = ["analysis_mode", "classifier", "comments_removed"]


def study_conditions(analyses: DataFrame, labels: list[str] = K.LABELS,
                     mapping: dict[str, str] = K.GENERATOR_LABELS, newer: str = K.NEWER_GEMINI,
                     gpt: str = K.GPT_LABEL, classifiers: list[str] = K.CLASSIFIERS) -> DataFrame:
    """Match counts per condition; the newer Gemini id counts apart from comparable ids.

    Conditions are all classifiers and comment settings in the modes that occur; those without analyses count 0.
    """
    good = F.coalesce("good", F.lit(False))
    judged = _judged(analyses, labels, mapping, newer)
    judged = judged.unionByName(_blank(judged.select("analysis_mode").distinct(), classifiers), allowMissingColumns=True)
    comparable = good & F.col("expected").isNotNull() & ~F.col("is_newer")
    return judged.groupBy(*CONDITION).agg(
        F.count_if(good).alias("n"),
        F.count_if(~F.col("good")).alias("errors"),
        F.count_if(comparable).alias("id_n"),
        F.count_if(comparable & F.col("matches")).alias("id_matches"),
        F.count_if(good & F.col("is_newer")).alias("gemini_n"),
        F.count_if(good & F.col("is_newer") & F.col("matches")).alias("gemini_matches"),
        F.count_if(good & (F.col("predicted_label") == gpt)).alias("gpt_predictions"),
        F.count_if(good & F.coalesce(F.col("truncated"), F.lit(False))).alias("truncated"),
    )


def _blank(names: DataFrame, classifiers: list[str]) -> DataFrame:
    """``names`` with every classifier and comment setting."""
    return names.withColumn("classifier", F.explode(F.array(*[F.lit(c) for c in classifiers]))).withColumn(
        "comments_removed", F.explode(F.array(F.lit(False), F.lit(True)))
    )


def study_breakdown(analyses: DataFrame, column: str, samples: DataFrame, labels: list[str] = K.LABELS,
                    mapping: dict[str, str] = K.GENERATOR_LABELS, newer: str = K.NEWER_GEMINI,
                    classifiers: list[str] = K.CLASSIFIERS, modes: list[str] = K.MODES) -> DataFrame:
    """n and matches per condition and value of ``column``.

    Values come from all samples and modes from the analyses, so a value whose generations all failed counts 0.
    """
    judged = _judged(analyses, labels, mapping, newer)
    counts = judged.groupBy(*CONDITION, column).agg(
        F.count_if("good").alias("n"), F.count_if(F.col("good") & F.col("matches")).alias("matches")
    )
    zero = F.lit(0).cast("bigint")
    names = samples.groupBy(column).agg(zero.alias("n"), zero.alias("matches"))
    blank = with_cells(names, classifiers, modes).join(judged.select("analysis_mode").distinct(), "analysis_mode", "left_semi")
    return (
        counts.unionByName(blank)
        .groupBy(*CONDITION, column).agg(F.sum("n").alias("n"), F.sum("matches").alias("matches"))
    )


def study_report(analyses: DataFrame, labels: list[str] = K.LABELS,
                 mapping: dict[str, str] = K.GENERATOR_LABELS, newer: str = K.NEWER_GEMINI) -> DataFrame:
    """Predictions of every condition, also by generator, task and true label, in long form and from one scan.

    ``level`` is condition (``name`` is null), generator, task or true; the rows of level true are the cells of the confusion
    matrix, without generators that have no label. Grouping sets run over the counts of all keys, not over the analyses.
    """
    good = _judged(analyses, labels, mapping, newer).where("good")
    counts = good.groupBy(*CONDITION, "model", "task", "expected", "predicted_label").agg(
        F.count("*").alias("n"), F.count_if("matches").alias("matches"))
    levels = {"generator": "model", "task": "task", "true": "expected"}
    key = [*CONDITION, "predicted_label"]
    sets = [[F.col(c) for c in key]] + [[F.col(c) for c in [*key, column]] for column in levels.values()]
    summed = counts.groupingSets(sets, *key, *levels.values()).agg(
        F.sum("n").alias("n"), F.sum("matches").alias("matches"),
        *[F.grouping(column).alias(f"_{level}") for level, column in levels.items()])
    level = F.coalesce(*[F.when(F.col(f"_{name}") == 0, name) for name in levels], F.lit("condition"))
    told = summed.select(*CONDITION, level.alias("level"), F.coalesce(*levels.values()).alias("name"), "predicted_label", "n", "matches")
    return told.where("level = 'condition' or name is not null")


def study_progress(samples: DataFrame, modes: int = len(K.MODES), by: list[str] = ()) -> DataFrame:
    """Samples with ``analysed`` cell counts -> generated, failed, limited, done and expected."""
    status = F.col("generation_status")
    return samples.groupBy(*by).agg(
        F.count("*").alias("samples"),
        F.count_if(status == "completed").alias("generated"),
        F.count_if(status.isin("failed", "uncertain")).alias("generation_failures"),
        F.count_if(F.col("finish_reason") == "length").alias("generation_output_limits"),
        F.sum("analysed").cast("bigint").alias("classifications"),
        (F.count_if(status == "completed") * (4 * modes)).alias("expected_classifications"),
    )


def paired_modes(analyses: DataFrame, keys: list[str] = ("sample", "classifier", "comments_removed")) -> DataFrame:
    """The same sample under both coverage modes, from one grouped pass."""
    def pick(mode: str, column: str) -> Column:
        return F.max(F.when(F.col("analysis_mode") == mode, F.col(column)))

    paired = analyses.groupBy(*keys).agg(
        pick("first512", "predicted_label").alias("first512_label"),
        pick("chunks", "predicted_label").alias("chunks_label"),
        pick("first512", "used_tokens").alias("first512_tokens"),
        pick("chunks", "used_tokens").alias("chunks_tokens"),
    ).where("first512_label is not null and chunks_label is not null")
    return paired.withColumn("same_label", F.col("first512_label") == F.col("chunks_label"))


def coverage_matrix(analyses: DataFrame, models: list[str]) -> DataFrame:
    """Per condition: exact id matches (id suffix = label) of the comparable generators, in all and one column each.

    Generators of the Gemini family carry dated ids, so any label of the family counts as their match, apart from the others.
    """
    from inkprint.functions.text import id_suffix

    match = F.col("predicted_label") == id_suffix(F.col("model"))
    family = F.startswith("model", F.lit("google/"))
    return analyses.groupBy(*CONDITION).agg(
        F.count_if(~family & match).alias("id_matches"),
        F.count_if(~family).alias("comparable_n"),
        F.count_if(family & F.startswith("predicted_label", F.lit("gemini"))).alias("gemini_matches"),
        F.count_if(F.col("predicted_label") == K.GPT_LABEL).alias("gpt_predictions"),
        F.count_if(F.col("chunk_count") > 1).alias("multichunk"),
        *[F.count_if((F.col("model") == m) & match).alias(m) for m in models],
    )


def exact_reference(requested: Column, returned: Column, source: Column, actual: Column) -> Column:
    """Whether the returned id is comparable with the corpus label of the requested id."""
    expected = generator_label(requested)
    dated_id, dated_form = K.DATED_ALIAS
    version_id, version_form = K.VERSION_ALIAS
    compatible = (
        (returned == requested)
        | ((requested == dated_id) & returned.rlike(dated_form))
        | ((requested == version_id) & (returned == version_form))
    )
    heldout = (source == "heldout_benchmark") & (actual == expected)
    fresh = compatible & (requested != K.NEWER_GEMINI)
    return expected.isNotNull() & (
        F.coalesce(heldout, F.lit(False)) | F.coalesce(fresh, F.lit(False))
    )


def match_category(df: DataFrame) -> DataFrame:
    """Adds ``exact_reference``, ``match`` and ``notes`` to analysed generation records."""
    exact = exact_reference(F.col("requested_model"), F.col("returned_model"),
                            F.col("source"), F.col("actual_label"))
    expected = generator_label(F.col("requested_model"))
    match = F.col("predicted_label") == expected
    out = df.withColumn("exact_reference", exact)
    exact = F.col("exact_reference")
    category = (
        F.when(F.col("error").isNotNull(), K.NOT_ASSESSED)
        .when(exact & match, K.MATCH)
        .when(exact, K.MISMATCH)
        .when(expected.isNull(), K.NOT_COMPARABLE)
        .when(match, K.FAMILY_MATCH)
        .otherwise(K.DIFFERENT_LABEL)
    )
    notes = F.concat_ws(
        "; ",
        F.when(F.col("analysis_mode") == "chunks",
               F.concat(F.col("chunk_count").cast("string"), F.lit(K.NOTE_CHUNKS))),
        F.when(F.col("truncated"), F.lit(K.NOTE_TRUNCATED)),
        F.when(F.col("finish_reason") == "length", F.lit(K.NOTE_OUTPUT_LIMIT)),
        F.when(~exact, F.lit(K.NOTE_UNVERIFIED)),
    )
    return out.withColumn("match", category).withColumn(
        "notes", F.when(F.col("error").isNotNull(), F.col("error")).otherwise(notes)
    )
