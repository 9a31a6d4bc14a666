"""Queries of metrics, comparison, ranking and per-program scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkprint import constants as K
from inkprint.operators import compare, linear, metrics, scores
from inkprint.functions import text as tx
from inkprint.plans import fixtures as fx
from inkprint.plans.registry import query, r6, rounded
from inkprint.plans.sql import class_parts, lst, quoted, with_parts

_P = class_parts("predictions", "", "p", fx.LANGS)
_BY = "condition, model, split"
_M = class_parts("ablation_predictions", _BY, "m", fx.LANGS)
_SCORES = ["accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_precision", "weighted_recall", "weighted_f1"]


@query("join_predictions", with_parts(["predictions"], """
  SELECT p.row_id, "true", predicted, lang AS label, "true" = lang AS agrees FROM predictions p JOIN documents ON row_id = doc_id"""))
def join_predictions(spark, sf):
    truth = fx.table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), F.col("lang").alias("label"))
    return metrics.join_predictions(fx.predictions(spark, sf).drop("predicted_cleaned"), truth)


@query("confusion_long", with_parts(["predictions"], f"""
  SELECT a AS "true", b AS predicted, (SELECT count(*) FROM predictions WHERE "true" = a AND predicted = b) AS n
  FROM (SELECT unnest({lst(fx.LANGS)}) AS a), (SELECT unnest({lst(fx.LANGS)}) AS b)"""))
def confusion_long(spark, sf):
    return metrics.confusion_long(fx.predictions(spark, sf), fx.LANGS)


@query("confusion_wide", with_parts(["predictions"], 'SELECT "true", ' + ", ".join(
    f"count_if(predicted = '{x}') AS {x}" for x in fx.LANGS) + ' FROM predictions GROUP BY "true"'))
def confusion_wide(spark, sf):
    return metrics.confusion_wide(fx.predictions(spark, sf), fx.LANGS)


@query("class_report", with_parts(["predictions"], f"SELECT class, support, {r6('precision', 'recall', 'f1')} FROM p_classes", _P))
def class_report(spark, sf):
    return rounded(metrics.class_report(fx.predictions(spark, sf), labels=fx.LANGS), "precision", "recall", "f1")


@query("model_metrics", with_parts(["ablation_predictions"], f"SELECT {_BY}, n, {r6(*_SCORES)} FROM m_summary", _M))
def model_metrics(spark, sf):
    return rounded(fx.ablation_metrics(spark, sf), *_SCORES)


@query("class_report_full", with_parts(["predictions"], f"""
  SELECT class, {r6('precision', 'recall', 'f1', 'support')} FROM (
    SELECT class, precision, recall, f1, CAST(support AS DOUBLE) AS support FROM p_classes
    UNION ALL SELECT 'accuracy', accuracy, accuracy, accuracy, accuracy FROM p_summary
    UNION ALL SELECT 'macro avg', macro_precision, macro_recall, macro_f1, n FROM p_summary
    UNION ALL SELECT 'weighted avg', weighted_precision, weighted_recall, weighted_f1, n FROM p_summary)""", _P))
def class_report_full(spark, sf):
    return rounded(metrics.class_report_full(fx.predictions(spark, sf)), "precision", "recall", "f1", "support")


@query("prediction_counts", with_parts(["predictions"], "SELECT predicted, count(*) AS n FROM predictions GROUP BY predicted"))
def prediction_counts(spark, sf):
    return metrics.prediction_counts(fx.predictions(spark, sf))


_PAIRED = """SELECT p.*, code <> stripped_code AS changed, label FROM predictions p JOIN stripped USING (row_id)"""


@query("attack_success", with_parts(["stripped", "predictions"], f"""
  SELECT label, count_if(eligible) AS eligible_correct_changed,
    round(avg(CASE WHEN eligible THEN CAST(predicted_cleaned <> "true" AS INTEGER) END), 6) AS attack_success_rate
  FROM (SELECT *, predicted = "true" AND changed AS eligible FROM ({_PAIRED})) GROUP BY label"""))
def attack_success(spark, sf):
    changed = fx.stripped(spark, sf).select("row_id", "label", (F.col("code") != F.col("stripped_code")).alias("changed"))
    paired = fx.predictions(spark, sf).join(changed, "row_id")
    return rounded(metrics.attack_success(paired, ["label"]), "attack_success_rate")


@query("reconcile_metrics", with_parts(["ablation_predictions"], f"""
  SELECT {_BY}, metric, round(computed, 6) AS computed,
    round(CASE WHEN metric = 'macro_f1' AND model = 'm1' THEN computed + 0.001 ELSE computed END, 6) AS recorded,
    NOT (metric = 'macro_f1' AND model = 'm1') AS within FROM (
      SELECT {_BY}, 'accuracy' AS metric, accuracy AS computed FROM m_summary
      UNION ALL SELECT {_BY}, 'macro_f1', macro_f1 FROM m_summary
      UNION ALL SELECT {_BY}, 'weighted_f1', weighted_f1 FROM m_summary)""", _M))
def reconcile_metrics(spark, sf):
    computed = fx.ablation_metrics(spark, sf)
    recorded = computed.withColumn(
        "macro_f1", F.when(F.col("model") == "m1", F.col("macro_f1") + 0.001).otherwise(F.col("macro_f1"))
    )
    both = metrics.reconcile_metrics(computed, recorded, _BY.split(", "), ["accuracy", "macro_f1", "weighted_f1"])
    return rounded(both, "computed", "recorded")


@query("epoch_loss", with_parts(["batches"], f"""
  SELECT epoch, round(avg(loss), 6) AS mean_batch_loss, round(sum(loss * n) / sum(n), 6) AS weighted_loss,
    CAST(sum(n) AS BIGINT) AS examples FROM batches GROUP BY epoch"""))
def epoch_loss(spark, sf):
    return rounded(metrics.epoch_loss(fx.batches(spark, sf), ["epoch"]), "mean_batch_loss", "weighted_loss")


# --- comparison ------------------------------------------------------------------

def _rank(score: str, by: str) -> str:
    return f"rank() OVER (PARTITION BY {by} ORDER BY {score} DESC) + (count(*) OVER (PARTITION BY {by}, {score}) - 1) / 2"


@query("rank_models", with_parts(["ablation_predictions"], f"""
  SELECT {_BY}, {r6('macro_f1')}, {_rank('macro_f1', 'condition, split')} AS rank FROM
    (SELECT * REPLACE (round(macro_f1, 12) AS macro_f1) FROM m_summary)""", _M))
def rank_models(spark, sf):
    # Equal predictions must tie: summation order may differ in the last bit.
    m = rounded(fx.ablation_metrics(spark, sf), "macro_f1", digits=12)
    return rounded(compare.rank_models(m).select("condition", "model", "split", "macro_f1", "rank"), "macro_f1")


@query("select_winner", with_parts(["ablation_predictions"], f"""
  SELECT condition, split, model, {r6('macro_f1')} FROM m_summary WHERE condition = 'original' AND split = 'validation'
  ORDER BY round(macro_f1, 12) DESC, model LIMIT 1""", _M))
def select_winner(spark, sf):
    m = rounded(fx.ablation_metrics(spark, sf), "macro_f1", digits=12)
    return rounded(compare.select_winner(m), "macro_f1")


_PIVOT = ("wide", "SELECT model, split, " + ", ".join(
    f"max(CASE WHEN condition = '{c}' THEN round(macro_f1, 12) END) AS {c}" for c in fx.ABLATION_CONDITIONS)
    + " FROM m_summary GROUP BY model, split")


def _pivoted(spark, sf):
    m = rounded(fx.ablation_metrics(spark, sf), "macro_f1", digits=12)
    return compare.pivot_conditions(m, fx.ABLATION_CONDITIONS)


@query("ablation_pivot", with_parts(["ablation_predictions"], f"SELECT model, split, {r6(*fx.ABLATION_CONDITIONS)} FROM wide", _M + [_PIVOT]))
def ablation_pivot(spark, sf):
    return rounded(_pivoted(spark, sf), *fx.ABLATION_CONDITIONS)


@query("ablation_change", with_parts(["ablation_predictions"], f"""
  SELECT model, split, {r6('original', 'comments_removed')},
    round(100 * (comments_removed - original), 6) AS change_percentage_points,
    {_rank('original', 'split')} AS base_rank, {_rank('comments_removed', 'split')} AS other_rank FROM wide""", _M + [_PIVOT]))
def ablation_change(spark, sf):
    return rounded(compare.ablation_change(_pivoted(spark, sf), "original", "comments_removed"),
                   "original", "comments_removed", "change_percentage_points")


@query("ablation_union", with_parts(["ablation_predictions"], f"""
  SELECT {_BY}, {r6('accuracy')} FROM m_summary""", _M))
def ablation_union(spark, sf):
    m = fx.ablation_predictions(spark, sf)
    parts = [
        metrics.model_metrics(m.where(F.col("condition") == c), _BY.split(", "), fx.LANGS)
        for c in fx.ABLATION_CONDITIONS
    ]
    return rounded(compare.append_results(parts).select(*_BY.split(", "), "accuracy"), "accuracy")


_VARIANT = [
    ("variants", "SELECT *, CASE condition WHEN 'original' THEN 'original' ELSE 'stripped' END AS variant FROM ablation_predictions WHERE condition <> 'limited_features' AND split = 'test'"),
    *class_parts("variants", "model, variant", "v", fx.LANGS),
    ("vw", """SELECT model, max(CASE WHEN variant = 'original' THEN accuracy END) AS original,
        max(CASE WHEN variant = 'stripped' THEN accuracy END) AS stripped,
        max(CASE WHEN variant = 'stripped' THEN macro_f1 END) AS stripped_f1 FROM v_summary GROUP BY model"""),
]


@query("robustness_drop", with_parts(["ablation_predictions"], """
  SELECT model, round(original, 6) AS original, round(stripped, 6) AS stripped,
    round(100 * (original - stripped), 6) AS drop_pp FROM vw""", _VARIANT))
def robustness_drop(spark, sf):
    return rounded(compare.robustness_drop(fx.variant_metrics(spark, sf), ["model"]), "original", "stripped", "drop_pp")


@query("tradeoffs", with_parts(["ablation_predictions"], """
  SELECT a.model, round(a.stripped_f1 - b.stripped_f1, 6) AS stripped_macro_f1_gain,
    round(100 * (a.original - b.original), 6) AS clean_accuracy_change_pp,
    a.original >= b.original - 0.02 AS clean_accuracy_within_tolerance
  FROM vw a, vw b WHERE b.model = 'm0' AND a.model <> 'm0'""", _VARIANT))
def tradeoffs(spark, sf):
    return rounded(compare.tradeoffs(fx.variant_metrics(spark, sf), "m0"), "stripped_macro_f1_gain", "clean_accuracy_change_pp")


@query("model_gap", with_parts(["ablation_predictions"], """
  SELECT a.split, round(100 * (a.original - b.original), 6) AS base_gap_pp,
    round(100 * (a.limited_features - b.limited_features), 6) AS other_gap_pp,
    round(100 * (a.original - b.original) - 100 * (a.limited_features - b.limited_features), 6) AS narrowing_pp
  FROM wide a JOIN wide b USING (split) WHERE a.model = 'm0' AND b.model = 'm1'""", _M + [_PIVOT]))
def model_gap(spark, sf):
    m = rounded(fx.ablation_metrics(spark, sf), "macro_f1", digits=12)
    return rounded(compare.model_gap(m, "m0", "m1", "original", "limited_features"),
                   "base_gap_pp", "other_gap_pp", "narrowing_pp")


_NAMES = {"de": "German", "en": "English", "es": "Spanish"}


@query("report_view", with_parts(["ablation_predictions"], f"""
  SELECT {_BY}, CASE class WHEN 'de' THEN 'German' WHEN 'en' THEN 'English' WHEN 'es' THEN 'Spanish' ELSE class END AS name,
    support, round(f1, 4) AS f1, printf('%.2f%%', 100 * recall) AS recall FROM m_classes""", _M))
def report_view(spark, sf):
    report = metrics.class_report(fx.ablation_predictions(spark, sf), _BY.split(", "), fx.LANGS)
    return report.select(
        *_BY.split(", "), tx.display_name(F.col("class"), _NAMES).alias("name"), "support",
        F.round("f1", 4).alias("f1"), tx.percent(F.col("recall")).alias("recall"),
    ).orderBy("condition", "split", F.col("f1").desc(), "name")


# --- training history ---------------------------------------------------------

@query("best_epoch", with_parts(["history"], """
  SELECT run, epoch, round(validation_accuracy, 6) AS validation_accuracy FROM (
    SELECT *, row_number() OVER (PARTITION BY run ORDER BY validation_accuracy DESC, epoch) AS rn FROM history) WHERE rn = 1"""))
def best_epoch(spark, sf):
    return rounded(compare.best_epoch(fx.history(spark, sf), ["run"]), "validation_accuracy")


@query("early_stop", with_parts(["history"], """
  SELECT run, min(CASE WHEN epoch - last_best >= 2 THEN epoch END) AS stop_epoch, max(epoch) AS last_epoch FROM (
    SELECT *, max(CASE WHEN improved THEN epoch END) OVER (PARTITION BY run ORDER BY epoch ROWS UNBOUNDED PRECEDING) AS last_best
    FROM (SELECT *, previous IS NULL OR validation_accuracy > previous AS improved FROM (
      SELECT *, max(validation_accuracy) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous
      FROM history))) GROUP BY run"""))
def early_stop(spark, sf):
    return compare.early_stop(fx.history(spark, sf), ["run"], patience=2)


# --- per-program scores ---------------------------------------------------------

@query("unpivot_scores", with_parts(["long_scores"], "SELECT row_id, label, round(score, 6) AS score FROM long_scores"))
def unpivot_scores(spark, sf):
    return rounded(scores.to_long(fx.wide_scores(spark, sf), fx.LANGS, ["row_id"]), "score")


@query("rank_scores", with_parts(["long_scores"], """
  SELECT row_id, CAST(row_number() OVER (PARTITION BY row_id ORDER BY score DESC, label) AS INTEGER) AS rank,
    label, round(score, 6) AS score FROM long_scores"""))
def rank_scores(spark, sf):
    # The labels of a row are already together, so ranking needs no shuffle.
    wide = fx.wide_scores(spark, sf)
    packed = F.array(*[F.struct(F.lit(x).alias("label"), F.col(f"prob_{x}").alias("score")) for x in fx.LANGS])
    places = wide.select("row_id", F.posexplode(scores.ranked(packed)).alias("rank", "s"))
    return rounded(places.select("row_id", (F.col("rank") + 1).alias("rank"), "s.*"), "score")


@query("softmax", with_parts(["long_scores"], """
  SELECT row_id, label, round(exp(10 * score) / sum(exp(10 * score)) OVER (PARTITION BY row_id), 6) AS probability FROM long_scores"""))
def softmax(spark, sf):
    wide = fx.wide_scores(spark, sf)
    logits = F.array(*[F.struct(F.lit(x).alias("label"), (10 * F.col(f"prob_{x}")).alias("score")) for x in fx.LANGS])
    long = wide.select("row_id", F.inline(linear.softmax(logits)))
    return long.select("row_id", "label", F.round("score", 6).alias("probability"))


_CHUNKED = ("chunked", """SELECT row_id // 3 AS program, row_id % 3 AS chunk, label, score FROM long_scores""")


def _chunk_scores(spark, sf):
    long = scores.to_long(fx.wide_scores(spark, sf), fx.LANGS, ["row_id"])
    return long.select(F.floor(F.col("row_id") / 3).alias("program"), (F.col("row_id") % 3).alias("chunk"), "label", "score")


@query("pool_chunks", with_parts(["long_scores"], """
  SELECT program, label, round(avg(score), 6) AS score FROM chunked GROUP BY program, label""", [_CHUNKED]))
def pool_chunks(spark, sf):
    return rounded(scores.pool_chunks(_chunk_scores(spark, sf), ["program"]), "score")


@query("verify_scores", with_parts(["long_scores"], """
  SELECT count(*) AS rows, count_if(saved_label <> local_label) AS label_disagreements,
    round(max(d), 6) AS maximum_score_difference, CAST(sum(missing) AS BIGINT) AS missing_labels FROM (
    SELECT row_id, max(abs(score - moved)) AS d, count_if(moved IS NULL) AS missing,
      first(label ORDER BY score DESC, label) AS saved_label, first(label ORDER BY moved DESC NULLS LAST, label) AS local_label
    FROM (SELECT *, CASE WHEN label = 'fr' AND row_id % 50 = 7 THEN NULL WHEN label = 'en' AND row_id % 10 = 0 THEN score + 0.05
        ELSE score END AS moved FROM long_scores)
    GROUP BY row_id)"""))
def verify_scores(spark, sf):
    saved = scores.to_long(fx.wide_scores(spark, sf), fx.LANGS, ["row_id"])
    moved = F.when((F.col("label") == "en") & (F.col("row_id") % 10 == 0), F.col("score") + 0.05).otherwise(F.col("score"))
    local = saved.withColumn("score", moved).where("not (label = 'fr' and row_id % 50 = 7)")
    return rounded(scores.verification_summary(scores.score_differences(saved, local, ["row_id"])), "maximum_score_difference")
