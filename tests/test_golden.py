"""Published matrices and tables must give the published scores."""

import pytest
from pyspark.sql import functions as F

from inkprint.constants import LABELS
from inkprint.operators import compare, metrics

# Published confusion matrices, rows true, columns predicted, label order.
MATRICES = {
    ("Linear SVM", "test"): [
        [543, 83, 15, 44, 91], [39, 462, 8, 63, 199], [4, 18, 721, 3, 11], [4, 75, 4, 673, 25], [8, 54, 9, 27, 689]],
    ("Linear SVM", "validation"): [
        [501, 51, 0, 1, 47], [46, 369, 6, 50, 137], [3, 28, 544, 1, 16], [4, 86, 2, 478, 36], [16, 48, 1, 5, 502]],
    ("Logistic Regression", "test"): [
        [560, 76, 10, 15, 115], [59, 418, 9, 69, 216], [7, 27, 701, 3, 19], [10, 100, 3, 626, 42], [9, 77, 10, 19, 672]],
    ("Naive Bayes", "test"): [
        [399, 96, 47, 4, 230], [61, 314, 36, 71, 289], [4, 15, 697, 1, 40], [16, 129, 26, 445, 165], [40, 94, 63, 18, 572]],
    ("Random Forest", "validation"): [
        [427, 25, 9, 16, 123], [71, 296, 7, 94, 140], [4, 23, 537, 3, 25], [13, 53, 10, 495, 35], [15, 18, 6, 11, 522]],
}
# Accuracy, macro F1, macro precision, macro recall.
SCORES = {
    ("Linear SVM", "test"): (0.7975206611570248, 0.7970260999301084, 0.8075565205017788, 0.7977200314614412),
    ("Linear SVM", "validation"): (0.8038952316991269, 0.8062140805934097, 0.8140735737389757, 0.8054456138331855),
    ("Logistic Regression", "test"): (0.768853305785124, 0.7703601211222754, 0.7820369838580892, 0.7690476557534778),
    ("Naive Bayes", "test"): (0.6268078512396694, 0.6278149596359703, 0.6641815866137747, 0.6277542636326479),
    ("Random Forest", "validation"): (0.7646071188717259, 0.7608876047185115, 0.7760205502204682, 0.7670044924560296),
}
SVM_CLASSES = {
    "claude-3.5-haiku": (0.9080267558528428, 0.6997422680412371, 0.7903930131004366, 776.0),
    "deepseek-chat": (0.6676300578034682, 0.5992217898832685, 0.631578947368421, 771.0),
    "accuracy": (0.7975206611570248, 0.7975206611570248, 0.7975206611570248, 0.7975206611570248),
    "macro avg": (0.8075565205017788, 0.7977200314614412, 0.7970260999301084, 3872.0),
    "weighted avg": (0.8066906074457982, 0.7975206611570248, 0.7964485403941237, 3872.0),
}
# Macro F1 as (model, split, original, comments_removed, limited_features).
MACRO_F1 = [
    ("Linear SVM", "test", 0.7970260999301084, 0.603165408472668, 0.7169087953866016),
    ("Linear SVM", "validation", 0.8062140805934097, 0.688290055696418, 0.7336139196353126),
    ("Logistic Regression", "test", 0.7703601211222754, 0.586692143468796, 0.7024552313434415),
    ("Logistic Regression", "validation", 0.7913448449924319, 0.6580203865620154, 0.719732057433101),
    ("Naive Bayes", "test", 0.6278149596359703, 0.4577904145304113, 0.4742613242753417),
    ("Naive Bayes", "validation", 0.6902698225550675, 0.5286848607074566, 0.5214089872246203),
    ("Random Forest", "test", 0.6795882928627084, 0.5655788323672557, 0.6052495893279112),
    ("Random Forest", "validation", 0.7608876047185115, 0.6453360911131926, 0.6613581239550761),
]
# Epoch, training loss, macro F1, accuracy.
HISTORY = [
    (1, 0.8373816567818022, 0.7467823895630505, 0.7478173270651444),
    (2, 0.39726885545389734, 0.7647299078196064, 0.7679650772330423),
    (3, 0.26862093386634767, 0.7997564211227581, 0.7985224983210208),
    (4, 0.185990033734434, 0.7900876371768216, 0.7897918065815984),
    (5, 0.13392359454326416, 0.7832864348911424, 0.7844190732034922),
]


@pytest.fixture(scope="module")
def counts(spark):
    rows = [
        (model, split, LABELS[i], *row)
        for (model, split), matrix in MATRICES.items() for i, row in enumerate(matrix)
    ]
    wide = spark.createDataFrame(rows, ["model", "split", "true", *LABELS])
    return metrics.from_confusion(wide, LABELS, ["model", "split"])


def test_matrices_give_published_scores(counts):
    by = ["model", "split"]
    got = {(r.model, r.split): r for r in metrics.metrics_from_counts(counts, by, LABELS).collect()}
    assert set(got) == set(SCORES)
    for key, want in SCORES.items():
        r = got[key]
        assert (r.accuracy, r.macro_f1, r.macro_precision, r.macro_recall) == pytest.approx(want, abs=1e-12)


def test_full_report_matches_published_rows(counts):
    svm = counts.where("model = 'Linear SVM' and split = 'test'")
    got = {r["class"]: r for r in metrics.full_report_from_counts(svm).collect()}
    assert len(got) == 8
    for name, want in SVM_CLASSES.items():
        r = got[name]
        assert (r.precision, r.recall, r.f1, r.support) == pytest.approx(want, abs=1e-12)


def long_metrics(spark):
    conditions = ["original", "comments_removed", "limited_features"]
    rows = [(c, r[0], r[1], r[2 + i]) for r in MACRO_F1 for i, c in enumerate(conditions)]
    return spark.createDataFrame(rows, ["condition", "model", "split", "macro_f1"]), conditions


def test_comparison_and_winner(spark):
    m, conditions = long_metrics(spark)
    wide = compare.pivot_conditions(m, conditions)
    change = {(r.model, r.split): r for r in compare.ablation_change(wide, "original", "comments_removed").collect()}
    svm = change["Linear SVM", "test"]
    assert svm.change_percentage_points == pytest.approx(-19.386069145744045)
    assert (svm.base_rank, svm.other_rank) == (1.0, 1.0)
    assert change["Naive Bayes", "validation"].other_rank == 4.0
    limited = {(r.model, r.split): r for r in compare.ablation_change(wide, "original", "limited_features").collect()}
    assert limited["Naive Bayes", "validation"].change_percentage_points == pytest.approx(-16.886083533044726)
    assert compare.select_winner(m).first().model == "Linear SVM"
    gap = {r.split: r for r in compare.model_gap(m, "Linear SVM", "Logistic Regression", "original", "limited_features").collect()}
    assert gap["validation"].base_gap_pp == pytest.approx(1.4869, abs=1e-4)
    assert gap["validation"].narrowing_pp == pytest.approx(0.0987, abs=1e-4)


def test_tied_scores_share_the_mean_rank(spark):
    m = spark.createDataFrame([("c", x, "s", f) for x, f in [("a", .5), ("b", .7), ("d", .7), ("e", .1)]],
                              ["condition", "model", "split", "macro_f1"])
    assert {r.model: r["rank"] for r in compare.rank_models(m).collect()} == {"a": 3.0, "b": 1.5, "d": 1.5, "e": 4.0}


def test_history_gives_best_epoch_and_stop(spark):
    h = spark.createDataFrame(HISTORY, ["epoch", "training_loss", "validation_macro_f1", "validation_accuracy"])
    h = h.withColumn("run", F.lit(0))
    assert compare.best_epoch(h, ["run"]).first().epoch == 3
    assert compare.early_stop(h, ["run"], patience=2).first().stop_epoch == 5
    assert compare.early_stop(h, ["run"], patience=3).first().stop_epoch is None
    tied = spark.createDataFrame([(0, 1, .5), (0, 2, .9), (0, 3, .9)], ["run", "epoch", "validation_accuracy"])
    assert compare.best_epoch(tied, ["run"]).first().epoch == 2


def test_zero_division_and_empty_sets(spark):
    p = spark.createDataFrame([("a", "b"), ("b", "b")], ["true", "predicted"])
    report = {r["class"]: r for r in metrics.class_report(p, labels=["a", "b", "c"]).collect()}
    assert report["a"].precision == report["a"].recall == report["a"].f1 == 0.0
    assert (report["c"].support, report["c"].f1) == (0, 0.0)
    seen = metrics.model_metrics(p).first()
    given = metrics.model_metrics(p, labels=["a", "b", "c"]).first()
    assert seen.macro_f1 == pytest.approx(1 / 3) and given.macro_f1 == pytest.approx(2 / 9)
    empty = metrics.model_metrics(p.where("false"), labels=["a", "b"]).first()
    assert empty.accuracy is None and empty.macro_f1 == 0.0
    matrix = metrics.confusion_long(p.where("false"), ["a", "b"]).collect()
    assert len(matrix) == 4 and all(r.n == 0 for r in matrix)
