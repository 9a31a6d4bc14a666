"""Classification metrics from (true, predicted) rows.

Everything starts from the count per (true, predicted) pair, which is combined
map-side and has at most L * L rows per group, so later steps are tiny.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _labels(labels: list[str]) -> Column:
    return F.array(*[F.lit(x) for x in labels])


def _ratio(top: Column, bottom: Column) -> Column:
    """Division that gives 0 on a zero denominator."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)


def pair_counts(predictions: DataFrame, by: list[str] = ()) -> DataFrame:
    return predictions.groupBy(*by, "true", "predicted").agg(F.count("*").alias("n"))


def confusion_long(predictions: DataFrame, labels: list[str], by: list[str] = ()) -> DataFrame:
    """All label pairs with their count; pairs that never occur count 0."""
    counts = pair_counts(predictions, by)
    groups = counts.groupBy(*by).agg(F.lit(0).cast("bigint").alias("n"))
    counts = counts.where(F.col("true").isin(labels) & F.col("predicted").isin(labels))
    zeros = groups.withColumn("true", F.explode(_labels(labels))).withColumn(
        "predicted", F.explode(_labels(labels))
    )
    return (
        counts.unionByName(zeros).groupBy(*by, "true", "predicted").agg(F.sum("n").alias("n"))
    )


def confusion_wide(predictions: DataFrame, labels: list[str], by: list[str] = ()) -> DataFrame:
    """One row per true label, one column per predicted label."""
    return (
        confusion_long(predictions, labels, by)
        .groupBy(*by, "true").pivot("predicted", labels).agg(F.sum("n"))
    )


def from_confusion(wide: DataFrame, labels: list[str], by: list[str] = ()) -> DataFrame:
    """A saved wide matrix back to counted pairs (true, predicted, n)."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(x).alias("predicted"), F.col(f"`{x}`").cast("bigint").alias("n")) for x in labels
    ]))
    return wide.select(*by, "true", cells.alias("c")).select(*by, "true", "c.*")


def report_from_counts(counts: DataFrame, by: list[str] = (),
                       labels: list[str] | None = None) -> DataFrame:
    """Per class precision, recall, F1 and support from counted pairs."""
    hit = F.when(F.col("true") == F.col("predicted"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = F.explode(F.array(
        F.struct(F.col("true").alias("class"), F.col("n").alias("support"),
                 zero.alias("selected"), hit.cast("bigint").alias("tp")),
        F.struct(F.col("predicted").alias("class"), zero.alias("support"),
                 F.col("n").alias("selected"), zero.alias("tp")),
    ))
    rows = counts.select(*by, sides.alias("s")).select(*by, "s.*")
    if labels is not None:
        groups = counts.groupBy(*by).agg(zero.alias("support")) if by else counts.agg(zero.alias("support"))
        blank = groups.select(*by, F.explode(_labels(labels)).alias("class"), "support",
                              zero.alias("selected"), zero.alias("tp"))
        rows = rows.where(F.col("class").isin(labels)).unionByName(blank)
    sums = rows.groupBy(*by, "class").agg(*[F.sum(c).alias(c) for c in ("support", "selected", "tp")])
    precision = _ratio(F.col("tp"), F.col("selected"))
    recall = _ratio(F.col("tp"), F.col("support"))
    return (
        sums.withColumn("precision", precision).withColumn("recall", recall)
        .withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"),
                                 F.col("precision") + F.col("recall")))
        .select(*by, "class", "precision", "recall", "f1", "support", "tp")
    )


def class_report(predictions: DataFrame, by: list[str] = (),
                 labels: list[str] | None = None) -> DataFrame:
    """Macro over ``labels`` when given, else over the labels seen on either side."""
    return report_from_counts(pair_counts(predictions, by), by, labels).drop("tp")


def _summary(report: DataFrame, by: list[str], counts: DataFrame) -> DataFrame:
    """n and accuracy over all counted pairs, macro and weighted scores over the classes of the report."""
    hits = F.when(F.col("true") == F.col("predicted"), F.col("n")).otherwise(0)
    totals = counts.groupBy(*by).agg(F.sum("n").alias("n"), F.sum(hits).alias("hits"))
    both = report.unionByName(totals, allowMissingColumns=True)
    support = F.col("support")
    weighted = [_ratio(F.sum(F.col(c) * support), F.sum(support)).alias(f"weighted_{c}")
                for c in ("precision", "recall", "f1")]
    n = F.coalesce(F.sum("n"), F.sum(support))
    return both.groupBy(*by).agg(
        n.alias("n"),
        F.when(n > 0, F.sum("hits") / n).alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
        *weighted,
    )


def metrics_from_counts(counts: DataFrame, by: list[str] = (),
                        labels: list[str] | None = None) -> DataFrame:
    """Accuracy, macro and weighted scores; accuracy of no rows is null."""
    return _summary(report_from_counts(counts, by, labels), by, counts)


def model_metrics(predictions: DataFrame, by: list[str] = (),
                  labels: list[str] | None = None) -> DataFrame:
    return metrics_from_counts(pair_counts(predictions, by), by, labels)


def full_report_from_counts(counts: DataFrame, by: list[str] = (),
                            labels: list[str] | None = None) -> DataFrame:
    """Class rows followed by ``accuracy``, ``macro avg`` and ``weighted avg``.

    The accuracy row repeats its value in every column, as saved reports do.
    """
    report = report_from_counts(counts, by, labels)
    s = _summary(report, by, counts)
    n = F.col("n").cast("double")

    def row(name, precision, recall, f1, support):
        return F.struct(F.lit(name).alias("class"), precision.alias("precision"),
                        recall.alias("recall"), f1.alias("f1"), support.alias("support"))

    acc = F.col("accuracy")
    extra = F.explode(F.array(
        row("accuracy", acc, acc, acc, acc),
        row("macro avg", *[F.col(f"macro_{c}") for c in ("precision", "recall", "f1")], n),
        row("weighted avg", *[F.col(f"weighted_{c}") for c in ("precision", "recall", "f1")], n),
    ))
    classes = report.drop("tp").withColumn("support", F.col("support").cast("double"))
    return classes.unionByName(s.select(*by, extra.alias("r")).select(*by, "r.*"))


def class_report_full(predictions: DataFrame, by: list[str] = (),
                      labels: list[str] | None = None) -> DataFrame:
    return full_report_from_counts(pair_counts(predictions, by), by, labels)


def prediction_counts(predictions: DataFrame, by: list[str] = ()) -> DataFrame:
    return predictions.groupBy(*by, "predicted").agg(F.count("*").alias("n"))


def prediction_count_map(predictions: DataFrame, by: list[str]) -> DataFrame:
    """The same counts as one map per group (at most one entry per label)."""
    entries = F.sort_array(F.collect_list(F.struct("predicted", "n")))
    return prediction_counts(predictions, by).groupBy(*by).agg(
        F.map_from_entries(entries).alias("predictions")
    )


def join_predictions(predictions: DataFrame, truth: DataFrame, validate: bool = True) -> DataFrame:
    """Predictions next to the corpus label; ``agrees`` is false on a wrong truth column."""
    from inkprint.operators.validate import join_one_to_one

    joined = join_one_to_one(predictions, truth.select("row_id", "label"), ["row_id"], validate)
    return joined.withColumn("agrees", F.col("true") == F.col("label"))


def reconcile_metrics(computed: DataFrame, recorded: DataFrame, keys: list[str],
                      columns: list[str], tolerance: float = 1e-10) -> DataFrame:
    """Computed against recorded metrics, one row per key and metric."""
    def long(df: DataFrame, name: str) -> DataFrame:
        cells = F.explode(F.array(*[
            F.struct(F.lit(c).alias("metric"), F.col(c).alias(name)) for c in columns
        ]))
        return df.select(*keys, cells.alias("c")).select(*keys, "c.*")

    both = long(computed, "computed").join(long(recorded, "recorded"), [*keys, "metric"], "left")
    return both.withColumn(
        "within", F.coalesce(F.abs(F.col("computed") - F.col("recorded")) < tolerance, F.lit(False))
    )


def attack_success(paired: DataFrame, by: list[str] = ()) -> DataFrame:
    """Share of rows that were right, were changed by cleaning, and became wrong.

    Input columns: ``true, predicted, predicted_cleaned, changed``.
    """
    eligible = (F.col("predicted") == F.col("true")) & F.col("changed")
    flipped = F.when(eligible, (F.col("predicted_cleaned") != F.col("true")).cast("int"))
    return paired.groupBy(*by).agg(
        F.count_if(eligible).alias("eligible_correct_changed"),
        F.avg(flipped).alias("attack_success_rate"),
    )


def epoch_loss(batches: DataFrame, by: list[str]) -> DataFrame:
    """Mean over batches and the example-weighted mean."""
    return batches.groupBy(*by).agg(
        F.avg("loss").alias("mean_batch_loss"),
        (F.sum(F.col("loss") * F.col("n")) / F.sum("n")).alias("weighted_loss"),
        F.sum("n").alias("examples"),
    )
