"""The physical plans that large inputs depend on."""

from pyspark.sql import functions as F

from inkprint.operators import features as ft, linear, splits, validate
from inkprint.plans import catalog, fixtures as fx

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_label_filter_and_columns_reach_the_scan(spark):
    text = plan(catalog.QUERIES["filter_labels"](spark, SF))
    assert "In(lang, [de,fr])" in text
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in text


def test_text_is_not_read_where_only_keys_matter(spark):
    for name in ("group_split", "augmentation_mask", "stratified_split", "confusion_wide", "split_audit"):
        assert "text:string" not in plan(catalog.QUERIES[name](spark, SF)), name


def test_split_compares_rows_with_cuts_without_moving_them(spark):
    main = plan(splits.group_split(fx.programs(spark, SF))).split("Subquery")[0]
    assert "Exchange" not in main and "Window" not in main


def test_large_texts_are_never_shuffled_for_features(spark):
    p = fx.programs(spark, SF)
    model = ft.fit_tfidf(p, "word", max_features=50)
    assert "Exchange" not in plan(model.transform(p, carry=["label"]))
    for analyzer in ("char", "word"):
        counted = plan(ft.corpus_frequency(p, analyzer))
        assert counted.count("Exchange") == 1 and "Exchange hashpartitioning(term" in counted


def test_scoring_adds_no_shuffle(spark):
    p = fx.programs(spark, SF)
    model = ft.fit_tfidf(p, "word", max_features=50)
    f = model.transform(p, carry=["label"])
    nb = linear.fit_naive_bayes(f, fx.LANGS, model.size)
    assert "Exchange" not in plan(linear.predict(f, nb))


def test_word_counts_shuffle_nothing(spark):
    assert "Exchange" not in plan(ft.word_tokens(fx.programs(spark, SF)))


def test_no_task_ranks_the_vocabulary(spark):
    top = plan(ft.top_terms(ft.corpus_frequency(fx.programs(spark, SF), "word"), 100))
    assert "TakeOrderedAndProject" not in top and "SinglePartition" not in top


def test_no_cartesian_products(spark):
    for name in ("study_grid", "confusion_long", "tradeoffs", "pending_analyses", "study_by_model", "model_gap"):
        text = plan(catalog.QUERIES[name](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_leakage_audit_groups_once_per_value(spark):
    df = fx.split_rows(spark, SF)
    text = plan(validate.leakage_audit(df, ["problem_id"], ["train", "validation", "test"])).split("Subquery")[0]
    assert "Join" not in text and "partial_max" in text
