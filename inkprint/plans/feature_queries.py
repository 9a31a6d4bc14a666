"""Queries of features, models and long-text windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from inkprint import constants as K
from inkprint.functions import text as tx
from inkprint.operators import features as ft, linear, metrics, models, scores, splits, windows
from inkprint.plans import fixtures as fx, jobs
from inkprint.plans.registry import query, r6, rounded
from inkprint.plans.sql import WORD, WS, class_parts, idf_parts, lst, with_parts
from inkprint.session import fresh_path

_CHAR = idf_parts("char_tf", K.CHAR_FEATURES, "c", True)
_WORDS = idf_parts("word_tf", K.WORD_FEATURES, "w", False)


def _train(spark, sf):
    return fx.split_programs(spark, sf).where("split = 'train'")


def _word_model(spark, sf):
    return ft.fit_tfidf(_train(spark, sf), "word", max_features=K.WORD_FEATURES)


def _char_model(spark, sf):
    return ft.fit_tfidf(_train(spark, sf), "char", max_features=K.CHAR_FEATURES)


@query("char_ngrams", with_parts(["char_tf"], """
  SELECT row_id, CAST(n AS INTEGER) AS size, CAST(sum(tf) AS BIGINT) AS ngrams, count(*) AS distinct_ngrams,
    max(tf) AS top_tf, min(term) AS first_term FROM char_tf GROUP BY row_id, n"""))
def char_ngrams(spark, sf):
    lists = ft.char_ngram_lists(fx.programs(spark, sf))
    # A least string makes Spark sort what it groups, so terms are summed up in their own row first.
    each = lists.select(
        "row_id", F.length(F.col("terms")[0]).alias("size"),
        F.aggregate("tfs", F.lit(0).cast("bigint"), lambda s, n: s + n).alias("ngrams"),
        F.size("terms").cast("bigint").alias("distinct_ngrams"),
        F.array_max("tfs").alias("top_tf"), F.array_min("terms").alias("first_term"),
    )
    return each.groupBy("row_id", "size").agg(
        F.sum("ngrams").alias("ngrams"), F.sum("distinct_ngrams").alias("distinct_ngrams"),
        F.max("top_tf").alias("top_tf"), F.min("first_term").alias("first_term"),
    )


@query("word_tokens", with_parts(["word_tf"], "SELECT row_id, term, tf FROM word_tf"))
def word_tokens(spark, sf):
    return ft.word_tokens(fx.programs(spark, sf))


@query("term_freq", with_parts(["char_tf"], """
  SELECT term, CAST(sum(tf) AS BIGINT) AS tf, round(sum(1 + ln(tf)), 4) AS sublinear_tf FROM char_tf GROUP BY term"""))
def term_freq(spark, sf):
    tf = ft.char_ngrams(fx.programs(spark, sf))
    return tf.groupBy("term").agg(F.sum("tf").alias("tf"), F.round(F.sum(ft.sublinear(F.col("tf"))), 4).alias("sublinear_tf"))


@query("vocab_topk", with_parts(["char_tf"], f"""
  SELECT term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df FROM char_tf WHERE split = 'train' GROUP BY term
  ORDER BY cf DESC, term LIMIT {K.CHAR_FEATURES}"""))
def vocab_topk(spark, sf):
    return ft.top_terms(ft.corpus_frequency(_train(spark, sf), "char"), K.CHAR_FEATURES)


@query("idf", with_parts(["char_tf"], f"SELECT term, cf, df, {r6('idf')} FROM c_vocab", _CHAR))
def idf(spark, sf):
    return rounded(ft.idf_table(_train(spark, sf), "char", K.CHAR_FEATURES), "idf")


@query("tfidf_char", with_parts(["char_tf"], f"SELECT row_id, term, {r6('weight')} FROM c_weights", _CHAR))
def tfidf_char(spark, sf):
    model = _char_model(spark, sf)
    return model.long_form(fx.programs(spark, sf), digits=6)


@query("tfidf_word", with_parts(["word_tf"], f"SELECT row_id, term, {r6('weight')} FROM w_weights", _WORDS))
def tfidf_word(spark, sf):
    model = _word_model(spark, sf)
    return rounded(model.explain(model.transform(fx.programs(spark, sf))), "weight")


@query("tfidf_transform", with_parts(["word_tf"], """
  SELECT p.row_id, p.split, count(term) AS terms, round(coalesce(sum(weight), 0), 6) AS total_weight
  FROM split_programs p LEFT JOIN w_weights w ON p.row_id = w.row_id WHERE p.split <> 'train' GROUP BY p.row_id, p.split""", _WORDS))
def tfidf_transform(spark, sf):
    unseen = fx.split_programs(spark, sf).where("split <> 'train'")
    f = _word_model(spark, sf).transform(unseen, carry=["split"])
    total = F.aggregate("values", F.lit(0.0), lambda s, v: s + v)
    return f.select("row_id", "split", F.size("indices").cast("bigint").alias("terms"), F.round(total, 6).alias("total_weight"))


@query("vocab_leak", with_parts(["word_tf"], f"""
  SELECT coalesce(a.term, b.term) AS term, CAST(a.term IS NOT NULL AS INTEGER) AS in_first, CAST(b.term IS NOT NULL AS INTEGER) AS in_second
  FROM w_vocab a FULL JOIN full_vocab b ON a.term = b.term WHERE a.term IS NULL OR b.term IS NULL""",
    _WORDS + idf_parts("word_tf", K.WORD_FEATURES, "full", False, "true")[:1]))
def vocab_leak(spark, sf):
    p = fx.split_programs(spark, sf)
    vocabulary = lambda df: ft.top_terms(ft.corpus_frequency(df, "word"), K.WORD_FEATURES)
    return ft.vocabulary_difference(vocabulary(p.where("split = 'train'")), vocabulary(p))


@query("feature_stats", with_parts(["word_tf"], """
  SELECT (SELECT count(*) FROM w_vocab) AS features, (SELECT count(*) FROM split_programs WHERE split = 'train') AS fitted_rows,
    (SELECT count(*) FROM split_programs) AS rows, (SELECT count(*) FROM w_weights) AS entries,
    (SELECT count(*) FROM split_programs) - (SELECT count(DISTINCT row_id) FROM w_weights) AS empty_rows""", _WORDS))
def feature_stats(spark, sf):
    model = _word_model(spark, sf)
    return ft.feature_stats(model, model.transform(fx.programs(spark, sf)))


# --- naive Bayes and linear scores ---------------------------------------------

def _nb_parts(weights: str, vocab: str) -> list[tuple[str, str]]:
    return [
        ("nb_prior", """SELECT label, ln(count(*) / (SELECT count(*) FROM split_programs WHERE split = 'train')) AS prior
            FROM split_programs WHERE split = 'train' GROUP BY label"""),
        ("nb_sums", f"""SELECT l.label, v.term, coalesce(s.w, 0) + 1 AS w FROM nb_prior l CROSS JOIN {vocab} v
            LEFT JOIN (SELECT label, term, sum(weight) AS w FROM {weights} WHERE split = 'train' GROUP BY ALL) s
              ON s.label = l.label AND s.term = v.term"""),
        ("nb_lp", "SELECT label, term, ln(w / sum(w) OVER (PARTITION BY label)) AS lp FROM nb_sums"),
    ]


def _nb_scores(name: str, rows: str, weights: str) -> tuple[str, str]:
    return (name, f"""
      SELECT p.row_id, p.split, p.label AS "true", l.label, l.prior + coalesce(s.s, 0) AS score
      FROM {rows} p CROSS JOIN nb_prior l LEFT JOIN (
        SELECT w.row_id, n.label, sum(w.weight * n.lp) AS s FROM {weights} w JOIN nb_lp n ON w.term = n.term GROUP BY ALL
      ) s ON s.row_id = p.row_id AND s.label = l.label""")


_NB = _WORDS + _nb_parts("w_weights", "w_vocab") + [_nb_scores("nb_scores", "split_programs", "w_weights")]
_NB_PICK = ("nb_pred", """SELECT row_id, split, "true", first(label ORDER BY round(score, 9) DESC, label) AS predicted, max(score) AS score
  FROM nb_scores GROUP BY ALL""")


def _fit_nb(spark, sf, model: ft.TfidfModel):
    train = model.transform(_train(spark, sf), carry=["label"])
    return linear.fit_naive_bayes(train, fx.LANGS, model.size)


@query("naive_bayes", with_parts(["word_tf"], """
  SELECT row_id, "true", predicted, round(score, 5) AS score FROM nb_pred WHERE split <> 'train'""", _NB + [_NB_PICK]))
def naive_bayes(spark, sf):
    model = _word_model(spark, sf)
    nb = _fit_nb(spark, sf, model)
    unseen = model.transform(fx.split_programs(spark, sf).where("split <> 'train'"), carry=["label"])
    predicted = linear.predict(unseen, nb)
    best = F.array_max(F.transform("scores", lambda s: s.score))
    return predicted.select("row_id", F.col("label").alias("true"), "predicted", F.round(best, 5).alias("score"))


# A fixed rule gives every (label, term) a weight, so both engines score the same model.
_RULE = " UNION ALL ".join(
    f"SELECT '{x}' AS label, term, (ascii(term) * {k + 3} % 17 - 8) / 10.0 AS weight FROM w_vocab" for k, x in enumerate(fx.LANGS))


@query("linear_score", with_parts(["word_tf"], """
  SELECT row_id, label, round(score, 6) AS score FROM (
    SELECT p.row_id, r.label, r.b + coalesce(sum(w.weight * rule.weight), 0) AS score
    FROM split_programs p CROSS JOIN (VALUES ('de', 0.0), ('en', 0.1), ('es', 0.2), ('fr', 0.3)) r(label, b)
    LEFT JOIN w_weights w ON w.row_id = p.row_id LEFT JOIN rule ON rule.term = w.term AND rule.label = r.label
    GROUP BY p.row_id, r.label, r.b)""", _WORDS + [("rule", _RULE)]))
def linear_score(spark, sf):
    model = _word_model(spark, sf)
    vocabulary = model.table(spark)
    rule = reduce(DataFrame.unionByName, [
        vocabulary.select(F.lit(x).alias("label"), "idx", ((F.ascii("term") * (k + 3) % 17 - 8) / 10.0).alias("weight"))
        for k, x in enumerate(fx.LANGS)
    ])
    scorer = linear.from_long(rule, {"de": 0.0, "en": 0.1, "es": 0.2, "fr": 0.3}, model.size)
    f = model.transform(fx.programs(spark, sf))
    long = f.select("row_id", F.inline(scorer.scores(spark)))
    return rounded(long, "score")


_VARIANTS = _NB + [
    ("s_tf", f"""SELECT row_id, split, term, count(*) AS tf FROM (SELECT row_id, split,
        unnest(regexp_extract_all(lower(stripped_code), '[{WORD}]+')) AS term FROM split_stripped WHERE split <> 'train') GROUP BY ALL"""),
    ("s_raw", "SELECT row_id, term, tf * idf AS w FROM s_tf JOIN w_vocab USING (term)"),
    ("s_weights", "SELECT r.row_id, term, w / norm AS weight FROM s_raw r JOIN (SELECT row_id, sqrt(sum(w * w)) AS norm FROM s_raw GROUP BY row_id) USING (row_id)"),
    ("s_rows", "SELECT * FROM split_programs WHERE split <> 'train'"),
    _nb_scores("s_scores", "s_rows", "s_weights"),
    ("tested", """SELECT 'original' AS variant, split, row_id, "true", label, score FROM nb_scores WHERE split <> 'train'
        UNION ALL SELECT 'stripped', split, row_id, "true", label, score FROM s_scores"""),
    ("test_pred", 'SELECT variant, split, row_id, "true", first(label ORDER BY round(score, 9) DESC, label) AS predicted FROM tested GROUP BY ALL'),
]


def _tested(spark, sf):
    """Held-out rows with both texts, the word model and naive Bayes fitted on original text."""
    model = _word_model(spark, sf)
    rows = splits.group_split(fx.stripped(spark, sf)).where("split <> 'train'")
    return rows, model, _fit_nb(spark, sf, model)


@query("robustness_eval", with_parts(["word_tf", "split_stripped"], f"""
  SELECT variant, split, n, {r6('accuracy', 'macro_f1', 'weighted_f1')} FROM v_summary""",
    _VARIANTS + class_parts("test_pred", "variant, split", "v", fx.LANGS)))
def robustness_eval(spark, sf):
    """Fitted on original text, evaluated on original and on comment-free text of validation and test."""
    m = metrics.model_metrics(jobs.variant_predictions(*_tested(spark, sf)), ["variant", "split"], fx.LANGS)
    return rounded(m.select("variant", "split", "n", "accuracy", "macro_f1", "weighted_f1"), "accuracy", "macro_f1", "weighted_f1")


@query("fitted_attack_success", with_parts(["word_tf", "split_stripped"], """
  SELECT split, count_if(eligible) AS eligible_correct_changed,
    round(avg(CASE WHEN eligible THEN CAST(cleaned <> "true" AS INTEGER) END), 6) AS attack_success_rate
  FROM (SELECT o.split, o."true", s.predicted AS cleaned, o.predicted = o."true" AND t.code <> t.stripped_code AS eligible
    FROM test_pred o JOIN test_pred s ON o.row_id = s.row_id AND o.variant = 'original' AND s.variant = 'stripped'
    JOIN split_stripped t ON t.row_id = o.row_id) GROUP BY split""", _VARIANTS))
def fitted_attack_success(spark, sf):
    return rounded(jobs.fitted_attack_success(*_tested(spark, sf)), "attack_success_rate")


@query("regime_scores")
def regime_scores(spark, sf):
    """Scores of one model under three ways to split and fit, which differ in what they leak."""
    return jobs.regime_scores(fx.programs(spark, sf), fx.LANGS)


# --- Spark ML classifiers --------------------------------------------------------

def _stored(spark, sf):
    model = _char_model(spark, sf)
    return ft.store_counts(model, fx.split_programs(spark, sf), carry=["label", "split"], partition_by=["split"]), model.size


def _one_model(name):
    def run(spark, sf):
        stored, size = _stored(spark, sf)
        return jobs.evaluate(stored, fx.LANGS, [name], size, "original")
    return run


query("logistic_regression")(_one_model("Logistic Regression"))
query("linear_svm")(_one_model("Linear SVM"))
query("random_forest")(_one_model("Random Forest"))


@query("model_zoo")
def model_zoo(spark, sf):
    stored, size = _stored(spark, sf)
    return jobs.evaluate(stored, fx.LANGS, models.MODEL_NAMES, size, "original")


@query("ablation_run")
def ablation_run(spark, sf):
    corpus = splits.group_split(fx.stripped(spark, sf))
    return jobs.ablation(corpus, fx.LANGS, models.MODEL_NAMES)


@query("model_reload")
def model_reload(spark, sf):
    """Predictions of a saved model read back; the second call must not fit again."""
    (stored, size), path = _stored(spark, sf), fresh_path(spark, "model")
    train, held_out = stored.where("split = 'train'"), stored.where("split <> 'train'")
    n_rows = train.count()
    models.load_or_fit(path, train, fx.LANGS, "Naive Bayes", n_rows, size)
    model, reused = models.load_or_fit(path, train, fx.LANGS, "Naive Bayes", n_rows, size)
    return models.predict(model, held_out, fx.LANGS, carry=["row_id", "split"]).withColumn("reused", F.lit(reused))


# --- token windows ------------------------------------------------------------------

_PREFIX, _SPECIAL = 2, 1
_CAP = K.WINDOW_TOKENS - _PREFIX - _SPECIAL
_STEP = _CAP - K.WINDOW_OVERLAP
_TOKENS = ("tokens", f"""SELECT row_id, label, len(regexp_extract_all(code, '[{WORD}]+|[^{WORD}{WS}]')) AS len FROM programs""")
_WINDOWS = ("windows", f"""
  SELECT row_id, label, CAST(i + 1 AS INTEGER) AS chunk, CAST(i * {_STEP} AS INTEGER) AS start_at,
    CAST(least(i * {_STEP} + {_CAP}, len) AS INTEGER) AS end_at FROM (
    SELECT *, unnest(generate_series(0, CAST(greatest(1, ceil((len - {K.WINDOW_OVERLAP}) / {_STEP}.0)) AS BIGINT) - 1)) AS i FROM tokens)""")


def _tokenized(spark, sf):
    return fx.programs(spark, sf).select("row_id", "label", tx.pieces(F.col("code")).alias("tokens"))


def _windows(spark, sf):
    return windows.chunk_windows(_tokenized(spark, sf), ["row_id", "label"], prefix=_PREFIX, special=_SPECIAL)


@query("truncate_first", with_parts(["programs"], f"""
  SELECT row_id, CAST(len + 3 AS INTEGER) AS input_tokens, CAST(least(len + 3, 512) AS INTEGER) AS used_tokens, len + 3 > 512 AS truncated,
    CAST(least(len, {_CAP}) AS INTEGER) AS kept FROM tokens""", [_TOKENS]))
def truncate_first(spark, sf):
    t = windows.truncate_first(_tokenized(spark, sf), prefix=_PREFIX, special=_SPECIAL)
    return t.select("row_id", "input_tokens", "used_tokens", "truncated", F.size("tokens").alias("kept"))


@query("chunk_windows", with_parts(["programs"], """
  SELECT row_id, chunk, start_at AS start, end_at AS "end" FROM windows""", [_TOKENS, _WINDOWS]))
def chunk_windows(spark, sf):
    return _windows(spark, sf).select("row_id", "chunk", "start", "end")


@query("chunk_stats", with_parts(["programs"], """
  SELECT row_id, count(*) AS chunk_count, CAST(sum(end_at - start_at + 3) AS BIGINT) AS processed_tokens,
    max(end_at) AS code_tokens, count(*) > 1 AS multichunk FROM windows GROUP BY row_id""", [_TOKENS, _WINDOWS]))
def chunk_stats(spark, sf):
    return windows.chunk_stats(_windows(spark, sf), ["row_id"])


@query("padding_stats", with_parts(["programs"], """
  SELECT label, count(*) AS rows, CAST(sum(u) AS BIGINT) AS tokens, CAST(sum(ceil(u / 8.0) * 8) AS BIGINT) AS padded_tokens,
    CAST(max(ceil(u / 8.0) * 8) AS BIGINT) AS longest FROM (SELECT label, least(len + 3, 512) AS u FROM tokens) GROUP BY label""", [_TOKENS]))
def padding_stats(spark, sf):
    return windows.padding_stats(windows.truncate_first(_tokenized(spark, sf), prefix=_PREFIX, special=_SPECIAL), ["label"])


_SCORED_WINDOWS = [
    ("toks", f"SELECT row_id, label, split, regexp_extract_all(lower(code), '[{WORD}]+|[^{WORD}{WS}]') AS toks FROM split_programs"),
    ("wins", f"""SELECT row_id, chunk, start_at, end_at, list_slice(toks, start_at + 1, end_at) AS kept FROM (
        SELECT *, CAST(i + 1 AS INTEGER) AS chunk, CAST(i * {_STEP} AS INTEGER) AS start_at, CAST(least(i * {_STEP} + {_CAP}, len(toks)) AS INTEGER) AS end_at FROM (
          SELECT *, unnest(generate_series(0, CAST(greatest(1, ceil((len(toks) - {K.WINDOW_OVERLAP}) / {_STEP}.0)) AS BIGINT) - 1)) AS i FROM toks))"""),
    ("win_raw", """SELECT row_id, chunk, term, tf * idf AS w FROM (SELECT row_id, chunk, term, count(*) AS tf FROM (
        SELECT row_id, chunk, unnest(kept) AS term FROM wins) GROUP BY ALL) JOIN w_vocab USING (term)"""),
    ("win_w", """SELECT r.row_id, r.chunk, term, w / norm AS weight FROM win_raw r
        JOIN (SELECT row_id, chunk, sqrt(sum(w * w)) AS norm FROM win_raw GROUP BY ALL) n ON r.row_id = n.row_id AND r.chunk = n.chunk"""),
    ("win_s", """SELECT p.row_id, p.chunk, p.start_at, p.end_at, l.label, l.prior + coalesce(s.s, 0) AS score FROM wins p CROSS JOIN nb_prior l LEFT JOIN (
        SELECT row_id, chunk, n.label, sum(weight * lp) AS s FROM win_w w JOIN nb_lp n ON w.term = n.term GROUP BY ALL) s
          ON s.row_id = p.row_id AND s.chunk = p.chunk AND s.label = l.label"""),
    ("win_p", """SELECT *, exp(score - top) / sum(exp(score - top)) OVER (PARTITION BY row_id, chunk) AS prob FROM (
        SELECT *, max(score) OVER (PARTITION BY row_id, chunk) AS top FROM win_s)"""),
]


def _scored_windows(spark, sf):
    model = _word_model(spark, sf)
    nb = _fit_nb(spark, sf, model)
    tokens = fx.programs(spark, sf).select("row_id", tx.pieces(F.lower("code")).alias("tokens"))
    w = windows.chunk_windows(tokens, ["row_id"], prefix=_PREFIX, special=_SPECIAL)
    f = model.transform(w, text=None, tokens="window", carry=["chunk", "start", "end", "model_tokens"])
    return linear.predict(f, nb).withColumn("scores", linear.softmax(F.col("scores")))


@query("chunk_details", with_parts(["word_tf"], """
  SELECT row_id, chunk, start_at + 1 AS code_token_start, end_at AS code_token_end, end_at - start_at + 3 AS model_tokens,
    first(label ORDER BY round(prob, 9) DESC, label) AS prediction, round(max(prob), 5) AS score FROM win_p
  GROUP BY row_id, chunk, start_at, end_at""", _NB + _SCORED_WINDOWS))
def chunk_details(spark, sf):
    return rounded(windows.chunk_details(_scored_windows(spark, sf), ["row_id"]), "score", digits=5)


@query("chunk_predict", with_parts(["word_tf"], """
  SELECT row_id, first(label ORDER BY round(score, 9) DESC, label) AS predicted, round(max(score), 5) AS top_score
  FROM (SELECT row_id, label, avg(prob) AS score FROM win_p GROUP BY row_id, label) GROUP BY row_id""", _NB + _SCORED_WINDOWS))
def chunk_predict(spark, sf):
    long = _scored_windows(spark, sf).select("row_id", F.inline("scores"))
    return rounded(scores.top_scores(scores.pool_chunks(long, ["row_id"]), ["row_id"]), "top_score", digits=5)
