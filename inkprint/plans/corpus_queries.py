"""Queries of sources, cleaning, validation, joins, audits and splits."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from inkprint import constants as K
from inkprint.functions import text as tx
from inkprint.operators import encode, splits, validate
from inkprint.plans import fixtures as fx
from inkprint.plans.registry import query, rounded
from inkprint.plans.sql import WS, h32, lst, quoted, with_parts
from inkprint.session import fresh_path
from inkprint.sources import corpus, manifest, reports


@query("scan_corpus", with_parts(["programs"], """
  SELECT row_id, label, prompt, length(code) AS code_chars, source_hash FROM programs"""))
def scan_corpus(spark, sf):
    """The programs as files of JSON records, read back by byte ranges; ids are in the data."""
    path = fresh_path(spark, "corpus")
    record = F.struct("row_id", F.col("code").alias("c_code"), F.col("label").alias("model_name"), "prompt")
    fx.programs(spark, sf).select(F.to_json(record).alias("value")).write.option("lineSep", ",").text(path)
    schema = T.StructType([T.StructField("row_id", T.LongType()), *corpus.RECORD_SCHEMA])
    p = corpus.read_records(spark, path, schema).select("r.row_id", F.col("r.c_code").alias("code"), F.col("r.model_name").alias("label"), "r.prompt")
    p = p.withColumn("source_hash", tx.source_hash(F.col("code")))
    return p.select("row_id", "label", "prompt", F.length("code").cast("bigint").alias("code_chars"), "source_hash")


@query("row_ids", "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_id, doc_id FROM documents")
def row_ids(spark, sf):
    scanned = corpus.scan_parquet(spark, f"{sf}/documents.parquet").select("doc_id", "file", "position")
    return corpus.number_by_file(scanned).select("row_id", "doc_id")


@query("filter_labels", with_parts(["programs"], """
  SELECT row_id, label FROM programs WHERE label IN ('de', 'fr')"""))
def filter_labels(spark, sf):
    return validate.filter_labels(fx.programs(spark, sf), ["de", "fr"]).select("row_id", "label")


@query("source_hash", with_parts(["programs"], "SELECT row_id, source_hash FROM programs"))
def source_hash(spark, sf):
    return fx.programs(spark, sf).select("row_id", "source_hash")


@query("strip_comments", with_parts(["stripped"], """
  SELECT row_id, stripped_code, length(stripped_code) AS chars FROM stripped"""))
def strip_comments(spark, sf):
    return fx.stripped(spark, sf).select(
        "row_id", "stripped_code", F.length("stripped_code").cast("bigint").alias("chars")
    )


@query("comment_change_summary", with_parts(["stripped"], """
  SELECT label, count(*) AS programs, count_if(code <> stripped_code) AS changed,
    count_if(code = stripped_code) AS unchanged FROM stripped GROUP BY label"""))
def comment_change_summary(spark, sf):
    return validate.comment_change_summary(fx.stripped(spark, sf), ["label"])


@query("data_summary", with_parts(["stripped"], f"""
  SELECT count(*) AS programs,
    count_if(code IS NULL OR label IS NULL OR prompt IS NULL) AS missing_required_values,
    count_if(NOT regexp_matches(code, '[^{WS}]')) AS empty_code,
    count(*) - count(DISTINCT source_hash) AS exact_duplicate_excess,
    count_if(code <> stripped_code) AS programs_changed_by_comment_removal FROM stripped"""))
def data_summary(spark, sf):
    return validate.data_summary(fx.stripped(spark, sf), ["code", "label", "prompt"])


@query("label_encode", with_parts(["programs"], """
  SELECT row_id, p.label, target, p.label AS decoded
  FROM programs p JOIN (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS target
    FROM (SELECT DISTINCT label FROM programs)) USING (label)"""))
def label_encode(spark, sf):
    d = fx.split_rows(spark, sf)
    labels = encode.label_set(d)
    return d.select("row_id", "label", encode.encode(F.col("label"), labels).alias("target")).withColumn(
        "decoded", encode.decode(F.col("target"), labels)
    )


_REPLY = "CASE WHEN conv_id % 2 = 0 THEN chr(10) || '```c ' || chr(10) || text || chr(10) || '```  ' WHEN conv_id % 3 = 0 THEN '```python' || chr(10) || text || chr(10) || '```' ELSE '  ' || text END"


@query("unwrap_fence", f"""
  SELECT conv_id, turn, regexp_replace(regexp_replace({_REPLY}, '\\A[{WS}]+|[{WS}]+\\z', '', 'g'),
    '\\A```(?:c|C)?[{WS}]*\\n([\\s\\S]*?)\\n```\\z', '\\1') AS code FROM conversations""")
def unwrap_fence(spark, sf):
    c = fx.table(spark, sf, "conversations")
    return c.withColumn("reply", F.expr(_REPLY)).select(
        "conv_id", "turn", tx.unwrap_fence(F.col("reply")).alias("code")
    )


_INPUT = """doc_id AS row_id,
  CASE WHEN doc_id % 17 = 0 THEN chr(32) || chr(10) WHEN doc_id % 19 = 0 THEN repeat(text, 50) ELSE text END AS code,
  CASE WHEN doc_id % 5 = 0 THEN '075' ELSE '050' END AS model,
  CASE WHEN doc_id % 7 = 0 THEN 'whole' ELSE 'chunks' END AS analysis_mode"""


@query("validate_inputs", f"""
  SELECT row_id, CASE WHEN NOT regexp_matches(code, '[^{WS}]') THEN 'blank code'
    WHEN length(code) > {K.MAX_CODE_CHARS} THEN 'too many characters'
    WHEN model NOT IN ({quoted(K.CLASSIFIERS)}) THEN 'unsupported model'
    WHEN analysis_mode NOT IN ({quoted(K.MODES)}) THEN 'unsupported mode' END AS problem
  FROM (SELECT {_INPUT} FROM documents)""")
def validate_inputs(spark, sf):
    d = fx.table(spark, sf, "documents").selectExpr(*[c for c in _split_select(_INPUT)])
    return validate.validate_inputs(d, K.CLASSIFIERS, K.MODES).select("row_id", "problem")


def _split_select(select: str) -> list[str]:
    return [part.strip() for part in select.split(",\n")]


@query("map_generators", with_parts(["samples"], f"""
  SELECT sample, model, CASE {' '.join(f"WHEN model = '{a}' THEN '{b}'" for a, b in K.GENERATOR_LABELS.items())} END AS label
  FROM samples"""))
def map_generators(spark, sf):
    return fx.samples(spark, sf).select("sample", "model", encode.generator_label(F.col("model")).alias("label"))


# --- integrity ---------------------------------------------------------------

@query("verify_manifest", r"""
  SELECT file, CASE WHEN NOT regexp_matches(file, '^[^/\\]+\.c$') THEN 'bad name'
    WHEN doc_id % 89 = 0 THEN 'missing' WHEN doc_id % 97 = 0 THEN 'mismatch' ELSE 'ok' END AS status
  FROM (SELECT doc_id, CASE WHEN doc_id % 83 = 0 THEN 'dir/' ELSE '' END || doc_id || '.c' AS file FROM documents)""")
def verify_manifest(spark, sf):
    d = fx.table(spark, sf, "documents").select(
        "doc_id", "text",
        F.concat(F.when(F.col("doc_id") % 83 == 0, "dir/").otherwise(""), F.col("doc_id").cast("string"), F.lit(".c")).alias("file"),
    )
    # Recorded over LF text; what is found has CRLF line ends and some damage.
    recorded = d.select("file", F.sha2("text", 256).alias("sha256"))
    crlf = F.replace(tx.unix_newlines(F.col("text")), F.lit("\n"), F.lit("\r\n"))
    damaged = F.when(F.col("doc_id") % 97 == 0, F.concat(crlf, F.lit("x"))).otherwise(crlf)
    found = d.where("doc_id % 89 <> 0").select("file", F.sha2(tx.unix_newlines(damaged), 256).alias("sha256"))
    return manifest.verify(found, recorded, manifest.BARE_C_NAME)


@query("duplicates", with_parts(["programs"], """
  SELECT source_hash, count(*) AS n FROM programs GROUP BY source_hash HAVING count(*) > 1"""))
def duplicates(spark, sf):
    return validate.duplicates(fx.programs(spark, sf))


@query("join_split", with_parts(["split_programs"], """
  SELECT row_id, label, source_hash, split, problem_id, length(code) AS code_chars FROM split_programs"""))
def join_split(spark, sf):
    path = fresh_path(spark, "splits")
    fx.saved_splits(spark, sf).write.option("header", True).csv(path)
    programs = fx.programs(spark, sf).drop("problem_id")
    joined = validate.join_one_to_one(programs, corpus.read_splits(spark, path), ["row_id", "label", "source_hash"])
    return joined.select("row_id", "label", "source_hash", "split", "problem_id",
                         F.length("code").cast("bigint").alias("code_chars"))


@query("report_roundtrip", with_parts(["split_programs"], """
  SELECT split, label, count(*) AS n FROM split_programs GROUP BY split, label"""))
def report_roundtrip(spark, sf):
    path = fresh_path(spark, "report")
    sizes = splits.split_sizes(fx.split_rows(spark, sf))
    reports.write_report(sizes, path, ["split"], "csv")
    # A second run of one split replaces that split's folder only.
    reports.write_report(sizes.where("split = 'test'"), path, ["split"], "csv")
    return reports.read_report(spark, path, sizes.schema, "csv").select("split", "label", "n")


# --- audits ------------------------------------------------------------------

_RANDOM = f"""
  SELECT *, CASE WHEN rn <= floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS random_split FROM (
    SELECT row_id, label, problem_id, prompt, source_hash, split,
      row_number() OVER (PARTITION BY label ORDER BY {h32("'42:' || row_id")}, row_id) AS rn,
      count(*) OVER (PARTITION BY label) AS n FROM split_programs)"""


def _random(spark, sf):
    d = fx.split_rows(spark, sf).withColumn("prompt", F.concat(F.lit("write for "), "problem_id"))
    return splits.stratified_split(d.withColumnRenamed("split", "grouped")).withColumnRenamed(
        "split", "random_split"
    )


@query("leakage_audit", with_parts(["split_programs"], """
  SELECT "column", split, count(*) AS distinct_values, count_if(n_splits > 1) AS shared_values
  FROM (SELECT DISTINCT "column", value, split, n_splits FROM (
    SELECT *, (SELECT count(DISTINCT b.split) FROM named b WHERE b."column" = a."column" AND b.value = a.value) AS n_splits
    FROM named a)) GROUP BY ALL""", [("named", """
      SELECT DISTINCT split, 'problem_id' AS "column", problem_id AS value FROM split_programs
      UNION SELECT DISTINCT split, 'prompt', prompt FROM split_programs
      UNION SELECT DISTINCT split, 'source_hash', source_hash FROM split_programs""")]))
def leakage_audit(spark, sf):
    return validate.leakage_audit(
        fx.split_programs(spark, sf), ["problem_id", "prompt", "source_hash"], K.SPLITS
    ).where("distinct_values > 0")


@query("split_coverage", with_parts(["split_programs"], """
  SELECT split, count(DISTINCT label) AS labels, (SELECT count(DISTINCT label) FROM split_programs) AS all_labels,
    count(DISTINCT label) = (SELECT count(DISTINCT label) FROM split_programs) AS complete
  FROM split_programs GROUP BY split"""))
def split_coverage(spark, sf):
    return validate.split_coverage(fx.split_rows(spark, sf), K.SPLITS)


@query("split_sizes", with_parts(["split_programs"], """
  SELECT split, label, count(*) AS n FROM split_programs GROUP BY split, label"""))
def split_sizes(spark, sf):
    return splits.split_sizes(fx.split_rows(spark, sf))


@query("split_counts", with_parts(["split_programs"], """
  SELECT split, count(*) AS samples, count(DISTINCT problem_id) AS groups FROM split_programs GROUP BY split"""))
def split_counts(spark, sf):
    return splits.split_counts(fx.split_rows(spark, sf))


@query("class_counts", with_parts(["split_programs"], "SELECT split, " + ", ".join(
    f"count_if(label = '{x}') AS {x}" for x in fx.LANGS) + " FROM split_programs GROUP BY split"))
def class_counts(spark, sf):
    return splits.class_counts(fx.split_rows(spark, sf), fx.LANGS)


def _regime_sql() -> str:
    def shares(column: str) -> str:
        return (f"(SELECT avg(CASE WHEN t.{column} IN (SELECT r.{column} FROM regimes r WHERE r.condition = x.condition "
                f"AND r.part = 'train') THEN 1.0 ELSE 0.0 END) FROM regimes t WHERE t.condition = x.condition AND t.part = 'test')")

    return with_parts(["split_programs"], f"""
      SELECT condition, condition = 'random_full_fit' AS vocabulary_fit_includes_test,
        (SELECT count(*) FROM regimes r WHERE r.condition = x.condition AND part = 'train') AS train_programs,
        (SELECT count(*) FROM regimes r WHERE r.condition = x.condition AND part = 'test') AS test_programs,
        (SELECT count(*) FROM (SELECT problem_id FROM regimes r WHERE r.condition = x.condition AND part = 'train'
          INTERSECT SELECT problem_id FROM regimes r WHERE r.condition = x.condition AND part = 'test')) AS shared_groups,
        round({shares('problem_id')}, 6) AS test_fraction_with_group_in_train,
        round({shares('prompt')}, 6) AS test_fraction_with_prompt_in_train
      FROM (VALUES ('grouped'), ('random'), ('random_full_fit')) x(condition)""", [
        ("random", _RANDOM),
        ("regimes", """
          SELECT 'grouped' AS condition, split AS part, problem_id, prompt FROM random
          UNION ALL SELECT 'random', random_split, problem_id, prompt FROM random
          UNION ALL SELECT 'random_full_fit', random_split, problem_id, prompt FROM random""")])


@query("split_audit", _regime_sql())
def split_audit(spark, sf):
    regimes = _random(spark, sf).withColumn("x", F.explode(F.array(
        F.struct(F.lit("grouped").alias("condition"), F.col("grouped").alias("part")),
        F.struct(F.lit("random").alias("condition"), F.col("random_split").alias("part")),
        F.struct(F.lit("random_full_fit").alias("condition"), F.col("random_split").alias("part")),
    ))).select("x.*", "problem_id", "prompt")
    audit = validate.overlap_fractions(regimes).withColumn(
        "vocabulary_fit_includes_test", F.col("condition") == "random_full_fit"
    )
    return rounded(audit, "test_fraction_with_group_in_train", "test_fraction_with_prompt_in_train")


# --- splits and augmentation ---------------------------------------------------

@query("group_split", with_parts(["split_programs"], "SELECT row_id, problem_id, split FROM split_programs"))
def group_split(spark, sf):
    return fx.split_rows(spark, sf).select("row_id", "problem_id", "split")


@query("stratified_split", with_parts(["split_programs"], "SELECT row_id, label, random_split AS split FROM random",
                                      [("random", _RANDOM)]))
def stratified_split(spark, sf):
    return _random(spark, sf).select("row_id", "label", F.col("random_split").alias("split"))


@query("sample_per_label", with_parts(["split_programs"], """
  SELECT label, row_id, source_hash FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY row_id) AS rn
    FROM split_programs WHERE split = 'test') WHERE rn = 1"""))
def sample_per_label(spark, sf):
    test = fx.split_programs(spark, sf).where("split = 'test'")
    return splits.sample_per_label(test, ["source_hash"])


def _masked(epoch: int, source: str = "split_stripped") -> str:
    return f"""SELECT *, rn <= round_even(n * 0.5, 0) AS masked FROM (
      SELECT row_id, code, stripped_code, row_number() OVER (ORDER BY {h32(f"'{42 + epoch}:' || row_id")}, row_id) AS rn,
        count(*) OVER () AS n FROM {source} WHERE split = 'train')"""


def _train(spark, sf):
    return splits.group_split(fx.stripped(spark, sf)).where("split = 'train'")


@query("augmentation_mask", with_parts(["split_stripped"], "SELECT row_id, masked FROM m", [("m", _masked(1))]))
def augmentation_mask(spark, sf):
    return splits.augmentation_mask(fx.split_rows(spark, sf).where("split = 'train'"), 0.5, 1).select("row_id", "masked")


@query("augmented_corpus", with_parts(["split_stripped"], """
  SELECT row_id, masked, sha256(CASE WHEN masked THEN stripped_code ELSE code END) AS text_hash FROM m""", [("m", _masked(2))]))
def augmented_corpus(spark, sf):
    masked = splits.augmentation_mask(_train(spark, sf), 0.5, 2)
    return splits.augmented_text(masked).select("row_id", "masked", F.sha2("text", 256).alias("text_hash"))


@query("augmentation_effect", with_parts(["split_stripped"], " UNION ALL ".join(
    f"SELECT {e} AS epoch, count_if(masked) AS requested_stripped_programs, "
    f"count_if(masked AND code <> stripped_code) AS actually_changed_programs FROM m{e}" for e in (1, 2, 3)),
    [(f"m{e}", _masked(e)) for e in (1, 2, 3)]))
def augmentation_effect(spark, sf):
    return splits.augmentation_effect(_train(spark, sf), 0.5, [1, 2, 3])
