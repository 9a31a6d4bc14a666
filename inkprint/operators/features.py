"""Character and word TF-IDF.

Canonical forms
---------------
long    ``(row_id, term, weight)``
sparse  ``(row_id, ..., indices array<int>, values array<double>)``, one row per text

Fitting reads the texts once and leaves at most ``max_features`` rows. Transform
keeps each text's vector in its own row, so the (row, term) pairs, some forty
times the size of the text, are never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from inkprint import constants as K
from inkprint.functions import ngrams, text as tx
from inkprint.session import materialize

# A vocabulary goes to every executor, so its size is checked.
MAX_VOCABULARY = 1_000_000


def char_ngrams(df: DataFrame, text: str = "code", key: str = "row_id",
                sizes: tuple[int, ...] = K.CHAR_SIZES) -> DataFrame:
    """(row_id, term, tf) of character n-grams; case kept, space runs collapsed."""
    source = df.select(F.col(key).cast("bigint").alias("row_id"),
                       tx.collapse_spaces(F.col(text)).alias("text"))
    return source.mapInArrow(
        ngrams.row_counts(sizes), "row_id bigint, term string, tf bigint"
    )


def char_ngram_lists(df: DataFrame, text: str = "code", key: str = "row_id",
                     sizes: tuple[int, ...] = K.CHAR_SIZES) -> DataFrame:
    """(row_id, terms, tfs): :func:`char_ngrams` with the terms of one text and size in one row."""
    source = df.select(F.col(key).cast("bigint").alias("row_id"),
                       tx.collapse_spaces(F.col(text)).alias("text"))
    return source.mapInArrow(
        ngrams.row_lists(sizes), "row_id bigint, terms array<string>, tfs array<bigint>"
    )


def word_tokens(df: DataFrame, text: str = "code", key: str = "row_id") -> DataFrame:
    """(row_id, term, tf) of lower-cased words, counted in the row; neither texts nor tokens are shuffled."""
    source = df.select(F.col(key).cast("bigint").alias("row_id"), tx.words(F.col(text)).alias("tokens"))
    return source.mapInArrow(ngrams.token_counts, "row_id bigint, term string, tf bigint")


def sublinear(tf: Column) -> Column:
    return 1 + F.log(tf)


def smooth_idf(n_rows: Column, df: Column) -> Column:
    return F.log((1 + n_rows) / (1 + df)) + 1


def corpus_frequency(df: DataFrame, analyzer: str, text: str = "code", key: str = "row_id",
                     sizes: tuple[int, ...] = K.CHAR_SIZES, by: tuple[str, ...] = ()) -> DataFrame:
    """(term, cf, df): occurrences and number of texts, over all terms; of words also for each value of ``by``.

    The only shuffle that grows is that of terms already summed per task.
    """
    source = df.select(F.col(text).alias("text"), *by)
    if analyzer == "char" and not by:
        partial = source.select(tx.collapse_spaces(F.col("text"))).mapInArrow(
            ngrams.corpus_counts(sizes), "term string, cf bigint, df bigint"
        )
    elif analyzer == "word":
        # A text adds one to cf per token and one to df per distinct token.
        def each(tokens: Column, cf: int, df_: int) -> Column:
            return F.transform(tokens, lambda t: F.struct(
                t.alias("term"), F.lit(cf).cast("bigint").alias("cf"), F.lit(df_).cast("bigint").alias("df")))

        tokens = source.select(*by, tx.words(F.col("text")).alias("tokens"))
        partial = tokens.select(*by, F.inline(F.concat(
            each(F.col("tokens"), 1, 0), each(F.array_distinct("tokens"), 0, 1)
        )))
    else:
        raise ValueError(f"unknown analyzer {analyzer!r}, or one that knows no groups")
    return partial.groupBy(*by, "term").agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))


def _frequency_cell(cf: Column) -> Column:
    """Least value of the log-linear cell of ``cf``: sixteen cells per power of two."""
    scale = F.pow(F.lit(2), F.greatest(F.length(F.bin(cf)) - 5, F.lit(0)))
    return (F.floor(cf / scale) * scale).cast("bigint")


def _boundary(counts: DataFrame, key: str, left: int) -> tuple[int | str | None, int]:
    """First value of ``key``, in the order of the rows, at which the running count passes ``left``, and the rest."""
    for row in counts.toLocalIterator():
        if row.n > left:
            return row[key], left
        left -= row.n
    return None, left


def top_terms(frequencies: DataFrame, max_features: int) -> DataFrame:
    """The most frequent terms; equal frequencies fall back to term order.

    No task ranks terms: a histogram of frequencies gives the lowest frequency that still enters, and the terms
    tied at it are cut by a histogram of their characters, one place at a time.
    """
    terms = materialize(frequencies, "terms")
    cells = terms.groupBy(_frequency_cell(F.col("cf")).alias("cell")).agg(F.count("*").alias("n")).orderBy(F.desc("cell"))
    cell, left = _boundary(cells, "cell", max_features)
    if cell is None:
        return terms
    inside = terms.where(_frequency_cell(F.col("cf")) == cell)
    least, left = _boundary(inside.groupBy("cf").agg(F.count("*").alias("n")).orderBy(F.desc("cf")), "cf", left)
    prefix, tied = "", terms.where(F.col("cf") == least)
    while left:
        at = F.substring("term", len(prefix) + 1, 1)
        level = tied.where(F.col("term").startswith(prefix)).groupBy(at.alias("at")).agg(F.count("*").alias("n")).orderBy("at")
        char, left = _boundary(level, "at", left)
        prefix += char
    return terms.where((F.col("cf") > least) | ((F.col("cf") == least) & (F.col("term") < prefix)))


def vocabulary_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Terms that are in only one of two vocabularies."""
    sides = left.select("term", F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        right.select("term", F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    return (
        sides.groupBy("term").agg(F.max("a").alias("in_first"), F.max("b").alias("in_second"))
        .where("in_first <> in_second")
    )


@dataclass
class TfidfModel:
    """A fitted vocabulary: at most ``max_features`` terms, sorted, with their idf."""

    analyzer: str
    n_rows: int
    terms: list[str]
    cf: list[int]
    df: list[int]
    idf: list[float]
    sublinear_tf: bool
    sizes: tuple[int, ...] = K.CHAR_SIZES
    _table: DataFrame | None = field(default=None, repr=False)

    @property
    def size(self) -> int:
        return len(self.terms)

    def table(self, spark) -> DataFrame:
        """(idx, term, cf, df, idf) as a DataFrame."""
        if self._table is None:
            frame = pd.DataFrame({"idx": range(self.size), "term": self.terms, "cf": self.cf,
                                  "df": self.df, "idf": self.idf})
            self._table = spark.createDataFrame(
                frame, "idx int, term string, cf bigint, df bigint, idf double"
            )
        return self._table

    def transform(self, df: DataFrame, text: str | None = "code", key: str = "row_id",
                  carry: list[str] = (), tokens: str | None = None) -> DataFrame:
        """L2-normalised TF-IDF in sparse form; a text without known terms stays, empty.

        A word model can read a ready ``tokens`` array column instead of a text.
        """
        spark = df.sparkSession
        weighting = spark.sparkContext.broadcast(
            (self.terms, np.array(self.idf), self.sublinear_tf)
        )
        if self.analyzer == "char":
            kernel = ngrams.weigh_chars(weighting, self.sizes)
            source = tx.collapse_spaces(F.col(text))
        else:
            kernel = ngrams.weigh_tokens(weighting)
            source = tx.words(F.col(text)) if tokens is None else F.col(tokens)
        kept = list(dict.fromkeys([key, *carry]))
        needed = df.select(*dict.fromkeys([*kept, tokens or text]))
        schema = T.StructType(
            [df.schema[c] for c in kept]
            + [T.StructField("indices", T.ArrayType(T.IntegerType())),
               T.StructField("values", T.ArrayType(T.DoubleType()))]
        )
        return needed.select(source.alias("__text"), *kept).mapInArrow(kernel, schema)

    def long_form(self, df: DataFrame, text: str = "code", key: str = "row_id", digits: int | None = None) -> DataFrame:
        """(row_id, weight, term) of a character model straight from the texts; weights are rounded to ``digits``."""
        weighting = df.sparkSession.sparkContext.broadcast((self.terms, np.array(self.idf), self.sublinear_tf))
        schema = T.StructType([df.schema[key], T.StructField("weight", T.DoubleType()), T.StructField("term", T.StringType())])
        source = df.select(tx.collapse_spaces(F.col(text)).alias("__text"), key)
        return source.mapInArrow(ngrams.weigh_chars_long(weighting, self.sizes, digits), schema)

    def explain(self, features: DataFrame, carry: list[str] = ("row_id",)) -> DataFrame:
        """Sparse form to the long form (row_id, weight, term), made where the vectors are."""
        carry = list(carry)
        vocabulary = features.sparkSession.sparkContext.broadcast(self.terms)
        schema = T.StructType([features.schema[c] for c in carry]
                              + [T.StructField("weight", T.DoubleType()), T.StructField("term", T.StringType())])
        return features.select(*carry, "indices", "values").mapInArrow(ngrams.spell_out(vocabulary, carry), schema)


def fit_tfidf(train: DataFrame, analyzer: str = "char", text: str = "code", key: str = "row_id",
              max_features: int = K.CHAR_FEATURES, sublinear_tf: bool | None = None,
              sizes: tuple[int, ...] = K.CHAR_SIZES) -> TfidfModel:
    """Learn vocabulary and idf from ``train`` only.

    Runs two jobs: the row count and the top terms. Only the chosen terms, at
    most ``max_features``, reach the driver.
    """
    if max_features > MAX_VOCABULARY:
        raise ValueError(f"max_features is limited to {MAX_VOCABULARY}")
    return tfidf_of(corpus_frequency(train, analyzer, text, key, sizes), train.select(key).count(), analyzer, max_features,
                    sublinear_tf, sizes)


def tfidf_of(frequencies: DataFrame, n_rows: int, analyzer: str, max_features: int, sublinear_tf: bool | None = None,
             sizes: tuple[int, ...] = K.CHAR_SIZES) -> TfidfModel:
    """Model of the top terms of (term, cf, df) counted over ``n_rows`` texts."""
    if max_features > MAX_VOCABULARY:
        raise ValueError(f"max_features is limited to {MAX_VOCABULARY}")
    chosen = top_terms(frequencies, max_features)
    rows = chosen.withColumn("idf", smooth_idf(F.lit(n_rows), F.col("df"))).toPandas()
    # Code-point order, as the executors sort.
    rows = rows.iloc[sorted(range(len(rows)), key=rows["term"].tolist().__getitem__)]
    if sublinear_tf is None:
        sublinear_tf = analyzer == "char"
    return TfidfModel(analyzer, n_rows, rows["term"].tolist(), rows["cf"].tolist(),
                      rows["df"].tolist(), rows["idf"].tolist(), sublinear_tf, tuple(sizes))


def shared_terms(models: list[TfidfModel]) -> TfidfModel:
    """Model of the terms of several word models, all of one weight; :func:`reweigh` turns its rows into those of each model."""
    if any(m.analyzer != "word" or m.sublinear_tf for m in models):
        raise ValueError("only weights in proportion to counts can be shared")
    terms = sorted(set().union(*[m.terms for m in models]))
    return TfidfModel("word", 0, terms, [0] * len(terms), [0] * len(terms), [1.0] * len(terms), False)


def reweigh(features: DataFrame, shared: TfidfModel, model: TfidfModel, carry: list[str]) -> DataFrame:
    """Sparse rows of :func:`shared_terms` in the vocabulary and weights of one of its models."""
    place = {term: i for i, term in enumerate(model.terms)}
    weighting = features.sparkSession.sparkContext.broadcast(
        (np.array([place.get(t, -1) for t in shared.terms], dtype=np.int64), np.array(model.idf)))
    schema = T.StructType([features.schema[c] for c in [*carry, "indices", "values"]])
    return features.select(*carry, "indices", "values").mapInArrow(ngrams.reweigh(weighting, list(carry)), schema)


def idf_table(df: DataFrame, analyzer: str, max_features: int, text: str = "code") -> DataFrame:
    """(term, cf, df, idf) as a lazy DataFrame, for when no fitted object is needed."""
    n_rows = df.agg(F.count("*")).scalar()
    return top_terms(corpus_frequency(df, analyzer, text), max_features).withColumn(
        "idf", smooth_idf(n_rows, F.col("df"))
    )


def as_vectors(features: DataFrame, size: int, name: str = "features",
               partition_by: list[str] | None = None) -> DataFrame:
    """Sparse form to an ML ``features`` vector column, stored in the work folder.

    A vector is stored as a struct of type, size, indices and values, so the
    struct is written as Parquet and read back as vectors: no Python row is
    built, and all models read the same stored features.
    """
    from pyspark.ml.linalg import VectorUDT

    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), "indices", "values"
    )
    stored = features.withColumn(name, vector).drop("indices", "values")
    schema = T.StructType([
        T.StructField(f.name, VectorUDT()) if f.name == name else f for f in stored.schema.fields
    ])
    return materialize(stored, "vectors", partition_by, schema)


@dataclass
class StoredCounts:
    """Texts as bytes that tell their known terms (:func:`ngrams.pack_chars`), stored once, with the model that weighs them.

    A vector has twelve bytes per entry and hardly shrinks on disk; these are about one, and tell the same vector.
    """

    frame: DataFrame
    model: TfidfModel

    @property
    def sparkSession(self):  # noqa: N802  as a DataFrame's
        return self.frame.sparkSession

    def where(self, condition) -> "StoredCounts":
        return replace(self, frame=self.frame.where(condition))

    def count(self) -> int:
        return self.frame.count()

    def sparse(self) -> DataFrame:
        """(carried columns, indices, values)."""
        carried = [f for f in self.frame.schema.fields if f.name not in ngrams.PACKED]
        weighting = self.sparkSession.sparkContext.broadcast((np.array(self.model.idf), self.model.sublinear_tf))
        schema = T.StructType(carried + [T.StructField("indices", T.ArrayType(T.IntegerType())),
                                         T.StructField("values", T.ArrayType(T.DoubleType()))])
        return self.frame.mapInArrow(ngrams.unpack(weighting, [f.name for f in carried]), schema)


def store_counts(model: TfidfModel, df: DataFrame, text: str = "code", key: str = "row_id", carry: list[str] = (),
                 partition_by: list[str] | None = None) -> StoredCounts:
    """What ``model.transform`` of a character model tells, in the work folder."""
    if model.analyzer != "char":
        raise ValueError("only character models are stored as counts")
    kept = list(dict.fromkeys([key, *carry]))
    vocabulary = df.sparkSession.sparkContext.broadcast(model.terms)
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(c, T.BinaryType()) for c in ngrams.PACKED])
    packed = df.select(tx.collapse_spaces(F.col(text)).alias("__text"), *kept).mapInArrow(ngrams.pack_chars(vocabulary, model.sizes), schema)
    # Small row groups: a few megabytes are thousands of texts, and a task reads whole groups.
    options = {"compression": "zstd", "parquet.block.size": str(8 << 20), "parquet.enable.dictionary": "false"}
    return StoredCounts(materialize(packed, "counts", partition_by, options=options), model)


def feature_stats(model: TfidfModel, features: DataFrame) -> DataFrame:
    """One row: vocabulary size, rows, stored entries, rows without any known term."""
    return features.agg(
        F.lit(model.size).cast("bigint").alias("features"),
        F.lit(model.n_rows).cast("bigint").alias("fitted_rows"),
        F.count("*").alias("rows"),
        F.sum(F.size("indices")).cast("bigint").alias("entries"),
        F.count_if(F.size("indices") == 0).alias("empty_rows"),
    )
