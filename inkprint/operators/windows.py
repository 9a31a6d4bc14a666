"""Long texts as overlapping token windows.

Tokens are any array column; the default is word and punctuation pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from inkprint import constants as K


def input_size(tokens: Column, prefix: int, special: int) -> Column:
    return F.size(tokens) + prefix + special


def truncate_first(df: DataFrame, tokens: str = "tokens", limit: int = K.WINDOW_TOKENS,
                   prefix: int = 2, special: int = 1) -> DataFrame:
    """First-window form: kept tokens, token counts and whether any were cut."""
    total = input_size(F.col(tokens), prefix, special)
    return (
        df.withColumn("input_tokens", total)
        .withColumn("used_tokens", F.least(total, F.lit(limit)))
        .withColumn("truncated", total > limit)
        .withColumn(tokens, F.slice(tokens, 1, limit - prefix - special))
    )


def window_count(length: Column, capacity: int, overlap: int) -> Column:
    """An empty text still has one window."""
    return F.greatest(F.lit(1), F.ceil((length - overlap) / F.lit(float(capacity - overlap))).cast("int"))


def chunk_windows(df: DataFrame, keep: list[str], tokens: str = "tokens",
                  limit: int = K.WINDOW_TOKENS, overlap: int = K.WINDOW_OVERLAP,
                  prefix: int = 2, special: int = 1) -> DataFrame:
    """One row per window: chunk (from 1), start (0-based), end, window tokens.

    Each next window starts ``overlap`` tokens before the last one's end and the
    last window ends with the text.
    """
    capacity = limit - prefix - special
    step_back = min(overlap, capacity - 1)
    length = F.size(tokens)
    step = capacity - step_back

    number = F.explode(F.sequence(F.lit(0), window_count(length, capacity, step_back) - 1))
    start = F.col("number") * step
    return (
        df.select(*keep, F.col(tokens).alias("__tokens"), number.alias("number"))
        .select(
            *keep, (F.col("number") + 1).alias("chunk"), start.alias("start"),
            F.least(start + capacity, F.size("__tokens")).alias("end"),
            F.slice("__tokens", start + 1, F.lit(capacity)).alias("window"),
        )
        .withColumn("model_tokens", F.size("window") + prefix + special)
    )


def chunk_details(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Per window: 1-based token span, model tokens, top label and its score.

    Input carries ``scores`` as an array of (label, score).
    """
    from inkprint.operators.linear import top_label

    best = F.array_max(F.transform("scores", lambda s: s.score))
    return scored.select(
        *keys, "chunk", (F.col("start") + 1).alias("code_token_start"),
        F.col("end").alias("code_token_end"), "model_tokens",
        top_label(F.col("scores")).alias("prediction"), best.alias("score"),
    )


def chunk_stats(windows: DataFrame, keys: list[str]) -> DataFrame:
    return windows.groupBy(*keys).agg(
        F.count("*").alias("chunk_count"),
        F.sum("model_tokens").alias("processed_tokens"),
        F.max("end").alias("code_tokens"),
        (F.count("*") > 1).alias("multichunk"),
    )


def padded_length(length: Column, multiple: int = 8) -> Column:
    return F.ceil(length / F.lit(float(multiple))).cast("bigint") * multiple


def padding_stats(df: DataFrame, by: list[str], length: str = "used_tokens", multiple: int = 8) -> DataFrame:
    """Token budget of inputs padded to a multiple."""
    padded = padded_length(F.col(length), multiple)
    return df.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.sum(length).cast("bigint").alias("tokens"),
        F.sum(padded).cast("bigint").alias("padded_tokens"),
        F.max(padded).alias("longest"),
    )
