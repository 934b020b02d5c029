"""Word and letter counts.

Counting is a plain group-by: each task first counts its own words, so a word
that is a third of all text reaches the shuffle once per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.text import (
    ascii_strip,
    clean_text,
    first_letters,
    keyword_hits,
    whitespace_tokens,
    words,
)
from tallyfold.operators.rows import filter_min_word_len


def tokenize_words(df: DataFrame, column: str) -> DataFrame:
    """One row per lower-cased word."""
    return df.select(F.explode(words(F.col(column))).alias("word"))


def tokenize_whitespace(df: DataFrame, column: str) -> DataFrame:
    """One row per white-space token."""
    return df.select(F.explode(whitespace_tokens(F.col(column))).alias("word"))


def clean_words(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """One row per token reduced to ASCII letters and digits, beside ``keep``."""
    tokens = df.select(*keep, F.explode(F.split(clean_text(F.col(column)), r"\s+")).alias("word"))
    return tokens.filter(F.col("word") != "")


def count_by(df: DataFrame, *keys: str, out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(out))


def word_count(df: DataFrame, column: str) -> DataFrame:
    return count_by(tokenize_whitespace(df, column), "word")


def word_count_ascii(df: DataFrame, column: str) -> DataFrame:
    """Counts per token, printed without non-ASCII characters.

    Tokens are stripped after counting: two tokens may print alike, and a token
    with nothing left is dropped.
    """
    counted = word_count(df, column)
    return counted.withColumn("word", ascii_strip(F.col("word"))).filter(F.col("word") != "")


def normalized_word_count(df: DataFrame, column: str, min_length: int = 1) -> DataFrame:
    return count_by(filter_min_word_len(tokenize_words(df, column), min_length), "word")


def top_words(df: DataFrame, column: str, k: int = 20, min_length: int = 1) -> DataFrame:
    """Most frequent words; ties by word."""
    counted = normalized_word_count(df, column, min_length)
    return counted.orderBy(F.desc("n"), "word").limit(k)


def letters(df: DataFrame, column: str) -> DataFrame:
    """First letter of each white-space token that starts with a letter."""
    heads = df.select(F.explode(first_letters(F.col(column))).alias("letter"))
    return heads.select(F.lower("letter").alias("letter"))


def letter_count(df: DataFrame, column: str) -> DataFrame:
    return count_by(letters(df, column), "letter")


def avg_word_length(df: DataFrame, column: str) -> DataFrame:
    """Mean length over the distinct words."""
    distinct = tokenize_words(df, column).distinct()
    length = F.char_length("word")
    return distinct.agg(
        (F.sum(length).cast("double") / F.nullif(F.count("*"), F.lit(0))).alias("avg_word_length")
    )


def keyword_top(
    df: DataFrame, column: str, keyword: str, order: str, k: int = 3, label: str = "title"
) -> DataFrame:
    """The ``k`` rows with most keyword hits, rows without a hit left out."""
    hits = df.select(order, label, keyword_hits(F.col(column), keyword).cast("long").alias("n"))
    return hits.filter(F.col("n") > 0).orderBy(F.desc("n"), order).limit(k)


def changelog_compact(lines: DataFrame, column: str = "value") -> DataFrame:
    """Final count per key out of ``(key,count)`` lines of a growing count."""
    text = F.regexp_replace(F.trim(column), r"^[()]+|[()]+$", "")
    parts = F.split(text, ",")
    pairs = lines.select(
        F.trim(F.get(parts, F.lit(0))).alias("key"),
        F.trim(F.get(parts, F.lit(1))).try_cast("long").alias("n"),
    )
    return compact_counts(pairs.filter(F.col("n").isNotNull()), "key")


def compact_counts(changes: DataFrame, *keys: str, value: str = "n") -> DataFrame:
    """Largest count per key of an update log, ordered by key."""
    return changes.groupBy(*keys).agg(F.max(value).alias(value)).orderBy(*keys)
