"""Streaming frames for word counts, windows and changelogs.

Each function takes a streaming frame and returns one; the runner attaches the
sink. State is kept per word, letter or window, after counting inside each task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.values import match_flag
from tallyfold.operators.rows import filter_gt_project
from tallyfold.operators.words import clean_words, letter_count


def event_time(df: DataFrame, column: str) -> DataFrame:
    """A naive time read in the session zone: watermarks need an instant."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def word_counts(lines: DataFrame, column: str = "value", ordered: bool = True) -> DataFrame:
    """Running count per cleaned word (complete mode), most frequent first.

    A sort reads the state twice per batch; leave it out where a file sink loses
    the order anyway.
    """
    counts = clean_words(lines, column).groupBy("word").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "word") if ordered else counts


def window_word_counts(
    lines: DataFrame, column: str, time: str, size: str = "30 seconds", slide: str = "15 seconds",
    watermark: str | None = None, ordered: bool = True,
) -> DataFrame:
    """Count per sliding window and cleaned word.

    Complete mode keeps every window for ever; a watermark with append mode (and
    without ``ordered``) lets finished windows go.
    """
    if watermark:
        lines = lines.withWatermark(time, watermark)
    counts = clean_words(lines, column, time).groupBy(F.window(time, size, slide), "word").agg(
        F.count("*").alias("n")
    )
    flat = counts.select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"), "word", "n"
    )
    return flat.orderBy("start", F.desc("n"), "word") if ordered else flat


def letter_changelog(lines: DataFrame, column: str = "value") -> DataFrame:
    """Count per first letter, to be run in update mode."""
    return letter_count(lines, column)


def sliding_cond_counts(
    df: DataFrame, time: str, content: str, pattern: str, watermark: str = "3 seconds",
    size: str = "1 minute", slide: str = "10 seconds",
) -> DataFrame:
    """Rows, and rows whose content is LIKE ``pattern``, per closed sliding window."""
    counts = df.withWatermark(time, watermark).groupBy(F.window(time, size, slide)).agg(
        F.count("*").alias("n"), F.sum(match_flag(F.col(content), pattern)).alias("n_matched")
    )
    return counts.select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n", "n_matched"
    )


def over_threshold(df: DataFrame, column: str, floor, *keep: str) -> DataFrame:
    """Rows above a threshold, for an append sink."""
    return filter_gt_project(df, column, floor, keep)


def passthrough(df: DataFrame) -> DataFrame:
    return df.select("*")


def first_seen(df: DataFrame, key: str, time: str, watermark: str) -> DataFrame:
    """Incremental append as a stream: each key once within the watermark."""
    return df.withWatermark(time, watermark).dropDuplicatesWithinWatermark([key])
