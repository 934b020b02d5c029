"""Filters, projections and line parsing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.values import label_when, match_flag


def parse_delimited_lines(
    lines: DataFrame, fields: Mapping[str, tuple[int, str]], sep: str = ",", column: str = "value"
) -> DataFrame:
    """Typed fields of delimited lines: ``{name: (position, type)}``.

    A missing or malformed field is null; the other columns are kept.
    """
    parts = F.split(column, f"\\Q{sep}\\E")
    keep = [c for c in lines.columns if c != column]
    return lines.select(
        *keep,
        *[F.get(parts, F.lit(at)).try_cast(kind).alias(name) for name, (at, kind) in fields.items()],
    )


def filter_contains(df: DataFrame, column: str, part: str) -> DataFrame:
    return df.filter(F.col(column).contains(part))


def filter_flag_notnull(df: DataFrame, flag: Column, required: str) -> DataFrame:
    return df.filter(flag & F.col(required).isNotNull())


def filter_gt_project(df: DataFrame, column: str, floor, keep: Sequence[str]) -> DataFrame:
    return df.filter(F.col(column) > floor).select(*keep)


def filter_min_word_len(df: DataFrame, length: int, column: str = "word") -> DataFrame:
    return df.filter(F.char_length(column) >= length)


def filter_string_range(df: DataFrame, column: str, low: str, high: str) -> DataFrame:
    """Text order, not date order: ``1. 1. 2022`` sorts before ``2020-01-01``."""
    return df.filter((F.col(column) >= low) & (F.col(column) < high))


def filter_time_range(df: DataFrame, column: str, low: str, high: str) -> DataFrame:
    """Half-open range of a parsed date."""
    return df.filter(
        (F.col(column) >= F.lit(low).cast("timestamp_ntz"))
        & (F.col(column) < F.lit(high).cast("timestamp_ntz"))
    )


def like_match(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.filter(F.col(column).like(pattern))


def with_match_flag(df: DataFrame, column: str, pattern: str, out: str = "matched") -> DataFrame:
    return df.withColumn(out, match_flag(F.col(column), pattern))


def with_label(df: DataFrame, condition: Column, out: str = "label") -> DataFrame:
    return df.withColumn(out, label_when(condition))


def cast_columns(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in kinds.items()})


def select_rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Columns under new names: ``{new: old}``."""
    return df.select(*[F.col(old).alias(new) for new, old in names.items()])


def article_projection(
    df: DataFrame,
    columns: Sequence[str] = ("publication_date", "content", "category", "comment_count"),
) -> DataFrame:
    return df.select(*columns)


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, columns matched by name."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows of a total order; for a small ``k`` (a report)."""
    return df.orderBy(*order).limit(k)


def random_rows(df: DataFrame, key: str, n: int = 1, seed: int = 42) -> DataFrame:
    """``n`` rows drawn without replacement, the same ones on every run.

    The draw orders rows by a digest of seed and key, so it depends neither on
    the partitioning nor on a task being run again.
    """
    return df.orderBy(F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)
