"""Numbers out of text, unit changes, defaults and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"

# How older records give their comment count (fixed value).
COMMENT_TEXT = r"\((\d+)\s+příspěvků\)"


def extract_int(text: Column, pattern: str = r"(\d+)", group: int = 1, default: int = 0) -> Column:
    """The integer in a regex group of ``text``, or ``default``."""
    found = F.regexp_extract(text, pattern, group).try_cast("int")
    return F.coalesce(found, F.lit(default))


def comment_total(text: Column) -> Column:
    """A comment count given as a number or as ``(N příspěvků)``; 0 otherwise."""
    return F.coalesce(
        text.try_cast("int"),
        extract_int(text, COMMENT_TEXT),
    )


def null_default(value: Column, default=0) -> Column:
    return F.coalesce(value, F.lit(default))


def tenths_to_celsius(tenths: Column) -> Column:
    return tenths * F.lit(0.1)


def tenths_to_fahrenheit(tenths: Column) -> Column:
    return tenths * F.lit(0.1) * F.lit(9.0 / 5.0) + F.lit(32.0)


def round2(value: Column) -> Column:
    return F.round(value, 2)


def url_segment(url: Column, index: int = 3) -> Column:
    """The ``index``-th piece of a URL between slashes, or null when absent."""
    return F.get(F.split(url, "/"), F.lit(index))


def label_when(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for an unknown condition)."""
    return F.when(condition, 1).otherwise(0)


def match_flag(text: Column, pattern: str) -> Column:
    """SQL LIKE as 1 or 0, null for a null text."""
    return text.like(pattern).cast("int")


def ratio(part: Column, whole: Column) -> Column:
    """Double quotient; null when ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
