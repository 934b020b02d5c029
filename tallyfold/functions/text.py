"""Tokenizers, cleaners and counters over text columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode letters, numbers and underscore. Java's own \w is ASCII only.
WORD = r"[\p{L}\p{N}_]+"
_EDGE = r"[\p{L}\p{N}_]"

# What Python's str.split() leaves together: all but Unicode white space and the four
# separators U+001C to U+001F. (?U) tests one character property, which is several
# times faster than a list of code point ranges.
_SOLID = r"[\S&&[^\x1C-\x1F]]"
TOKEN = f"(?U){_SOLID}+"


def words(text: Column) -> Column:
    """Lower-cased words of ``text`` as an array."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def word_total(text: Column) -> Column:
    """Number of words in ``text``."""
    return F.regexp_count(text, F.lit(WORD))


def whitespace_tokens(text: Column) -> Column:
    """Tokens between runs of Unicode white space; never an empty token."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def whitespace_token_total(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN))


def clean_text(text: Column) -> Column:
    """``text`` reduced to ASCII letters, digits and white space, lower-cased."""
    return F.lower(F.regexp_replace(text, r"[^a-zA-Z0-9\s]+", ""))


def ascii_strip(token: Column) -> Column:
    """``token`` without its non-ASCII characters; may be empty."""
    return F.regexp_replace(token, r"[^\x00-\x7F]", "")


def first_letters(text: Column) -> Column:
    """First character of each white-space token, where it is a letter; an array."""
    return F.regexp_extract_all(text, F.lit(rf"(?U)(?<!{_SOLID})\p{{L}}"), F.lit(0))


def keyword_hits(text: Column, keyword: str) -> Column:
    """Occurrences of ``keyword`` as a whole word in the lower-cased text."""
    word_edges = re.compile(r"\w")
    if not keyword or not (word_edges.match(keyword[0]) and word_edges.match(keyword[-1])):
        raise ValueError("keyword must begin and end with a word character")
    if "\\E" in keyword:
        raise ValueError("keyword must not contain \\E")
    pattern = rf"(?<!{_EDGE})\Q{keyword.lower()}\E(?!{_EDGE})"
    return F.regexp_count(F.lower(text), F.lit(pattern))
