"""Word, letter and text-function queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyfold.functions.text import (
    first_letters,
    keyword_hits,
    whitespace_tokens,
    words,
)
from tallyfold.operators import rows as R
from tallyfold.operators import words as W
from tallyfold.plans.fixtures import Tables
from tallyfold.plans.registry import query

WORD_SQL = r"[\p{L}\p{N}_]+"
TOKEN_SQL = (
    r"[^\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
    r"\x{202F}\x{205F}\x{3000}]+"
)
KEYWORD = "the"


def words_sql(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{WORD_SQL}')"


def tokens_sql(text: str) -> str:
    return f"regexp_extract_all({text}, '{TOKEN_SQL}')"


def keyword_sql(text: str, keyword: str) -> str:
    """Whole-word hits without look-around: every edge character is doubled first."""
    edge = r"[^\p{L}\p{N}_]"
    doubled = "".join(c if c.isalnum() or c == "_" else c * 2 for c in keyword)
    widened = rf"regexp_replace(lower({text}), '({edge})', '\1\1', 'g')"
    return f"cast(len(regexp_extract_all({widened}, '(^|{edge}){doubled}({edge}|$)')) as bigint)"


def _array_digest(tokens: Column) -> list[Column]:
    return [
        F.size(tokens).cast("long").alias("n"),
        F.size(F.array_distinct(tokens)).cast("long").alias("n_distinct"),
        F.md5(F.array_join(tokens, " ")).alias("digest"),
    ]


_DIGEST_SQL = """
select doc_id, cast(len(t) as bigint) as n, cast(len(list_distinct(t)) as bigint) as n_distinct,
 md5(array_to_string(t, ' ')) as digest from (select doc_id, {} as t from documents)"""


@query("tokenize_words", _DIGEST_SQL.format(words_sql("text")))
def tokenize_words(t: Tables):
    return t["documents"].select("doc_id", *_array_digest(words(F.col("text"))))


@query("tokenize_whitespace", _DIGEST_SQL.format(tokens_sql("text")))
def tokenize_whitespace(t: Tables):
    return t["documents"].select("doc_id", *_array_digest(whitespace_tokens(F.col("text"))))


@query("clean_words", r"""
select word, count(*) as n from (
 select lower(regexp_replace(unnest(regexp_split_to_array(text, '[\t\n\v\f\r ]+')),
  '[^a-zA-Z0-9]', '', 'g')) as word from documents) where word <> '' group by word""")
def clean_words(t: Tables):
    return W.count_by(W.clean_words(t["documents"], "text"), "word")


@query("word_count", f"""
select word, count(*) as n from (select unnest({tokens_sql('text')}) as word from documents)
group by word""")
def word_count(t: Tables):
    return W.word_count(t["documents"], "text")


_ASCII_SQL = rf"""
select regexp_replace(word, '[^\x00-\x7F]', '', 'g') as word, n from (
 select word, count(*) as n from (select unnest({tokens_sql('text')}) as word from documents)
 group by word) where regexp_replace(word, '[^\x00-\x7F]', '', 'g') <> ''"""


@query("word_count_ascii", _ASCII_SQL)
def word_count_ascii(t: Tables):
    return W.word_count_ascii(t["documents"], "text")


@query("ascii_strip", f"select word, count(*) as n_tokens, cast(sum(n) as bigint) as n from ({_ASCII_SQL}) group by word")
def ascii_strip(t: Tables):
    counted = W.word_count_ascii(t["documents"], "text")
    return counted.groupBy("word").agg(F.count("*").alias("n_tokens"), F.sum("n").alias("n"))


def top_words_sql(table: str, column: str, k: int, length: int = 1, where: str = "true") -> str:
    return f"""
select word, count(*) as n from (
 select unnest({words_sql(column)}) as word from {table} where {where})
where length(word) >= {length} group by word order by n desc, word limit {k}"""


@query("top_words", top_words_sql("documents", "text", 20))
def top_words(t: Tables):
    return W.top_words(t["documents"], "text", 20)


@query("top_long_words", top_words_sql("v_articles", "content", 8, 6))
def top_long_words(t: Tables):
    return W.top_words(t["v_articles"], "content", 8, min_length=6)


@query("filter_min_word_len", f"""
select word, count(*) as n from (select unnest({words_sql('text')}) as word from documents)
where length(word) >= 6 group by word""")
def filter_min_word_len(t: Tables):
    return W.normalized_word_count(t["documents"], "text", min_length=6)


@query("first_letter", f"""
select doc_id, cast(sum(len(list_filter({tokens_sql('text')},
 lambda w: regexp_matches(w, '^\\p{{L}}')))) as bigint) as n_letters from documents group by doc_id""")
def first_letter_query(t: Tables):
    n = F.size(first_letters(F.col("text"))).cast("long")
    return t["documents"].select("doc_id", n.alias("n_letters"))


@query("letter_count", f"""
select lower(substring(word, 1, 1)) as letter, count(*) as n
from (select unnest({tokens_sql('text')}) as word from documents)
where regexp_matches(word, '^\\p{{L}}') group by 1""")
def letter_count(t: Tables):
    return W.letter_count(t["documents"], "text")


@query("changelog_compact", """
select substring(value, 2, 1) as key, max(cast(regexp_extract(value, ',(\\d+)', 1) as bigint)) as n
from v_log group by 1 order by 1""")
def changelog_compact(t: Tables):
    return W.changelog_compact(t["v_log"])


@query("avg_word_length", f"""
select cast(sum(length(word)) as double) / count(*) as avg_word_length from (
 select distinct unnest({words_sql('content')}) as word from v_articles)""")
def avg_word_length(t: Tables):
    return W.avg_word_length(t["v_articles"], "content")


@query("count_matches", f"""
select doc_id, {keyword_sql('text', KEYWORD)} as n,
 {keyword_sql("replace(text, 'the', 'covid-19')", 'covid-19')} as n_hyphen from documents""")
def count_matches(t: Tables):
    text = F.col("text")
    hyphened = F.replace(text, F.lit("the"), F.lit("covid-19"))
    return t["documents"].select(
        "doc_id", keyword_hits(text, KEYWORD).cast("long").alias("n"),
        keyword_hits(hyphened, "covid-19").cast("long").alias("n_hyphen"),
    )


@query("keyword_top_articles", f"""
select doc_id, title, {keyword_sql('content', KEYWORD)} as n from v_articles
where {keyword_sql('content', KEYWORD)} > 0 order by n desc, doc_id limit 3""")
def keyword_top_articles(t: Tables):
    return W.keyword_top(t["v_articles"], "content", KEYWORD, "doc_id", 3)


@query("like_match", "select doc_id from documents where text like '%tion%'")
def like_match(t: Tables):
    return R.like_match(t["documents"], "text", "%tion%").select("doc_id")


@query("top_k", top_words_sql("conversations", "text", 10))
def top_k(t: Tables):
    counts = W.normalized_word_count(t["conversations"], "text")
    return R.top_k(counts, 10, F.desc("n"), F.asc("word"))
