import re

import pytest
from conftest import SMALL, values
from pyspark.sql import functions as F

from tallyfold.functions import text as T
from tallyfold.functions import values as V
from tallyfold.functions.dates import parse_date
from tallyfold.operators import words as W

TEXTS = [
    "Žluťoučký kůň_2 běží", "covid-19 ácovid-19 covid-190 (covid-19) COVID-19", "  two  blanks ",
    "", "—— ☃", "a b c\x1cd", "x² ½ ١٢ 你好 é", "it's 3.14",
]


def test_words_equal_python(spark, rows):
    df = rows("t string", *[(t,) for t in TEXTS])
    for t, words, n in df.select("t", T.words(F.col("t")), T.word_total(F.col("t"))).collect():
        assert words == re.findall(r"\b\w+\b", t.lower()) and n == len(words)


def test_words_equal_python_on_documents(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    for t, words, tokens in df.select(
        "text", T.words(F.col("text")), T.whitespace_tokens(F.col("text"))
    ).collect():
        assert words == re.findall(r"\b\w+\b", t.lower())
        assert tokens == t.split()


def test_every_space_equals_python(spark):
    """Each code point below the surrogates, between two letters."""
    points = spark.range(1, 0xD800).selectExpr(
        "id", "decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE') as c")
    tokens = T.whitespace_token_total(F.concat(F.lit("a"), F.col("c"), F.lit("b")))
    heads = F.size(T.first_letters(F.concat(F.lit("1"), F.col("c"), F.lit("b"))))
    for i, c, n, h in points.select("id", "c", tokens, heads).collect():
        assert n == len(f"a{c}b".split()), hex(i)
        assert h == sum(w[0].isalpha() for w in f"1{c}b".split()), hex(i)


def test_whitespace_tokens_equal_python(spark, rows):
    df = rows("t string", *[(t,) for t in TEXTS])
    for t, tokens, n in df.select(
        "t", T.whitespace_tokens(F.col("t")), T.whitespace_token_total(F.col("t"))
    ).collect():
        assert tokens == t.split() and n == len(tokens)


def test_keyword_hits_equal_python(spark, rows):
    df = rows("t string", *[(t,) for t in TEXTS])
    for t, n in df.select("t", T.keyword_hits(F.col("t"), "covid-19")).collect():
        assert n == len(re.findall(r"\bcovid-19\b", t.lower()))


@pytest.mark.parametrize("keyword", ["", "-x", "x-", "a\\Eb"])
def test_keyword_must_be_a_word(keyword):
    with pytest.raises(ValueError):
        T.keyword_hits(None, keyword)


def test_cleaning(rows):
    df = rows("t string", ("ab,C-1",), ("č",), ("Žena 1x Éa",))
    assert [r[0] for r in df.select(T.clean_text(F.col("t"))).collect()] == ["abc1", "", "ena 1x a"]
    assert values(W.clean_words(df, "t")) == [("1x",), ("a",), ("abc1",), ("ena",)]
    assert [r[0] for r in df.select(T.ascii_strip(F.col("t"))).collect()] == ["ab,C-1", "", "ena 1x a"]
    assert [r[0] for r in df.select(T.first_letters(F.col("t"))).collect()] == [["a"], ["č"], ["Ž", "É"]]
    assert values(W.letter_count(df, "t")) == [("a", 1), ("é", 1), ("č", 1), ("ž", 1)]


def test_word_count_ascii_keeps_collisions(rows):
    df = rows("t string", ("čau au ☃ au",))
    assert values(W.word_count_ascii(df, "t")) == [("au", 1), ("au", 2)]


def test_top_words_ties_and_length(rows):
    df = rows("t string", ("beta alpha Alpha beta of of of",))
    assert [tuple(r) for r in W.top_words(df, "t", 2).collect()] == [("of", 3), ("alpha", 2)]
    assert [tuple(r) for r in W.top_words(df, "t", 5, 4).collect()] == [("alpha", 2), ("beta", 2)]


def test_avg_word_length(rows):
    assert W.avg_word_length(rows("t string", ("a a bbb",)), "t").first()[0] == 2.0
    assert W.avg_word_length(rows("t string", ("",)), "t").first()[0] is None


def test_changelog(rows):
    log = rows("value string", ("(a,1)",), (" (b, 2)",), ("(a,3)",), ("(a,2)",), ("junk",))
    assert [tuple(r) for r in W.changelog_compact(log).collect()] == [("a", 3), ("b", 2)]


def test_keyword_top_is_stable_and_not_merged(rows):
    df = rows("doc_id long, title string, content string",
              (1, "t", "the the"), (2, "t", "the the"), (3, "u", "the the the"), (4, "v", "x"))
    top = W.keyword_top(df, "content", "the", "doc_id", 5)
    assert [tuple(r) for r in top.collect()] == [(3, "u", 3), (1, "t", 2), (2, "t", 2)]


def test_dates(rows):
    given = {
        "2022-01-05": "2022-01-05 00:00:00", "2022-1-5": "2022-01-05 00:00:00",
        "5. 3. 2021 9:07": "2021-03-05 09:07:00", "05.  03. 2021 19:07": "2021-03-05 19:07:00",
        "Nov 5, 2021 v 19:07 CET": "2021-11-05 19:07:00", "Xyz 5, 2021 v 19:07 CET": None,
        "anf 5, 2021 v 19:07 CET": None, "2022-02-30": None, "30. 2. 2022 10:00": None,
        "5.3.2021 9:07": None, "2022-01-05 10:00": None, "Datum nenalezeno": None, "": None, None: None,
    }
    df = rows("d string", *[(d,) for d in given])
    parsed = df.select("d", parse_date(F.col("d")).cast("string"),
                       parse_date(F.col("d"), named_months=False).cast("string"))
    for d, full, two in parsed.collect():
        assert full == given[d]
        assert two == (None if d and d.startswith("Nov") else given[d])


def test_numbers(rows):
    given = {"(12 příspěvků)": 12, "12": 12, "": 0, None: 0, "none": 0, "7 dní": 0}
    df = rows("t string", *[(t,) for t in given])
    for t, n in df.select("t", V.comment_total(F.col("t"))).collect():
        assert n == given[t]
    assert [r[0] for r in df.select(V.extract_int(F.col("t"))).collect()] == [12, 12, 0, 0, 0, 7]
    urls = rows("u string", ("https://a/b/c",), ("https://a",), (None,))
    assert [r[0] for r in urls.select(V.url_segment(F.col("u"))).collect()] == ["b", None, None]
    flags = rows("c string", ("válka",), ("mír",), (None,))
    assert [r[0] for r in flags.select(V.match_flag(F.col("c"), "%válka%")).collect()] == [1, 0, None]
