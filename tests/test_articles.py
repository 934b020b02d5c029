from collections import Counter

import pytest
from conftest import values

from tallyfold.operators import articles as A

SCHEMA = (
    "doc_id long, title string, content string, category string, image_count int, "
    "publication_date string, comment_count string"
)
DATA = [
    (1, "a", "jedna dvě tři", "x", 3, "2022-01-05", "(5 příspěvků)"),
    (2, "b", "jedna", "x", None, "6. 1. 2022 10:00", "9"),
    (3, "a", "the the", "y", 1, "2020-03-04", "2"),
    (4, "c", "", "y", 3, "Datum nenalezeno", None),
    (5, "b", "jedna", "z", 2, "Nov 5, 2021 v 19:07 CET", "9"),
    (6, "d", "čtyři slova jsou tady", "x", 0, "2020-03-04", "9"),
]


@pytest.fixture
def corpus(rows):
    return rows(SCHEMA, *DATA)


@pytest.fixture
def empty(rows):
    return rows(SCHEMA)


def test_counts(corpus):
    assert A.article_count(corpus).first()[0] == 6
    assert A.duplicate_articles(corpus).first()[0] == 1
    assert A.total_comments(corpus).first()[0] == 34
    assert A.total_words(corpus).first()[0] == 11
    assert A.count_comments_over(corpus, 5).first()[0] == 3
    assert A.avg_images(corpus).first()[0] == 9 / 6


def test_digest_tells_pairs_apart(rows):
    df = rows("doc_id long, title string, content string", (1, "ab", "c"), (2, "a", "bc"),
              (3, None, "c"), (4, "-", "c"), (5, "", "c"), (6, None, "c"))
    assert A.duplicate_articles(df).first()[0] == 1


def test_dates(corpus):
    assert A.oldest_article(corpus).first()[0] == "2020-03-04"
    assert values(A.articles_by_year(corpus)) == [(2020, 2), (2021, 1), (2022, 2)]
    assert values(A.category_count_in_year(corpus, 2022)) == [("x", 2)]
    assert tuple(A.busiest_months(corpus).first()) == (1, 2, 1, 2)  # the first seen wins both ties


def test_title_rule(corpus):
    # b: last value 9 at position 2, d: 9 at position 6, a: last value 2.
    assert tuple(A.most_commented(corpus).first()) == ("b", 9)
    assert tuple(A.most_images(corpus).first()) == ("c", 3)
    assert tuple(A.longest_shortest_article(corpus).first()) == ("d", 4, "c", 0)


def test_categories(corpus):
    assert values(A.articles_by_category(corpus)) == [("x", 3, 3), ("y", 2, 3), ("z", 1, 3)]
    assert values(A.category_share(corpus)) == [("x", 3, 60.0), ("y", 1, 20.0), ("z", 1, 20.0)]


def test_charts(corpus):
    assert dict(values(A.weekday_histogram(corpus))) == {0: 0, 1: 0, 2: 3, 3: 1, 4: 1, 5: 0, 6: 0}
    assert [t[1:] for t in values(A.cumulative_articles(corpus), "at", "n", "total")] == [
        (2, 2), (1, 3), (1, 4), (1, 5)]
    assert values(A.length_vs_comments(corpus)) == [(1, 3, 5), (2, 1, 9), (3, 2, 2), (5, 1, 9), (6, 4, 9)]
    assert values(A.length_comment_summary(corpus, 2)) == [
        (0, 2, 18, 9.0), (2, 2, 7, 3.5), (4, 1, 9, 9.0)]


def test_cumulative_by_minute(corpus):
    got = values(A.cumulative_articles(corpus, "minute"), "at", "total")
    assert [n for _, n in got] == [2, 3, 4, 5] and got[-1][0].hour == 10


def test_word_histogram(corpus, rows):
    got = A.word_histogram(corpus, bins=3).orderBy("bin").collect()
    assert [tuple(r) for r in got] == [(0, 1.0, 2.0, 2), (1, 2.0, 3.0, 1), (2, 3.0, 4.0, 2)]
    same = rows(SCHEMA, *[(i, "t", "a b", "x", 0, "2022-01-05", "0") for i in range(4)])
    flat = A.word_histogram(same, bins=20).filter("n > 0").collect()
    assert [tuple(r) for r in flat] == [(10, 2.0, 2.05, 4)]


def test_empty_corpus(empty):
    assert A.article_count(empty).first()[0] == 0
    assert A.oldest_article(empty).first()[0] is None
    assert A.avg_images(empty).first()[0] == 0.0
    assert A.most_commented(empty).count() == 0
    assert A.word_histogram(empty).count() == 0
    assert A.articles_by_category(empty).count() == 0
    assert tuple(A.busiest_months(empty).first()) == (None,) * 4


def test_report_agrees_with_single_operators(corpus):
    report = {}
    for metric, key, value in A.corpus_report(corpus, 2022, "the").collect():
        report.setdefault(metric, Counter())[key] = value
    assert report["article_count"][""] == 6 and report["duplicate_articles"][""] == 1
    assert list(report["oldest_article"]) == ["2020-03-04"]
    assert report["articles_by_year"] == {"2020": 2, "2022": 2}  # two date formats only
    assert report["most_commented"] == {"b": 9} and report["most_images"] == {"c": 3}
    assert report["top_words_of_year"] == {"jedna": 2, "dvě": 1, "tři": 1}
    assert report["keyword_top_articles"] == {"a": 2}
    assert report["longest_article"] == {"d": 4} and report["shortest_article"] == {"c": 0}
    assert report["total_words"][""] == 11 and report["unique_categories"][""] == 3
    assert report["busiest_month"] == {"1": 2} and report["quietest_month"] == {"1": 2}
    words = "jedna dvě tři the čtyři slova jsou tady".split()
    assert report["avg_word_length"][""] == sum(map(len, words)) / len(words)


def test_report_reads_the_articles_once(spark, corpus, tmp_path, monkeypatch):
    corpus.write.parquet(f"{tmp_path}/articles")
    read, real = [], A.materialize
    monkeypatch.setattr(A, "materialize", lambda df, label: read.extend(df.inputFiles()) or real(df, label))
    A.corpus_report(spark.read.parquet(f"{tmp_path}/articles"), 2022, "the").collect()
    ours = [f for f in read if f"{tmp_path}/articles" in f]
    assert ours and len(ours) == len(set(ours))
