"""Statistics of an article corpus.

Articles carry ``doc_id`` as input order. Reports keyed by title follow one rule:
the last article of a title sets its value, the first one its position, and the
earliest position wins a tie.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfold.functions.dates import parse_date
from tallyfold.functions.text import keyword_hits, whitespace_token_total, word_total, words
from tallyfold.functions.values import comment_total, null_default, ratio
from tallyfold.operators.rows import filter_time_range
from tallyfold.operators.words import top_words
from tallyfold.session import materialize

ORDER = "doc_id"


def article_facts(articles: DataFrame, named_months: bool = True) -> DataFrame:
    """``articles`` with parsed date and comments, word totals and image default."""
    return articles.withColumns({
        "published": parse_date(F.col("publication_date"), named_months),
        "comments": comment_total(F.col("comment_count")),
        "images": null_default(F.col("image_count")),
        "n_words": word_total(F.col("content")).cast("long"),
        "n_tokens": whitespace_token_total(F.col("content")).cast("long"),
    })


def dated(articles: DataFrame, named_months: bool = True) -> DataFrame:
    """Facts of the articles whose date is known."""
    return article_facts(articles, named_months).filter(F.col("published").isNotNull())


def article_count(articles: DataFrame) -> DataFrame:
    return articles.agg(F.count("*").alias("n"))


def article_digest(title: Column, content: Column) -> Column:
    """256-bit digest that stands for the pair of title and content."""
    def framed(text: Column) -> Column:
        return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(framed(title), framed(content)), 256))


def duplicate_articles(articles: DataFrame) -> DataFrame:
    """Number of (title, content) pairs that occur more than once.

    Groups by digest, so the texts themselves are not shuffled, and copies are
    already counted in the task that read them.
    """
    pairs = articles.select(article_digest(F.col("title"), F.col("content")).alias("digest"))
    return _repeated(pairs)


def _repeated(pairs: DataFrame) -> DataFrame:
    groups = pairs.groupBy("digest").agg(F.count("*").alias("copies"))
    return groups.filter(F.col("copies") > 1).agg(F.count("*").alias("n"))


def oldest_article(articles: DataFrame) -> DataFrame:
    """First publication day as text; null when no date is known."""
    facts = article_facts(articles, named_months=False)
    return facts.agg(F.date_format(F.min("published"), "yyyy-MM-dd").alias("oldest"))


def per_title(facts: DataFrame, value: str) -> DataFrame:
    """Value and position of each title."""
    return facts.groupBy("title").agg(
        F.max_by(value, ORDER).alias("n"), F.min(ORDER).alias("position")
    )


def best_title(facts: DataFrame, value: str) -> DataFrame:
    """Title with the largest value."""
    return per_title(facts, value).orderBy(F.desc("n"), "position").limit(1).select("title", "n")


def most_commented(articles: DataFrame) -> DataFrame:
    return best_title(article_facts(articles), "comments")


def most_images(articles: DataFrame) -> DataFrame:
    return best_title(article_facts(articles), "images")


def extreme_titles(facts: DataFrame, value: str) -> DataFrame:
    """Titles with the largest and the smallest value, in one pass."""
    ranked = per_title(facts, value)
    top = F.max(F.struct("n", (-F.col("position")).alias("p"), "title"))
    bottom = F.min(F.struct("n", "position", "title"))
    return ranked.agg(top.alias("hi"), bottom.alias("lo")).select(
        F.col("hi.title").alias("longest_title"), F.col("hi.n").alias("longest_words"),
        F.col("lo.title").alias("shortest_title"), F.col("lo.n").alias("shortest_words"),
    )


def longest_shortest_article(articles: DataFrame) -> DataFrame:
    return extreme_titles(article_facts(articles), "n_words")


def articles_by_year(articles: DataFrame) -> DataFrame:
    return dated(articles).groupBy(F.year("published").alias("year")).agg(F.count("*").alias("n"))


def articles_by_category(articles: DataFrame) -> DataFrame:
    """Articles per category, beside the number of categories."""
    counts = articles.groupBy("category").agg(F.count("*").alias("n"))
    return counts.withColumn("n_categories", counts.agg(F.count("*")).scalar())


def category_share(articles: DataFrame) -> DataFrame:
    """Percentage of the dated articles per category, to one decimal."""
    counts = dated(articles).groupBy("category").agg(F.count("*").alias("n"))
    whole = counts.agg(F.sum("n")).scalar()
    # Rounds half up in whole numbers: tenths of a percent.
    tenths = F.expr("(2000 * n + whole) div (2 * whole)")
    return counts.withColumn("whole", whole).select(
        "category", "n", (tenths / F.lit(10.0)).alias("percent")
    )


def total_comments(articles: DataFrame) -> DataFrame:
    return article_facts(articles).agg(F.sum("comments").alias("n"))


def total_words(articles: DataFrame) -> DataFrame:
    return article_facts(articles).agg(F.sum("n_words").alias("n"))


def top_words_of_year(articles: DataFrame, year: int, k: int = 5) -> DataFrame:
    """Most frequent words among the articles of one year."""
    chosen = dated(articles, named_months=False).filter(F.year("published") == year)
    return top_words(chosen, "content", k)


def busiest_months(articles: DataFrame) -> DataFrame:
    """Months of the year with most and fewest articles; the first seen wins a tie."""
    return _month_extremes(dated(articles, False).select(F.month("published").alias("month"), ORDER))


def _month_extremes(facts: DataFrame) -> DataFrame:
    months = facts.groupBy("month").agg(F.count("*").alias("n"), F.min(ORDER).alias("position"))
    top = F.max(F.struct("n", (-F.col("position")).alias("p"), "month"))
    bottom = F.min(F.struct("n", "position", "month"))
    return months.agg(top.alias("hi"), bottom.alias("lo")).select(
        F.col("hi.month").alias("most_month"), F.col("hi.n").alias("most_n"),
        F.col("lo.month").alias("least_month"), F.col("lo.n").alias("least_n"),
    )


def avg_images(articles: DataFrame) -> DataFrame:
    """Mean image count, a missing count being 0; 0 for an empty corpus."""
    mean = ratio(F.sum("images"), F.count("*"))
    return article_facts(articles).agg(null_default(mean, 0.0).alias("avg_images"))


def count_comments_over(articles: DataFrame, floor: int = 100) -> DataFrame:
    return article_facts(articles).filter(F.col("comments") > floor).agg(F.count("*").alias("n"))


def category_count_in_year(articles: DataFrame, year: int) -> DataFrame:
    chosen = filter_time_range(
        article_facts(articles), "published", f"{year}-01-01", f"{year + 1}-01-01"
    )
    return chosen.groupBy("category").agg(F.count("*").alias("n"))


def word_histogram(articles: DataFrame, bins: int = 20) -> DataFrame:
    """Equal-width bins of the token count of dated articles; the last bin is closed.

    Articles are first counted per length; bounds and bins are taken from that
    small table, so the texts are tokenized once. Bin numbers are computed in whole numbers on doubled lengths, because
    a single length gets a bin range of half a unit to either side.
    """
    lengths = materialize(
        dated(articles).groupBy(F.col("n_tokens").alias("x")).agg(F.count("*").alias("n")),
        "lengths",
    )
    same = F.when(F.min("x") == F.max("x"), 1).otherwise(0)
    low = lengths.agg(2 * F.min("x") - same).scalar()
    high = lengths.agg(2 * F.max("x") + same).scalar()
    bounded = lengths.withColumn("low", low).withColumn("high", high)
    binned = bounded.groupBy(
        F.expr(f"least((2 * x - low) * {bins} div (high - low), {bins - 1})").alias("bin")
    ).agg(F.sum("n").alias("n"))
    spark = articles.sparkSession
    edges = spark.range(bins).withColumn("low", low).withColumn("high", high)

    def edge(at: Column) -> Column:
        return (F.col("low") * bins + at * (F.col("high") - F.col("low"))) / F.lit(2.0 * bins)

    return edges.join(binned, edges["id"] == binned["bin"], "left").select(
        F.col("id").alias("bin"), edge(F.col("id")).alias("bin_low"),
        edge(F.col("id") + 1).alias("bin_high"), null_default(F.col("n")).alias("n"),
    ).filter(F.col("bin_low").isNotNull())


def weekday_histogram(articles: DataFrame) -> DataFrame:
    """Articles per weekday, Monday (0) to Sunday (6), days without any included."""
    counts = dated(articles).groupBy(F.weekday("published").alias("day")).agg(
        F.count("*").alias("n")
    )
    days = articles.sparkSession.range(7).select(F.col("id").cast("int").alias("weekday"))
    return days.join(counts, days["weekday"] == counts["day"], "left").select(
        "weekday", null_default(F.col("n")).alias("n")
    )


def cumulative_articles(articles: DataFrame, unit: str = "day") -> DataFrame:
    """Running article count over publication time, one row per ``unit``.

    Rows are counted per unit, then accumulated inside a month (44,640 minutes at
    most) on top of the months before (one row per calendar month).
    """
    at = F.date_trunc(unit, F.col("published")).cast("timestamp_ntz")
    counts = materialize(
        dated(articles).groupBy(at.alias("at")).agg(F.count("*").alias("n")), "times"
    ).withColumn("month", F.trunc("at", "month"))
    months = counts.groupBy("month").agg(F.sum("n").alias("month_n"))
    earlier = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    before = months.select("month", null_default(F.sum("month_n").over(earlier)).alias("before"))
    inside = Window.partitionBy("month").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return counts.join(before, "month").select(
        "at", "n", (F.col("before") + F.sum("n").over(inside)).alias("total")
    )


def length_vs_comments(articles: DataFrame) -> DataFrame:
    """Token and comment count of each dated article."""
    return dated(articles).select(ORDER, "n_tokens", "comments")


def length_comment_summary(articles: DataFrame, width: int = 100) -> DataFrame:
    """The same relation for a large corpus: comments per band of lengths."""
    band = F.expr(f"n_tokens div {width} * {width}")
    return dated(articles).groupBy(band.alias("length_from")).agg(
        F.count("*").alias("n"), F.sum("comments").alias("comments"),
        ratio(F.sum("comments"), F.count("*")).alias("avg_comments"),
    )


def length_comment_corr(articles: DataFrame) -> DataFrame:
    """Correlation of token and comment counts over the dated articles, to six decimals."""
    return dated(articles).agg(F.round(F.corr("n_tokens", "comments"), 6).alias("corr"))


def corpus_report(
    articles: DataFrame, year: int, keyword: str, long_word: int = 6,
    top_long: int = 8, top_year: int = 5, top_keyword: int = 3,
) -> DataFrame:
    """All corpus statistics as rows (metric, key, value).

    The articles are read once, so that a join they come from moves their texts once: the
    per-article facts are written with the text beside them, and words are counted from there.
    """
    raw = article_facts(articles, named_months=False)
    in_year = F.coalesce(F.year("published") == year, F.lit(False))
    facts = materialize(raw.select(
        ORDER, "title", "category", "comments", "images", "n_words",
        F.to_date("published").alias("day"), in_year.alias("in_year"), "content",
        keyword_hits(F.col("content"), keyword).cast("long").alias("hits"),
        article_digest(F.col("title"), F.col("content")).alias("digest"),
    ), "facts")
    counts = materialize(
        facts.select("in_year", F.explode(words(F.col("content"))).alias("word"))
        .groupBy("word").agg(F.count("*").alias("n"), F.count_if("in_year").alias("n_year")),
        "words",
    )
    days = facts.filter(F.col("day").isNotNull())
    ends = extreme_titles(facts, "n_words")
    months = _month_extremes(days.select(F.month("day").alias("month"), ORDER))
    none = F.lit("")

    def rows(df: DataFrame, metric: str, key: Column, value: Column) -> DataFrame:
        return df.select(
            F.lit(metric).alias("metric"), key.cast("string").alias("key"),
            value.cast("double").alias("value"),
        )

    n = F.col("n")
    sums = facts.agg(
        F.count("*").alias("articles"), F.min("day").alias("oldest"),
        F.sum("comments").alias("comments"), F.sum("n_words").alias("words"),
    )
    parts = [
        rows(sums, "article_count", none, F.col("articles")),
        rows(_repeated(facts.select("digest")), "duplicate_articles", none, n),
        rows(sums, "oldest_article", F.date_format("oldest", "yyyy-MM-dd"), F.lit(None)),
        rows(best_title(facts, "comments"), "most_commented", F.col("title"), n),
        rows(best_title(facts, "images"), "most_images", F.col("title"), n),
        rows(days.groupBy(F.year("day").alias("y")).agg(F.count("*").alias("n")),
             "articles_by_year", F.col("y"), n),
        rows(facts.groupBy("category").agg(F.count("*").alias("n")),
             "articles_by_category", F.col("category"), n),
        rows(facts.select("category").distinct().agg(F.count("*").alias("n")),
             "unique_categories", none, n),
        rows(counts.orderBy(F.desc("n_year"), "word").limit(top_year).filter("n_year > 0"),
             "top_words_of_year", F.col("word"), F.col("n_year")),
        rows(sums, "total_comments", none, F.col("comments")),
        rows(sums, "total_words", none, F.col("words")),
        rows(counts.filter(F.char_length("word") >= long_word)
             .orderBy(F.desc("n"), "word").limit(top_long), "top_long_words", F.col("word"), n),
        rows(facts.filter("hits > 0").orderBy(F.desc("hits"), ORDER).limit(top_keyword),
             "keyword_top_articles", F.col("title"), F.col("hits")),
        rows(ends, "longest_article", F.col("longest_title"), F.col("longest_words")),
        rows(ends, "shortest_article", F.col("shortest_title"), F.col("shortest_words")),
        rows(counts.agg(ratio(F.sum(F.char_length("word")), F.count("*")).alias("n")),
             "avg_word_length", none, n),
        rows(months, "busiest_month", F.col("most_month"), F.col("most_n")),
        rows(months, "quietest_month", F.col("least_month"), F.col("least_n")),
    ]
    return reduce(DataFrame.unionByName, parts)
