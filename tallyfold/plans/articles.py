"""Article corpus queries."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tallyfold.functions.dates import date_parts, parse_date
from tallyfold.functions.values import comment_total, null_default
from tallyfold.operators import articles as A
from tallyfold.operators import ordered
from tallyfold.operators import rows as R
from tallyfold.operators import tables as B
from tallyfold.operators import versions
from tallyfold.plans.fixtures import Tables
from tallyfold.plans.registry import query
from tallyfold.plans.text import KEYWORD, keyword_sql, tokens_sql, top_words_sql, words_sql
from tallyfold.sources.files import parse_json_records

YEAR = 1998

PUBLISHED = (
    "coalesce(try_strptime(publication_date, '%Y-%m-%d'), "
    "try_strptime(publication_date, '%-d. %-m. %Y %H:%M'))"
)
COMMENTS = (
    "coalesce(try_cast(comment_count as int), "
    "try_cast(regexp_extract(comment_count, '(\\d+)', 1) as int), 0)"
)
FACTS = f"""
facts as (select doc_id, title, content, category, {PUBLISHED} as published,
 {COMMENTS} as comments, coalesce(image_count, 0) as images,
 cast(len({words_sql('content')}) as bigint) as n_words,
 cast(len({tokens_sql('content')}) as bigint) as n_tokens from v_articles)"""


def per_title(value: str) -> str:
    return (
        f"titles as (select title, arg_max({value}, doc_id) as n, min(doc_id) as position "
        "from facts group by title)"
    )


@query("article_projection", "select publication_date, content, category, comment_count from v_articles")
def article_projection(t: Tables):
    return R.article_projection(t["v_articles"])


@query("parse_json_records", """
select event_id, try_cast(json_extract_string(value, '$.k') as int) as k,
 json_extract_string(value, '$.t') as t from v_messages where json_valid(value)
 and json_type(value) = 'OBJECT'""")
def parse_json_query(t: Tables):
    return parse_json_records(t["v_messages"], "k int, t string")


@query("first_n_records", "select o_orderkey, o_custkey, o_totalprice from orders order by o_orderkey limit 5000")
def first_n_records(t: Tables):
    chosen = ordered.first_n_records(t["orders"], "o_orderkey", 5_000)
    return chosen.select("o_orderkey", "o_custkey", "o_totalprice")


@query("capped_rows", """
select doc_id, n_bytes from (select doc_id, cast(strlen(text) as bigint) as n_bytes,
 sum(strlen(text)) over (order by doc_id) as total from documents) where total <= 1000000""")
def capped_rows(t: Tables):
    size = F.octet_length("text").cast("long")
    sized = t["documents"].select("doc_id", size.alias("n_bytes"))
    return ordered.capped_rows(sized, "doc_id", 1_000_000, F.col("n_bytes"))


@query("extract_int", f"select doc_id, {COMMENTS} as comments from v_articles")
def extract_int(t: Tables):
    return t["v_articles"].select("doc_id", comment_total(F.col("comment_count")).alias("comments"))


@query("parse_dates", f"select doc_id, {PUBLISHED} as published from v_articles")
def parse_dates(t: Tables):
    return t["v_articles"].select("doc_id", parse_date(F.col("publication_date")).alias("published"))


@query("date_parts", f"""
with {FACTS} select doc_id, cast(year(published) as int) as year, cast(month(published) as int) as month,
 cast(isodow(published) - 1 as int) as weekday from facts""")
def date_parts_query(t: Tables):
    return A.article_facts(t["v_articles"]).select("doc_id", *date_parts(F.col("published")))


@query("null_default", "select doc_id, coalesce(image_count, 0) as images from v_articles")
def null_default_query(t: Tables):
    return t["v_articles"].select("doc_id", null_default(F.col("image_count")).alias("images"))


@query("filter_gt_project", f"with {FACTS} select title, comments from facts where comments > 100")
def filter_gt_project(t: Tables):
    return R.filter_gt_project(A.article_facts(t["v_articles"]), "comments", 100, ["title", "comments"])


@query("filter_flag_notnull", f"""
select doc_id, image_count from v_articles where {COMMENTS} = 0 and image_count is not null""")
def filter_flag_notnull(t: Tables):
    facts = A.article_facts(t["v_articles"])
    return R.filter_flag_notnull(facts, F.col("comments") == 0, "image_count").select(
        "doc_id", "image_count"
    )


@query("filter_string_range", f"""
select doc_id, publication_date from v_articles
where publication_date >= '{YEAR}-01-01' and publication_date < '{YEAR + 1}-01-01'""")
def filter_string_range(t: Tables):
    return R.filter_string_range(
        t["v_articles"], "publication_date", f"{YEAR}-01-01", f"{YEAR + 1}-01-01"
    ).select("doc_id", "publication_date")


@query("filter_time_range", f"""
with {FACTS} select doc_id, published from facts
where published >= timestamp '{YEAR}-01-01' and published < timestamp '{YEAR + 1}-01-01'""")
def filter_time_range(t: Tables):
    return R.filter_time_range(
        A.article_facts(t["v_articles"]), "published", f"{YEAR}-01-01", f"{YEAR + 1}-01-01"
    ).select("doc_id", "published")


@query("article_count", "select count(*) as n from v_articles")
def article_count(t: Tables):
    return A.article_count(t["v_articles"])


@query("duplicate_articles", """
select count(*) as n from (
 select title, content from v_articles group by title, content having count(*) > 1)""")
def duplicate_articles(t: Tables):
    return A.duplicate_articles(t["v_articles"])


@query("duplicate_contents", """
select count(*) as n from (
 select category, content from v_articles group by category, content having count(*) > 1)""")
def duplicate_contents(t: Tables):
    """The same count with the category as title, which the test articles do repeat."""
    articles = t["v_articles"].withColumn("title", F.col("category"))
    return A.duplicate_articles(articles)


@query("oldest_article", f"with {FACTS} select strftime(min(published), '%Y-%m-%d') as oldest from facts")
def oldest_article(t: Tables):
    return A.oldest_article(t["v_articles"])


@query("most_commented", f"""
with {FACTS}, {per_title('comments')}
select title, n from titles order by n desc, position limit 1""")
def most_commented(t: Tables):
    return A.most_commented(t["v_articles"])


@query("most_images", f"""
with {FACTS}, {per_title('images')}
select title, n from titles order by n desc, position limit 1""")
def most_images(t: Tables):
    return A.most_images(t["v_articles"])


_ENDS = """
select a.title as longest_title, a.n as longest_words, b.title as shortest_title,
 b.n as shortest_words
from (select title, n from titles order by n desc, position limit 1) a,
 (select title, n from titles order by n, position limit 1) b"""


@query("longest_shortest_article", f"with {FACTS}, {per_title('n_words')} {_ENDS}")
def longest_shortest_article(t: Tables):
    return A.longest_shortest_article(t["v_articles"])


@query("articles_by_year", f"""
with {FACTS} select cast(year(published) as int) as year, count(*) as n from facts
where published is not null group by 1""")
def articles_by_year(t: Tables):
    return A.articles_by_year(t["v_articles"])


@query("articles_by_category", """
select category, count(*) as n, count(*) over () as n_categories
from v_articles group by category""")
def articles_by_category(t: Tables):
    return A.articles_by_category(t["v_articles"])


@query("category_share", f"""
with {FACTS}, counts as (select category, count(*) as n from facts where published is not null
 group by category), whole as (select cast(sum(n) as bigint) as w from counts)
select category, n, ((2000 * n + w) // (2 * w)) / 10.0::double as percent from counts, whole""")
def category_share(t: Tables):
    return A.category_share(t["v_articles"])


@query("total_comments", f"with {FACTS} select cast(sum(comments) as bigint) as n from facts")
def total_comments(t: Tables):
    return A.total_comments(t["v_articles"])


@query("total_words", f"with {FACTS} select cast(sum(n_words) as bigint) as n from facts")
def total_words(t: Tables):
    return A.total_words(t["v_articles"])


@query("top_words_of_year", top_words_sql("v_articles", "content", 5, 1, f"year({PUBLISHED}) = {YEAR}"))
def top_words_of_year(t: Tables):
    return A.top_words_of_year(t["v_articles"], YEAR, 5)


_MONTHS = """
months as (select cast(month(published) as int) as month, count(*) as n, min(doc_id) as position
 from facts where published is not null group by 1)"""


@query("busiest_months", f"""
with {FACTS}, {_MONTHS}
select a.month as most_month, a.n as most_n, b.month as least_month, b.n as least_n
from (select * from months order by n desc, position limit 1) a,
 (select * from months order by n, position limit 1) b""")
def busiest_months(t: Tables):
    return A.busiest_months(t["v_articles"])


@query("avg_images", """
select cast(sum(coalesce(image_count, 0)) as double) / count(*) as avg_images from v_articles""")
def avg_images(t: Tables):
    return A.avg_images(t["v_articles"])


@query("count_comments_over", f"with {FACTS} select count(*) as n from facts where comments > 100")
def count_comments_over(t: Tables):
    return A.count_comments_over(t["v_articles"], 100)


@query("category_count_in_year", f"""
with {FACTS} select category, count(*) as n from facts where year(published) = {YEAR}
group by category""")
def category_count_in_year(t: Tables):
    return A.category_count_in_year(t["v_articles"], YEAR)


@query("word_histogram", f"""
with {FACTS}, x as (select n_tokens as v from facts where published is not null),
b as (select min(v) * 2 as low, max(v) * 2 as high from x),
c as (select least((2 * v - low) * 20 // (high - low), 19) as bin, count(*) as n
 from x, b group by 1)
select r.i as bin, (low * 20 + r.i * (high - low)) / 40.0::double as bin_low,
 (low * 20 + (r.i + 1) * (high - low)) / 40.0::double as bin_high, coalesce(c.n, 0) as n
from b, range(20) r(i) left join c on c.bin = r.i""")
def word_histogram(t: Tables):
    return A.word_histogram(t["v_articles"])


@query("weekday_histogram", f"""
with {FACTS} select cast(r.i as int) as weekday, count(published) as n
from range(7) r(i) left join facts on isodow(published) - 1 = r.i group by r.i""")
def weekday_histogram(t: Tables):
    return A.weekday_histogram(t["v_articles"])


@query("cumulative_articles", f"""
with {FACTS} select date_trunc('day', published)::timestamp as at, count(*) as n,
 cast(sum(count(*)) over (order by date_trunc('day', published)) as bigint) as total
from facts where published is not null group by 1, date_trunc('day', published)""")
def cumulative_articles(t: Tables):
    return A.cumulative_articles(t["v_articles"])


@query("length_vs_comments", f"""
with {FACTS} select doc_id, n_tokens, comments from facts where published is not null""")
def length_vs_comments(t: Tables):
    return A.length_vs_comments(t["v_articles"])


@query("length_comment_summary", f"""
with {FACTS} select n_tokens // 100 * 100 as length_from, count(*) as n,
 cast(sum(comments) as bigint) as comments,
 cast(sum(comments) as double) / count(*) as avg_comments
from facts where published is not null group by 1""")
def length_comment_summary(t: Tables):
    return A.length_comment_summary(t["v_articles"])


@query("length_comment_corr", f"""
with {FACTS} select round(corr(n_tokens, comments), 6) as corr from facts where published is not null""")
def length_comment_corr(t: Tables):
    return A.length_comment_corr(t["v_articles"])


@query("random_article", """
select doc_id, title from v_articles order by md5('42-' || cast(doc_id as varchar)), doc_id limit 1""")
def random_article(t: Tables):
    return R.random_rows(t["v_articles"], "doc_id").select("doc_id", "title")


@query("delete_older_than", f"""
with {FACTS} select doc_id, url_id as title, published, removed from (
 select doc_id, title as url_id, published, cast(count_if(published < timestamp '{YEAR}-01-01') over () as bigint) as removed
 from facts) where published is null or published >= timestamp '{YEAR}-01-01'""")
def delete_older_than(t: Tables):
    facts = A.article_facts(t["v_articles"]).select("doc_id", "title", "published")
    left, removed = versions.delete_before(versions.create(facts, "published"), datetime.datetime(YEAR, 1, 1))
    return left.rows().withColumn("removed", F.lit(removed).cast("long"))


@query("frontier_new_urls", """
select distinct url from (select 'https://news.example/' || source || '/' || cast(doc_id as string) as url
 from documents) where url not in (select url from v_articles where category in ('src0', 'src1'))""")
def frontier_new_urls(t: Tables):
    source, doc = F.col("source"), F.col("doc_id").cast("string")
    candidates = t["documents"].select(
        F.concat(F.lit("https://news.example/"), source, F.lit("/"), doc).alias("url")
    )
    collected = t["v_articles"].filter(F.col("category").isin("src0", "src1"))
    return B.frontier_new_urls(candidates.unionByName(candidates), collected)


@query("anti_join_seen", """
select doc_id, lang from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)""")
def anti_join_seen(t: Tables):
    return B.anti_join_seen(t["documents"].select("doc_id", "lang"), t["labels"], "doc_id")


@query("incremental_append", """
with seen as (select title as url, doc_id from v_articles where category in ('src0', 'src1')),
fresh as (select title as url, min(doc_id) as doc_id from v_articles
 where title not in (select url from seen) group by title)
select url, doc_id from seen union all select url, doc_id from fresh""")
def incremental_append(t: Tables):
    articles = t["v_articles"].select(F.col("title").alias("url"), "doc_id", "category")
    old = F.col("category").isin("src0", "src1")
    collected = articles.filter(old).drop("category")
    batch = articles.filter(~old).drop("category")
    fresh = B.incremental_append(collected, batch, "url", "doc_id")
    return collected.unionByName(fresh)


_PART = "select '{}' as metric, {} as key, cast({} as double) as value from {}"


@query("corpus_report", "\n".join([
    f"with {FACTS}, {_MONTHS},",
    "c as " + per_title("comments").split(" as ", 1)[1] + ",",
    "i as " + per_title("images").split(" as ", 1)[1] + ",",
    per_title("n_words") + ",",
    f"""w as (select word, count(*) as n, count_if(in_year) as n_year from (
 select unnest({words_sql('content')}) as word, coalesce(year(published) = {YEAR}, false) as in_year
 from facts) group by word),
hits as (select doc_id, title, {keyword_sql('content', KEYWORD)} as n from facts)""",
    " union all ".join([
        _PART.format("article_count", "''", "count(*)", "facts"),
        _PART.format("duplicate_articles", "''", "count(*)", "(select title, content from facts "
                     "group by title, content having count(*) > 1)"),
        _PART.format("oldest_article", "strftime(min(published), '%Y-%m-%d')", "null", "facts"),
        _PART.format("most_commented", "title", "n", "(from c order by n desc, position limit 1)"),
        _PART.format("most_images", "title", "n", "(from i order by n desc, position limit 1)"),
        _PART.format("articles_by_year", "cast(year(published) as varchar)", "count(*)",
                     "facts where published is not null group by year(published)"),
        _PART.format("articles_by_category", "category", "count(*)", "facts group by category"),
        _PART.format("unique_categories", "''", "count(distinct category)", "facts"),
        _PART.format("top_words_of_year", "word", "n_year",
                     "(from w where n_year > 0 order by n_year desc, word limit 5)"),
        _PART.format("total_comments", "''", "sum(comments)", "facts"),
        _PART.format("total_words", "''", "sum(n_words)", "facts"),
        _PART.format("top_long_words", "word", "n",
                     "(from w where length(word) >= 6 order by n desc, word limit 8)"),
        _PART.format("keyword_top_articles", "title", "n",
                     "(from hits where n > 0 order by n desc, doc_id limit 3)"),
        _PART.format("longest_article", "title", "n",
                     "(from titles order by n desc, position limit 1)"),
        _PART.format("shortest_article", "title", "n", "(from titles order by n, position limit 1)"),
        _PART.format("avg_word_length", "''", "sum(length(word))::double / count(*)", "w"),
        _PART.format("busiest_month", "cast(month as varchar)", "n",
                     "(from months order by n desc, position limit 1)"),
        _PART.format("quietest_month", "cast(month as varchar)", "n",
                     "(from months order by n, position limit 1)"),
    ]),
]))
def corpus_report(t: Tables):
    return A.corpus_report(t["v_articles"], YEAR, KEYWORD)
