"""One query for each operator of this folder over the whole of its table."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import (
    bpe, collocations, decontaminate, html_text, licenses, line_dedup, near_dups, neighbours, quality, sharding,
    token_alignment, url_filter, warc,
)
from tallyfold.session import materialize, scratch_path

#: Vocabulary file of op3 and the pipeline; None: the installed public tokenizer.
TOKENIZER: str | None = None

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        REGISTRY[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_sharding")
def op1(spark: SparkSession, sf_dir: str, shards: int = 24) -> DataFrame:
    """All documents in 24 shards of near equal bytes."""
    records = materialize(sharding.record_facts(table(spark, sf_dir, "documents")), "records")
    slot_map = materialize(
        sharding.balanced_map(sharding.slot_sizes(records), shards), "slot-map")
    return sharding.placed_records(records, slot_map).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version",
    )


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    if TOKENIZER is not None and name == "byte_bpe_50k.json":
        return TOKENIZER
    import public_tokenizers

    return str(public_tokenizers.path(name))


def digest(ids: str) -> Column:
    """Lowercase hex of SHA-256 over decimal ids joined by commas."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256)


@query("op3_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again; digests of both."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, tokenizer_path()).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), digest("ids").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


OP6_SQL = r"""with d as (select row_number() over () as r, doc_id, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select cast(item_id as varchar) as item, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark where item_id is not null),
windows as (select distinct item, least(len(w), 10) as n, list_slice(w, s, s + least(len(w), 10) - 1) as gram
 from (select item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) as s from b where len(w) > 0)),
grams as (select r, p, n, list_slice(w, p, p + n - 1) as gram from (
 select r, w, n, unnest(range(1, len(w) - n + 2)) as p from d, (select distinct n from windows) where len(w) >= n)),
hits as (select r, p, g.n, item from grams g join windows using (gram)),
words as (select r, count(distinct q) as n_hit from (select r, unnest(range(p, p + n)) as q from hits) group by r),
items as (select r, count(*) as n_items, string_agg(item, ',' order by item) as listed
 from (select distinct r, item from hits) group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
 sha256(coalesce(listed, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (r) left join items using (r)"""


@query("op6_decontamination", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside 10-word windows of benchmark items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", decontaminate.hit_words("hits").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


OP7_SQL = r"""with recursive d as (select doc_id, list_filter(regexp_split_to_array(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
s as (select distinct doc_id, list_slice(w, p, p + 1) as gram
 from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 1) + 1)) as p from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.gram = b.gram and a.doc_id < b.doc_id
 group by 1, 2),
links as (select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b
 where 100 * k >= 80 * (x.n + y.n - k)),
ways as (select a, b from links union all select b, a from links),
reach(doc, seen) as (select a, a from ways union select reach.doc, b from reach join ways on ways.a = reach.seen),
least_ as (select doc, min(seen) as component_id from reach group by doc)
select d.doc_id, coalesce(n, 0) as n_shingles, coalesce(component_id, d.doc_id) as component_id,
 coalesce(component_id, d.doc_id) = d.doc_id as kept
from d left join n using (doc_id) left join least_ on doc = d.doc_id"""


@query("op7_near_duplicates", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document, on 2-word shingles at a similarity of 0.8."""
    return near_dups.near_duplicate_classes(table(spark, sf_dir, "documents"))


@query("op8_line_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the repeated blocks of lines, and the line spans removed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.without_repeated_lines(docs).select("doc_id", "text", "removed")


#: A text of at least this score counts as good.
QUALITY_FLOOR = 0.3


@query("op10_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; one pass over the texts, all else on their few numbers."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = materialize(quality.with_features(docs).drop("text"), "features")
    model = quality.train(measured, table(spark, sf_dir, "labels"))
    return quality.scored(measured, model).select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= QUALITY_FLOOR).cast("int").alias("predicted"),
    )


# On the test pages the article is an element of that name; of markup in it only <b> is inside words.
OP5_SQL = r"""with a as (select page_id, url, regexp_replace(regexp_replace(
  coalesce(regexp_extract(html, '<article>(.*)</article>', 1, 's'), ''), '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') as raw from pages),
t as (select page_id, url, trim(regexp_replace(regexp_replace(replace(raw, '&quot;', '"'), '&amp;?', '&', 'g'),
  '\s+', ' ', 'g')) as text from a)
select page_id, url, text, cast(length(text) as bigint) as n_chars from t"""


@query("op5_html_text", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op2_neighbours")
def op2(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    """The 10 nearest found for every row whose id is divisible by 100."""
    index = neighbours.build_index(table(spark, sf_dir, "embeddings"), k)
    return neighbours.search(index, index.rows.filter("vec_id % 100 = 0"), k)


@query("op9_url_filter")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on the URL of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = url_filter.train(url_filter.seed_labels(pages))
    return url_filter.judged(pages, model).select(
        "page_id", "host", "path", "rule", "verdict", F.col("bad").alias("bad_probability"))


@query("op4_license_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licenses found in every document, and the best of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scanned(docs).select(
        "doc_id", F.try_element_at("licenses", F.lit(1))["license_id"].alias("license_id"),
        F.try_element_at("licenses", F.lit(1))["coverage"].alias("coverage"), "licenses")


OP13_SQL = r"""with pieces as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[.,;:!?\x0A-\x0D]')) as piece from documents),
w as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
totals as (select lang, cast(sum(len(w)) as bigint) as n from w group by lang),
grams as (select lang, size, array_to_string(list_slice(w, s, s + size - 1), ' ') as phrase from (
 select lang, w, size, unnest(range(1, len(w) - size + 2)) as s from w, (select unnest([1, 2, 3]) as size) where len(w) >= size)),
f as (select lang, size, phrase, count(*) as a from grams group by all having count(*) >= 10),
words as (select *, string_split(phrase, ' ') as w from f where size > 1),
cuts as (select c.*, array_to_string(list_slice(w, 1, k), ' ') as x, array_to_string(list_slice(w, k + 1, size), ' ') as y
 from (select *, unnest(range(1, size)) as k from words) c),
scored as (select c.lang, c.size, c.phrase, c.a, k, x.a as l, y.a as r, cast((1000000::hugeint * c.a * c.a) // (x.a::hugeint * y.a) as bigint) as score
 from cuts c join f x on x.lang = c.lang and x.phrase = c.x join f y on y.lang = c.lang and y.phrase = c.y),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
held as (select lang, phrase, max(a) as most from (
 select lang, array_to_string(list_slice(w, s, s + 1), ' ') as phrase, a from (
  select *, unnest([1, 2]) as s from words where size = 3)) group by all),
own as (select x.* from lowest x left join held h on h.lang = x.lang and h.phrase = x.phrase
 where h.most is null or 100 * h.most < 50 * x.a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from own join totals using (lang) qualify rank <= 2000"""


@query("op13_collocations", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of two to three words of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


OP12_SQL = """with p as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
 sha256(coalesce(html, '')) as payload_digest from pages),
f as (select payload_digest, min(page_id) as first from p where payload_bytes >= 100 group by all)
select page_id, payload_bytes, payload_digest,
 case when first < page_id then 'revisit' else 'response' end as record_type,
 case when first < page_id then first end as refers_to
from p left join f using (payload_digest)"""

#: WARC-Date of all records: the pages carry no time of their own.
ARCHIVED = datetime.datetime(2024, 1, 1)


@query("op12_warc", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path, ARCHIVED)
    return warc.read_archives(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op11_token_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned over every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = token_alignment.aligned(
        docs, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"), digests=True)
    return found.withColumnRenamed("groups", "groups_sha256")
