"""Test tables, and views that give them the shape of the inputs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.sources.files import spread

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TEXT = {"documents", "pages"}

# Portable SQL: run by Spark and, as CTEs, by the checking database.
VIEWS = {
    "v_articles": """
select d.doc_id,
 'https://news.example/' || d.source || '/' || cast(d.doc_id as string) as url,
 d.source || '-' || cast(d.doc_id % 50 as string) as title,
 d.text as content, d.source as category,
 case when d.doc_id % 7 = 0 then null else cast(d.doc_id % 11 as int) end as image_count,
 case when d.doc_id % 10 = 9 then 'Datum nenalezeno'
      when d.doc_id % 2 = 0 then cast(year(o.o_orderdate) as string) || '-'
        || lpad(cast(month(o.o_orderdate) as string), 2, '0') || '-'
        || lpad(cast(day(o.o_orderdate) as string), 2, '0')
      else cast(day(o.o_orderdate) as string) || '. ' || cast(month(o.o_orderdate) as string)
        || '. ' || cast(year(o.o_orderdate) as string) || ' 09:30' end as publication_date,
 case when d.doc_id % 5 = 0 then null
      when d.doc_id % 3 = 0 then '(' || cast((d.doc_id * 37) % 400 as string) || ' příspěvků)'
      else cast((d.doc_id * 37) % 400 as string) end as comment_count
from documents d join orders o on o.o_orderkey = d.doc_id""",
    "v_ratings": """
select o.o_custkey as user_id, l.l_partkey as movie_id,
 cast(l.l_quantity as int) % 5 + 1 as score,
 l.l_orderkey * 8 + l.l_linenumber as seq
from lineitem l join orders o on l.l_orderkey = o.o_orderkey""",
    "v_movies": "select p_partkey as movie_id, p_name as title from part",
    "v_person": """
select c_custkey as id, c_name as name, cast(1940 + c_custkey % 60 as int) as born
from customer""",
    "v_acted_in": """
select o.o_custkey as src, l.l_partkey as dst,
 sum(case when l.l_returnflag <> 'R' then cast(l.l_extendedprice as decimal(18,2)) end) as earnings
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
group by o.o_custkey, l.l_partkey""",
    "v_has_contact": """
select a.src, b.c_custkey as dst
from (select c_custkey as src, c_custkey + 1 as other from customer
      union all select c_custkey, c_custkey + 7 from customer) a
join customer b on b.c_custkey = a.other""",
    "v_hero_lines": """
select l_orderkey * 8 + l_linenumber as line_no,
 ' ' || cast(l_partkey as string)
 || case when l_linenumber >= 2 then ' ' || cast(l_suppkey as string) else '' end
 || case when l_linenumber >= 4 then ' ' || cast(l_orderkey as string) else '' end || ' ' as value
from lineitem""",
    "v_station_lines": """
select event_id, 'ST' || cast(user_id % 20 as string) || ',' || '18000101' || ','
 || case when event_type = 'click' then 'TMAX' when event_type = 'view' then 'TMIN'
    else 'PRCP' end || ','
 || cast(cast(floor(value) as int) - 75 as string) || ',,,E,' as value
from events""",
    "v_arrivals": """
select event_id, ts, user_id, event_type, value,
 event_id + (event_id * 7919) % 13 as arrival_seq
from events""",
    "v_late": """
select event_id, ts, event_type, event_id + case when event_type = 'error'
 then cast(floor((select max(event_id) from events) * 0.4) as bigint) else 0 end as arrival_seq
from events""",
    "v_messages": """
select event_id,
 case event_id % 10
  when 3 then replace(props, 'k', 'x')
  when 4 then 'not json'
  when 5 then replace(replace(props, '}', ''), '{', '')
  when 6 then replace(props, ': ', ': "a')
  when 7 then replace(props, '}', ', "t": "' || event_type || '"}')
  when 8 then replace(props, '}', ', "t": "' || event_type || '", "z": [1]}')
  else props end as value
from events""",
    "v_log": """
select '(' || chr(cast(97 + user_id % 26 as int)) || ',' || cast(event_id as string) || ')' as value
from events""",
}
_DEPENDS = {name: [n for n in BASE if re.search(rf"\b{n}\b", sql)] for name, sql in VIEWS.items()}


def with_views(sql: str) -> str:
    """``sql`` with the views it names in front."""
    used = [name for name in VIEWS if re.search(rf"\b{name}\b", sql)]
    if not used:
        return sql.strip()
    ctes = ",\n".join(f"{name} as ({VIEWS[name].strip()})" for name in used)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"


class Tables:
    """Base tables and views of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = str(sf_dir).rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        if name in BASE:
            table = self.spark.read.parquet(self.path(name))
            return spread(table) if name in TEXT else table
        text = VIEWS[name].replace("{", "{{").replace("}", "}}")
        for base in _DEPENDS[name]:
            text = re.sub(rf"\b(from|join) {base}\b", rf"\1 {{{base}}}", text)
        return self.spark.sql(text, **{base: self[base] for base in _DEPENDS[name]})

    def acted_in(self, buckets: int) -> DataFrame:
        """``v_acted_in``, its lines dealt into buckets before they are added up: a task holds the sums of one bucket."""
        lines = self["lineitem"].join(self["orders"], F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").alias("src"), F.col("l_partkey").alias("dst"), "l_returnflag", "l_extendedprice")
        kept = F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice").cast("decimal(18,2)"))
        return lines.repartition(buckets, "src", "dst").groupBy("src", "dst").agg(F.sum(kept).alias("earnings"))

    def movies(self) -> DataFrame:
        """Movies as nodes of the property graph."""
        return self["v_movies"].select(
            F.col("movie_id").alias("id"), F.array(F.lit("Movie")).alias("labels"), "title"
        )

    def persons(self) -> DataFrame:
        return self["v_person"].withColumn("labels", F.array(F.lit("Person")))
