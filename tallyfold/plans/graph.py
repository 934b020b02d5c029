"""Movie-graph queries and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators import graph as G
from tallyfold.operators import stores
from tallyfold.plans.fixtures import Tables
from tallyfold.plans.registry import query
from tallyfold.session import materialize

MOVIE, PERSON = "red plate", "Customer#000000007"
NEW_ID = 10_000_000_000


@query("graph_any_nodes", """
select * from (select id, 'Person' as labels from v_person
 union all select movie_id, 'Movie' from v_movies) order by labels, id limit 10""")
def graph_any_nodes(t: Tables):
    return G.graph_any_nodes(t.persons(), t.movies(), k=10)


@query("graph_label_scan", "select movie_id as id, title from v_movies order by movie_id limit 10")
def graph_label_scan(t: Tables):
    return G.graph_label_scan(t.movies(), "Movie", "title", k=10)


@query("graph_in_neighbors", f"""
select p.name from v_acted_in e join v_movies m on e.dst = m.movie_id
join v_person p on e.src = p.id where m.title = '{MOVIE}' order by p.name""")
def graph_in_neighbors(t: Tables):
    return G.graph_in_neighbors(t.persons(), t["v_acted_in"], t.movies(), "title", MOVIE, "name")


@query("graph_out_neighbors", f"""
select m.title from v_acted_in e join v_movies m on e.dst = m.movie_id
join v_person p on e.src = p.id where p.name = '{PERSON}'""")
def graph_out_neighbors(t: Tables):
    return G.graph_out_neighbors(t.persons(), t["v_acted_in"], t.movies(), "name", PERSON, "title")


@query("graph_degree", f"""
select count(*) as n from v_acted_in e join v_person p on e.src = p.id where p.name = '{PERSON}'""")
def graph_degree(t: Tables):
    return G.graph_degree(t.persons(), t["v_acted_in"], "name", PERSON)


@query("graph_common_neighbors", """
with c as (select dst, min(src) as one, max(src) as other from v_acted_in group by dst
 having min(src) < max(src) order by dst limit 1)
select m.title from c join v_acted_in a on a.src = c.one join v_acted_in b on b.src = c.other and a.dst = b.dst
join v_movies m on a.dst = m.movie_id""")
def graph_common_neighbors(t: Tables):
    """Films of the first and last person of the first film that has two."""
    cast = t["v_acted_in"].groupBy("dst").agg(F.min("src").alias("one"), F.max("src").alias("other"))
    pair = cast.filter("one < other").orderBy("dst").first()
    names = {r["id"]: r["name"] for r in t["v_person"].filter(F.col("id").isin(pair["one"], pair["other"])).collect()}
    return G.graph_common_neighbors(
        t.persons(), t["v_acted_in"], t.movies(), "name", names[pair["one"]], names[pair["other"]], "title"
    )


def _new_roles(t: Tables, roles: DataFrame):
    """Suppliers as new persons beside customers that exist, with their parts."""
    lines = t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey")
    suppliers = lines.join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_name").alias("name"), (F.col("s_suppkey") + NEW_ID).alias("source_id"),
        F.col("l_partkey").alias("target_id"),
    )
    known = roles.join(t["v_person"], F.col("src") == F.col("id")).select(
        "name", F.col("id").alias("source_id"), F.col("dst").alias("target_id")
    )
    return suppliers.unionByName(known).withColumn("movie_key", F.col("target_id"))


@query("graph_merge_edge", f"""
select src, dst, cast(earnings as double) as earnings from v_acted_in
union all select distinct l_suppkey + {NEW_ID}, l_partkey, null::double from lineitem
join supplier on l_suppkey = s_suppkey""")
def graph_merge_edge(t: Tables):
    movies = t.movies().select("id", "labels", F.col("id").alias("movie_key"))
    # A line gives at most one stored and one new role.
    buckets = stores.bucket_count(t.spark, 2 * t["lineitem"].count())
    people, films = stores.create(t.persons().select("id", "labels", "name"), ["name"]), stores.create(movies, ["movie_key"])
    edges = stores.create(t.acted_in(buckets), ["src", "dst"], buckets)
    new = _new_roles(t, edges.rows())
    # Dealt before copies are dropped, so that a task holds one bucket's rows only.
    batch = materialize(new.repartition(buckets, *new.columns).distinct(), "new-roles")
    stores.merge_by_key(people, edges, films, batch, "Person", "Movie")
    return edges.rows().select("src", "dst", F.col("earnings").cast("double"))


@query("graph_merge_nodes", f"""
select id, name, born, 'Person' as labels from v_person
union all select distinct s_suppkey + {NEW_ID}, s_name, null::int, 'Person'
from supplier join lineitem on l_suppkey = s_suppkey""")
def graph_merge_nodes(t: Tables):
    batch = _new_roles(t, t["v_acted_in"]).select(
        "name", F.col("source_id").alias("id"), F.array(F.lit("Person")).alias("labels")
    )
    merged = G.graph_merge_nodes(t.persons(), batch, "name")
    return merged.select("id", "name", "born", F.array_join("labels", ",").alias("labels"))


@query("graph_set_property", """
select c_custkey as id, c_name as name, cast(1940 + c_custkey % 60 as int) as born, n_name as place
from customer left join (select n_nationkey, n_name from nation join region on n_regionkey = r_regionkey
 where r_name in ('ASIA', 'EUROPE')) on c_nationkey = n_nationkey""")
def graph_set_property(t: Tables):
    places = (
        t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        .filter(F.col("r_name").isin("ASIA", "EUROPE"))
        .select(F.col("c_custkey").alias("id"), F.col("n_name").alias("place"))
    )
    people = stores.create(t["v_person"], ["id"], t.spark.sparkContext.defaultParallelism)
    log = stores.create_property_log(people, "string")
    stores.set_property(log, places.select("id", F.lit("unknown").alias("value")), batch=0)
    stores.set_property(log, places.select("id", F.col("place").alias("value")), batch=1)
    return stores.with_property(people, log, "place").select("id", "name", "born", "place")


@query("graph_avg_edge_property", """
select cast(sum(earnings) as double) / count(*) as avg_value from v_acted_in where earnings is not null""")
def graph_avg_edge_property(t: Tables):
    return G.graph_avg_edge_property(t["v_acted_in"], "earnings")


@query("graph_undirected_hop", f"""
with near as (select dst as id from v_has_contact c join v_person p on c.src = p.id where p.name = '{PERSON}'
 union all select src from v_has_contact c join v_person p on c.dst = p.id where p.name = '{PERSON}')
select name, born, cast(earnings as double) as earnings from near join v_person p on near.id = p.id
join v_acted_in a on a.src = p.id where born >= 1943 and earnings >= 20000 order by earnings desc, name""")
def graph_undirected_hop(t: Tables):
    found = G.graph_undirected_hop(
        t["v_person"], t["v_has_contact"], t["v_acted_in"], PERSON, 1943, 20_000
    )
    return found.withColumn("earnings", F.col("earnings").cast("double"))


@query("graph_having_label", """
with rich as (select src, sum(earnings) as total from v_acted_in group by src having sum(earnings) > 1200000)
select id, name, born, case when total is null then 'Person' else 'Person,Rich' end as labels,
 cast(total as double) as total from v_person left join rich on src = id""")
def graph_having_label(t: Tables):
    marked = G.graph_having_label(t.persons(), t["v_acted_in"], "earnings", 1_200_000, "Rich")
    return marked.select(
        "id", "name", "born", F.array_join("labels", ",").alias("labels"),
        F.col("total").cast("double"),
    )


@query("graph_upsert_counter", """
with old as (select src, dst, cast(3 as bigint) as c from v_acted_in where earnings is null),
delta as (select user_id as src, movie_id as dst, count(*) as d from v_ratings where score = 5 group by 1, 2)
select coalesce(old.src, delta.src) as src, coalesce(old.dst, delta.dst) as dst,
 coalesce(c, 0) + coalesce(d, 0) as count
from old full outer join delta on old.src = delta.src and old.dst = delta.dst""")
def graph_upsert_counter(t: Tables):
    old = t["v_acted_in"].filter("earnings is null").select(
        "src", "dst", F.lit(3).cast("long").alias("count")
    )
    views = t["v_ratings"].filter("score = 5").select(
        F.col("user_id").alias("src"), F.col("movie_id").alias("dst")
    )
    table = stores.create_counters(old, ["src", "dst"], t.spark.sparkContext.defaultParallelism)
    stores.add_counts(table, views, batch=0)
    stores.add_counts(table, views, batch=0)  # given again, it counts once
    return stores.counts(table)


@query("lookup_pair", f"""
select p.id as src, m.movie_id as dst from v_person p, v_movies m
where p.name = '{PERSON}' and m.title = '{MOVIE}'""")
def lookup_pair(t: Tables):
    return G.lookup_pair(t["v_person"], t.movies(), ("name", PERSON), ("title", MOVIE))
