"""Readings, spend, ratings, co-appearance, ordering and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions import values as V
from tallyfold.operators import adjacency as H
from tallyfold.operators import asof, ordered
from tallyfold.operators import ratings as M
from tallyfold.operators import readings as S
from tallyfold.operators import rows as R
from tallyfold.operators import splits as P
from tallyfold.plans.fixtures import Tables
from tallyfold.plans.registry import query

_READINGS = """
readings as (select event_id, split_part(value, ',', 1) as station,
 split_part(value, ',', 3) as entry_type, try_cast(split_part(value, ',', 4) as double) as tenths
 from v_station_lines)"""


@query("parse_delimited_lines", f"with {_READINGS} select * from readings")
def parse_delimited_lines(t: Tables):
    return S.station_readings(t["v_station_lines"])


@query("filter_contains", f"""
with {_READINGS} select event_id, station, tenths from readings where contains(entry_type, 'TM')""")
def filter_contains(t: Tables):
    found = R.filter_contains(S.station_readings(t["v_station_lines"]), "entry_type", "TM")
    return found.select("event_id", "station", "tenths")


@query("convert_temperature", f"""
with {_READINGS} select event_id, tenths * cast(0.1 as double) as celsius,
 tenths * cast(0.1 as double) * cast(1.8 as double) + cast(32.0 as double) as fahrenheit
from readings""")
def convert_temperature(t: Tables):
    tenths = F.col("tenths")
    return S.station_readings(t["v_station_lines"]).select(
        "event_id", V.tenths_to_celsius(tenths).alias("celsius"),
        V.tenths_to_fahrenheit(tenths).alias("fahrenheit"),
    )


@query("max_by_station", f"""
with {_READINGS} select station, round(max(tenths) * cast(0.1 as double), 2) as max_c
from readings where contains(entry_type, 'TMAX') group by station""")
def max_by_station(t: Tables):
    return S.max_by_station(t["v_station_lines"])


@query("min_by_station", f"""
with {_READINGS} select station, round(min(tenths) * cast(0.1 as double) * cast(1.8 as double)
 + cast(32.0 as double), 2) as min_f
from readings where contains(entry_type, 'TMIN') group by station""")
def min_by_station(t: Tables):
    return S.min_by_station(t["v_station_lines"])


@query("round2", """
select p_partkey, cast(round(cast(p_retailprice as decimal(18,2)) * 1.075, 2) as double) as gross
from part""")
def round2(t: Tables):
    gross = F.col("p_retailprice").cast(V.MONEY) * F.lit("1.075").cast("decimal(4,3)")
    return t["part"].select("p_partkey", V.round2(gross).cast("double").alias("gross"))


@query("label_when", """
select l_orderkey, l_linenumber, l_partkey, case when l_discount > 0.05 then 1 else 0 end as label
from lineitem""")
def label_when(t: Tables):
    return R.with_label(t["lineitem"], F.col("l_discount") > 0.05).select(
        "l_orderkey", "l_linenumber", "l_partkey", "label"
    )


@query("cast_columns", """
select event_id, try_cast(substring(props, 7, length(props) - 7) as int) as k,
 cast(trunc(value) as int) as whole, cast(event_type like '%click%' as int) as clicked
from events""")
def cast_columns(t: Tables):
    texts = t["events"].select(
        "event_id", F.expr("substring(props, 7, length(props) - 7)").alias("k"),
        F.col("value").alias("whole"), F.col("event_type").like("%click%").alias("clicked"),
    )
    return R.cast_columns(texts, {"k": "int", "whole": "int", "clicked": "int"})


@query("select_rename", "select o_custkey as customer_id, o_totalprice as price from orders")
def select_rename(t: Tables):
    return R.select_rename(t["orders"], {"customer_id": "o_custkey", "price": "o_totalprice"})


_SPEND = """
select o_custkey as customer_id, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total_spent
from orders group by o_custkey"""


@query("spend_by_customer", f"{_SPEND} order by total_spent desc, customer_id")
def spend_by_customer(t: Tables):
    return S.spend_by_customer(t["orders"], "o_custkey", "o_totalprice")


@query("top_1", f"{_SPEND} order by total_spent desc, customer_id limit 1")
def top_1(t: Tables):
    spend = S.spend_by_customer(t["orders"], "o_custkey", "o_totalprice")
    return R.top_k(spend, 1, F.desc("total_spent"), F.asc("customer_id"))


@query("avg_by_group_sql", """
with s as (select c_nationkey, cast(sum(cast(c_acctbal as decimal(18,2))) * 100 as bigint) as cents,
 count(*) as n from customer group by c_nationkey)
select c_nationkey as group_key, sign(cents) * ((2 * abs(cents) + n) // (2 * n)) / 100.0::double as avg_value
from s order by 1""")
def avg_by_group_sql(t: Tables):
    return S.avg_by_group_sql(t["customer"], "c_nationkey", "c_acctbal")


@query("cond_count_window", """
select event_type, count(*) as n, cast(sum(cast(props like '%7%' as int)) as bigint) as n_matched
from events group by event_type""")
def cond_count_window(t: Tables):
    return S.conditional_counts(t["events"], F.col("props").like("%7%"), F.col("event_type"))


@query("ratings_histogram", "select score, count(*) as n from v_ratings group by score order by score")
def ratings_histogram(t: Tables):
    return M.ratings_histogram(t["v_ratings"])


@query("five_star_count", """
select movie_id, count(score) as five_star_count from v_ratings where score = 5 group by movie_id""")
def five_star_count(t: Tables):
    return M.five_star_count(t["v_ratings"])


_AVG = "cast(sum(score) as double) / count(score)"


@query("avg_score", f"select movie_id, {_AVG} as average_score from v_ratings group by movie_id")
def avg_score(t: Tables):
    return M.avg_score(t["v_ratings"])


@query("avg_score_int", f"""
select movie_id, cast(trunc({_AVG}) as int) as average_score from v_ratings group by movie_id""")
def avg_score_int(t: Tables):
    return M.avg_score(t["v_ratings"], int_avg=True)


@query("hyped_movies", f"""
with f as (select movie_id, count(*) as five_star_count from v_ratings where score = 5 group by movie_id),
a as (select movie_id, {_AVG} as average_score from v_ratings group by movie_id)
select f.movie_id, title, five_star_count, average_score
from f join a on f.movie_id = a.movie_id join v_movies m on f.movie_id = m.movie_id
order by five_star_count desc, f.movie_id limit 10""")
def hyped_movies(t: Tables):
    return M.hyped_movies(t["v_ratings"], t["v_movies"])


_TOKENS = """
tokens as (select line_no, string_split(trim(value), ' ') as p from v_hero_lines),
connections as (select p[1] as id, cast(sum(len(p) - 1) as bigint) as connections from tokens group by 1),
named as (select p_name as name, c.id, connections from connections c
 join part on cast(c.id as bigint) = p_partkey)"""


def _connections(t: Tables):
    return H.connections_by_id(t["v_hero_lines"])


def _names(t: Tables):
    return R.select_rename(t["part"], {"id": "p_partkey", "name": "p_name"})


@query("token_array_ops", f"""
with {_TOKENS} select line_no, p[1] as id, cast(len(p) - 1 as bigint) as connections from tokens""")
def token_array_ops(t: Tables):
    return H.token_array_ops(t["v_hero_lines"])


@query("connections_by_id", f"with {_TOKENS} select id, connections from connections")
def connections_by_id(t: Tables):
    return _connections(t)


@query("join_names", f"with {_TOKENS} select name, connections from named")
def join_names(t: Tables):
    return H.join_names(_connections(t), _names(t))


@query("argmax_lookup", f"""
with {_TOKENS} select name, connections from named order by connections desc, id limit 1""")
def argmax_lookup(t: Tables):
    return H.argmax_lookup(_connections(t), _names(t))


@query("min_scalar_semijoin", f"""
with {_TOKENS} select name, connections from named
where connections = (select min(connections) from connections where connections > 0)""")
def min_scalar_semijoin(t: Tables):
    return H.min_scalar_semijoin(_connections(t), _names(t))


@query("min_fixed_semijoin", f"with {_TOKENS} select name, connections from named where connections = 40")
def min_fixed_semijoin(t: Tables):
    return H.min_scalar_semijoin(_connections(t), _names(t), exactly=40)


@query("previous_time_lookup", """
with d as (select distinct date_trunc('hour', ts)::timestamp as time from v_arrivals),
l as (select time, lag(time) over (order by time) as previous_time from d)
select event_id, time, previous_time from v_arrivals join l on time = date_trunc('hour', ts)::timestamp""")
def previous_time_lookup(t: Tables):
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    rows = t["v_arrivals"].select("event_id", hour.alias("time"))
    return asof.previous_time_lookup(rows, "time", "event_id")


_OUT_OF_ORDER = """
select event_id, user_id, ts, previous_time from (select *, max(ts) over ({} order by arrival_seq
 rows between unbounded preceding and 1 preceding) as previous_time from v_arrivals)
where ts < previous_time"""


@query("out_of_order", _OUT_OF_ORDER.format(""))
def out_of_order(t: Tables):
    found = ordered.out_of_order(t["v_arrivals"], "ts", "arrival_seq")
    return found.select("event_id", "user_id", "ts", "previous_time")


@query("out_of_order_by_key", _OUT_OF_ORDER.format("partition by event_type"))
def out_of_order_by_key(t: Tables):
    found = ordered.out_of_order(t["v_arrivals"], "ts", "arrival_seq", ["event_type"])
    return found.select("event_id", "user_id", "ts", "previous_time")


@query("kfold_positional_split", """
select o_orderkey, o_custkey, cast((row_number() over (order by o_orderkey) - 1)
 // cast(ceil(count(*) over () / 5.0) as bigint) + 1 as int) as fold from orders""")
def kfold_positional_split(t: Tables):
    rows = t["orders"].select("o_orderkey", "o_custkey")
    return P.kfold_positional_split(rows, "o_orderkey")


@query("union_folds", "select o_orderkey, o_custkey from orders")
def union_folds(t: Tables):
    rows = t["orders"].select("o_orderkey", "o_custkey")
    split = P.kfold_positional_split(rows, "o_orderkey")
    return P.united_folds(split)


@query("leave_n_out_split", """
with n as (select o_custkey, o_orderkey,
 row_number() over (partition by o_custkey order by o_orderkey) between 2 and 4 as inside from orders),
c as (select *, row_number() over (partition by inside order by o_orderkey) as seen from n)
select o_custkey, o_orderkey, inside and seen <= 3000 as is_test from c""")
def leave_n_out_split(t: Tables):
    rows = t["orders"].select("o_custkey", "o_orderkey")
    return P.leave_n_out_split(rows, "o_custkey", "o_orderkey", 2, 4, max_test=3000)


@query("random_split", """
select o_orderkey, cast(('0x' || substring(md5('42-' || cast(o_orderkey as varchar)), 1, 8)) as bigint)
 / 4294967296.0::double < 0.9::double as is_train from orders""")
def random_split(t: Tables):
    share = P.split_share("o_orderkey", 42)
    return t["orders"].select("o_orderkey", (share < 0.9).alias("is_train"))


@query("union_years", """
select cast(year(o_orderdate) as int) as year, count(*) as n,
 cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total from orders group by 1""")
def union_years(t: Tables):
    orders = t["orders"].withColumn("year", F.year("o_orderdate"))
    return orders.groupBy("year").agg(
        F.count("*").alias("n"),
        F.sum(F.col("o_totalprice").cast(V.MONEY)).cast("double").alias("total"),
    )
