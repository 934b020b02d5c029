"""Files written from the tables and read back, each with the SQL of what must be in them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.plans.fixtures import Tables
from tallyfold.plans.registry import query
from tallyfold.session import scratch_path
from tallyfold.sinks import files as sinks
from tallyfold.sources import files as sources

_ORDERS = "o_orderkey long, o_custkey long, o_orderpriority string"
_SQL = "select o_orderkey, o_custkey, o_orderpriority from orders"
#: Rows of one JSON array, a power of two: the number of files grows with the table, their size does not.
ARRAY_BITS = 12
ARRAY_ROWS = 1 << ARRAY_BITS
#: The year whose files were written without the priority.
LEAN_YEAR = 1995
_YEARS_SQL = f"""
select o_orderkey, o_custkey, case when year(o_orderdate) <> {LEAN_YEAR} then o_orderpriority end
 as o_orderpriority, cast(year(o_orderdate) as int) as year from orders where o_orderdate is not null"""
#: Ranges of order keys, each written as a file of its own.
KEY_RANGES = 64


def _orders(t: Tables):
    return t["orders"].select("o_orderkey", "o_custkey", "o_orderpriority")


@query("read_lines", "select o_orderpriority as value from orders")
def read_lines(t: Tables):
    folder = scratch_path(t.spark, "lines")
    _orders(t).select("o_orderpriority").write.text(folder)
    return sources.read_lines(t.spark, folder)


@query("read_csv_header", _SQL)
def read_csv_header(t: Tables):
    folder = scratch_path(t.spark, "csv")
    sinks.write_csv(_orders(t), folder, header=True)
    return sources.read_csv(t.spark, folder, _ORDERS, header=True)


@query("read_csv_names", _SQL)
def read_csv_names(t: Tables):
    """Without a header, the schema names the columns."""
    folder = scratch_path(t.spark, "csv")
    sinks.write_csv(_orders(t), folder)
    return sources.read_csv(t.spark, folder, _ORDERS)


@query("write_csv", _SQL)
def write_csv(t: Tables):
    """With a separator of its own, types inferred."""
    folder = scratch_path(t.spark, "csv")
    sinks.write_csv(_orders(t), folder, sep="|", header=True)
    read = sources.read_csv(t.spark, folder, header=True, sep="|")
    return read.select(F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long"), "o_orderpriority")


@query("read_jsonl", _SQL)
def read_jsonl(t: Tables):
    folder = scratch_path(t.spark, "jsonl")
    _orders(t).write.json(folder)
    return sources.read_jsonl(t.spark, folder, _ORDERS)


@query("read_json_array", _SQL)
def read_json_array(t: Tables):
    """Each file holds one array of at most ``ARRAY_ROWS`` orders, whatever their keys."""
    folder = scratch_path(t.spark, "arrays")
    # Ids count up within a partition of the scan, and begin anew at a multiple of 2**33.
    part = F.shiftright(F.monotonically_increasing_id(), ARRAY_BITS)
    arrays = _orders(t).withColumn("part", part).groupBy("part").agg(F.to_json(F.collect_list(
        F.struct("o_orderkey", "o_custkey", "o_orderpriority"))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(folder)
    return sources.read_json_array(t.spark, folder, _ORDERS)


@query("write_text_rolled", "select o_orderpriority as value from orders")
def write_text_rolled(t: Tables):
    folder = scratch_path(t.spark, "rolled")
    sinks.write_text_rolled(_orders(t), folder, "o_orderpriority", 1000)
    return sources.read_lines(t.spark, folder)


@query("convert_jsonl", _SQL)
def convert_jsonl(t: Tables):
    folder = scratch_path(t.spark, "converted")
    _orders(t).write.json(f"{folder}/in")
    sinks.convert_jsonl(t.spark, f"{folder}/in", f"{folder}/out", _ORDERS, "parquet")
    return t.spark.read.parquet(f"{folder}/out")


@query("append_jsonl_capped", """
with s as (select o_orderkey, o_custkey, o_orderpriority,
 sum(strlen('{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderpriority":"'
  || o_orderpriority || '"}') + 1) over (order by o_orderkey) as upto from orders)
select o_orderkey, o_custkey, o_orderpriority from s where upto <= 100000""")
def append_jsonl_capped(t: Tables):
    """Into a store that does not exist, then again: what is there stays as it is."""
    folder = scratch_path(t.spark, "store")
    batch = _orders(t).withColumn("at", F.col("o_orderkey"))
    for _ in range(2):
        sinks.append_jsonl_capped(batch, folder, _ORDERS, "o_orderkey", "at", 100_000)
    return sources.read_jsonl(t.spark, folder, _ORDERS)


def _yearly_files(t: Tables, fmt: str, **options) -> str:
    """Orders in a folder per year; the files of ``LEAN_YEAR`` lack a column in the middle."""
    folder = scratch_path(t.spark, "years")
    orders = t["orders"].filter("o_orderdate is not null").select(
        "o_orderkey", "o_orderpriority", "o_custkey", F.year("o_orderdate").alias("year"))
    lean = F.col("year") == LEAN_YEAR
    for part in (orders.filter(~lean), orders.filter(lean).drop("o_orderpriority")):
        part.write.partitionBy("year").mode("append").format(fmt).options(**options).save(folder)
    return folder


@query("union_year_folders", _YEARS_SQL)
def union_year_folders(t: Tables):
    """Yearly Parquet files of differing columns, read back in one scan."""
    return sources.read_year_folders(t.spark, _yearly_files(t, "parquet"), _ORDERS)


@query("union_year_csv", _YEARS_SQL)
def union_year_csv(t: Tables):
    """Yearly CSV files of differing headers, one scan for each header."""
    folder = _yearly_files(t, "csv", header=True)
    years = [f"{folder}/year={y}" for y in sources.folder_values(t.spark, folder, "year")]
    schema = f"{_ORDERS}, year int"
    return sources.read_drifting_csv(t.spark, years, schema, base=folder)


@query("first_n_in_files", "select o_orderkey, o_custkey, o_orderpriority from orders order by o_orderkey limit 5000")
def first_n_in_files(t: Tables):
    """Orders in files by ranges of their keys; no column orders the rows read back."""
    folder = scratch_path(t.spark, "ordered")
    _orders(t).repartitionByRange(KEY_RANGES, "o_orderkey").sortWithinPartitions("o_orderkey").write.parquet(folder)
    return sources.first_n_in_files(t.spark, folder, 5_000, _ORDERS)
