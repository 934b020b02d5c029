import json

import pytest
from conftest import values
from pyspark.sql import functions as F

from tallyfold.plans import REGISTRY
from tallyfold.plans.files import ARRAY_ROWS
from tallyfold.session import materialize, scratch_path
from tallyfold.sinks import files as K
from tallyfold.sources import files as S
from tallyfold.sources import schemas


@pytest.fixture
def text(tmp_path):
    def write(name, content, encoding="utf-8"):
        (tmp_path / name).write_text(content, encoding=encoding)
        return str(tmp_path / name)

    return write


def test_csv_with_header(spark, text):
    path = text("people.csv", "userID,name,age,friends\n0,Will,33,385\n\n1,Jean,26,2\n")
    inferred = S.read_csv(spark, path, header=True)
    assert dict(inferred.dtypes)["age"] == "int"
    assert values(S.read_csv(spark, path, schemas.PERSON, header=True)) == [
        (0, "Will", 33, 385), (1, "Jean", 26, 2)]


def test_csv_by_position_and_separator(spark, text):
    orders = S.read_csv(spark, text("orders.csv", "44,8602,37.19\n35,5368\n"), schemas.ORDER_LINE)
    assert [r["customer_id"] for r in orders.collect()] == [44, 35]
    movies = S.read_csv(spark, text("movies", "1|Toy|extra\n2|Čas\n", "utf-8-sig"), schemas.MOVIE, sep="|")
    assert values(movies) == [(1, "Toy"), (2, "Čas")]
    heroes = S.read_csv(spark, text("names", '1 "A B"\n2 "C"\n'), schemas.HERO_NAME, sep=" ")
    assert values(heroes) == [(1, "A B"), (2, "C")]
    ratings = S.read_csv(spark, text("u.data", "1\t2\t3\t4\n"), schemas.RATING, sep="\t")
    assert values(ratings) == [(1, 2, 3, 4)]


def test_years_in_one_scan(spark, text):
    paths = [text(f"{y}.csv", f"Year,Delay\n{y},1\n{y},\n") for y in (1987, 1988, 1989)]
    assert S.read_years(spark, paths, "Year int, Delay int").groupBy("Year").count().count() == 3


def test_year_folders_in_one_scan(spark, rows, tmp_path):
    root = str(tmp_path / "years")
    rows("id long, late int, year int", (1, 5, 1987), (2, None, 1988)).write.partitionBy("year").parquet(root)
    rows("id long, extra string, year int", (3, "x", 1989)).write.mode("append").partitionBy("year").parquet(root)
    got = S.read_year_folders(spark, root, "id long, late int")
    assert values(got) == [(1, 5, 1987), (2, None, 1988), (3, None, 1989)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "extra" not in plan
    assert values(S.read_year_folders(spark, root, "id long", [1988, 2001]), "id") == [(2,)]
    assert S.read_year_folders(spark, str(tmp_path / "none"), "id long").columns == ["id", "year"]


def test_csv_headers_that_drift(spark, text):
    paths = [text("a.csv", "id,late,note\n1,5,x\n2,,y\n"), text("b.csv", "note,id\nz,3\n"),
             text("c.csv", "id,late,note\n4,oops,\n"), text("d.csv", "")]
    got = S.read_drifting_csv(spark, paths, "id long, late int")
    assert got.columns == ["id", "late"]
    assert values(got) == [(1, 5), (2, None), (3, None), (4, None)]
    # equal headers share a scan
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    assert S.read_drifting_csv(spark, [], "id long").count() == 0


def test_first_rows_in_file_order(spark, tmp_path):
    """Files of 10 rows in two folders; the order of ids is not that of the rows."""
    root = str(tmp_path / "t")
    for part in "ab":
        ids = spark.range(0, 50, numPartitions=5).select((100 - F.col("id")).alias("id"))
        ids.write.parquet(f"{root}/part={part}")
    for n, expected in ((0, []), (1, [("a", 100)]), (10, [("a", 100 - i) for i in range(10)]),
                        (23, [("a", 100 - i) for i in range(23)]),
                        (55, [("a", 100 - i) for i in range(50)] + [("b", 100 - i) for i in range(5)])):
        assert values(S.first_n_in_files(spark, root, n), "part", "id") == sorted(expected, key=repr)
    assert S.first_n_in_files(spark, root, 1_000).count() == 100
    read = S.first_n_in_files(spark, root, 23).inputFiles()
    assert len(read) == 3  # two whole files and the crossing one
    spark.createDataFrame([], "id long").write.parquet(str(tmp_path / "empty"))
    assert S.first_n_in_files(spark, str(tmp_path / "empty"), 5).count() == 0


def test_json(spark, text):
    lines = text("a.jsonl", '{"url": "u", "comment_count": "(3 příspěvků)"}\n{"url": "v", "comment_count": 4}\n')
    got = S.read_jsonl(spark, lines, schemas.ARTICLE)
    assert values(got, "url", "comment_count") == [("u", "(3 příspěvků)"), ("v", "4")]
    array = text("a.json", json.dumps([{"url": "u"}, {"url": "v"}], indent=4))
    assert values(S.read_json_array(spark, array, schemas.ARTICLE), "url") == [("u",), ("v",)]


def test_json_arrays_are_of_bounded_size(spark, tmp_path):
    """All orders of one customer, some without a key or equal."""
    orders = spark.range(10_000, numPartitions=1).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("o_orderkey"), F.lit(7).cast("long").alias("o_custkey"),
        F.lit("1-URGENT").alias("o_orderpriority"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    found = REGISTRY["read_json_array"](spark, str(tmp_path))
    files = [r["count"] for r in found.groupBy(F.input_file_name()).count().collect()]
    assert sum(files) == 10_000 and len(files) >= 3 and max(files) <= ARRAY_ROWS
    assert found.exceptAll(orders).isEmpty()


def test_lines_and_collection(spark, text):
    assert values(S.read_lines(spark, text("x.txt", "a\n\nb"))) == [("",), ("a",), ("b",)]
    assert values(S.from_collection(spark, iter([("a",)]), "value string")) == [("a",)]


def test_json_records(rows):
    df = rows("id int, value string", (1, '{"k": 1, "t": "a", "z": 0}'), (2, '{"k": "x", "t": "b"}'),
              (3, "junk"), (4, "{}"), (5, '{"k": 1'), (6, "[1]"), (7, None), (8, ""), (9, '{"k": "x"}'))
    assert values(S.parse_json_records(df, "k int, t string")) == [
        (1, 1, "a"), (2, None, "b"), (4, None, None), (9, None, None)]


def test_csv_and_text_sinks(spark, rows, tmp_path):
    df = rows("title string, n int", ("a;b", 1), ("c", 2))
    K.write_csv(df, str(tmp_path / "csv"), sep=";")
    assert values(S.read_csv(spark, str(tmp_path / "csv"), "title string, n int", sep=";")) == [("a;b", 1), ("c", 2)]
    K.write_text_rolled(spark.range(10).selectExpr("string(id) as value").coalesce(1), str(tmp_path / "t"), "value", 4)
    assert len(list((tmp_path / "t").glob("part-*.txt"))) == 3
    K.register_view("sink_view", df)
    assert spark.sql("select sum(n) from sink_view").first()[0] == 3


def test_convert_jsonl(spark, text, tmp_path):
    source = text("a.jsonl", '{"url": "u"}\n')
    K.convert_jsonl(spark, source, str(tmp_path / "p"), schemas.ARTICLE, "parquet")
    assert spark.read.parquet(str(tmp_path / "p")).first()["url"] == "u"


def test_capped_append(spark, rows, tmp_path):
    path = str(tmp_path / "store")
    schema = "url string, t string"
    rows(schema, ("a", "x")).write.json(path)
    line = len('{"url":"a","t":"x"}\n')
    assert K.stored_bytes(spark, path) == line
    batch = rows("o long, url string, t string", (1, "a", "y"), (2, "b", "x"), (3, "b", "z"), (4, "c", "x"), (5, "d", "x"))
    K.append_jsonl_capped(batch, path, schema, "url", "o", 3 * line)
    assert values(spark.read.schema(schema).json(path)) == [("a", "x"), ("b", "x"), ("c", "x")]
    K.append_jsonl_capped(batch, path, schema, "url", "o", 3 * line)
    assert spark.read.schema(schema).json(path).count() == 3


def test_scratch(spark, rows):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(root) and scratch_path(spark, "x") != scratch_path(spark, "x")
    assert values(materialize(rows("a int", (1,)), "m")) == [(1,)]
