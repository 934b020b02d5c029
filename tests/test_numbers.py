from conftest import values
from pyspark.sql import functions as F

from tallyfold.operators import adjacency as H
from tallyfold.operators import ratings as M
from tallyfold.operators import readings as S
from tallyfold.operators import rows as R


def test_delimited_lines_with_gaps(rows):
    lines = rows("value string", ("A,1800,TMAX,-75,,,E",), ("A,1800",), ("",), ("B,1,TMIN,x",))
    got = R.parse_delimited_lines(lines, S.READING)
    assert values(got) == sorted(
        [("A", "TMAX", -75.0), ("A", None, None), ("", None, None), ("B", "TMIN", None)], key=repr)


def test_separator_is_literal(rows):
    got = R.parse_delimited_lines(rows("value string", ("a|1",)), {"n": (1, "int")}, sep="|")
    assert values(got) == [(1,)]


def test_stations(rows):
    lines = rows("value string", ("A,1,TMAX,-75",), ("A,1,TMAX,3",), ("A,1,XTMAXX,7",), ("B,1,TMIN,-100",))
    assert values(S.max_by_station(lines)) == [("A", 0.7)]
    assert values(S.min_by_station(lines)) == [("B", 14.0)]


def test_spend_and_average(rows):
    df = rows("c int, p double", (1, 0.1), (1, 0.2), (2, 0.3), (3, 5.0))
    assert [tuple(r) for r in S.spend_by_customer(df, "c", "p").collect()] == [(3, 5.0), (1, 0.3), (2, 0.3)]
    people = rows("age int, friends int", (30, 1), (30, 2), (30, 2), (20, -5))
    assert [tuple(r) for r in S.avg_by_group_sql(people, "age", "friends").collect()] == [(20, -5.0), (30, 1.67)]


def test_conditional_counts(rows):
    df = rows("k int, t string", (1, "válka"), (1, None), (2, None), (1, "mír"))
    got = S.conditional_counts(df, F.col("t").like("%válka%"), F.col("k"))
    assert values(got) == [(1, 3, 1), (2, 1, None)]


def test_ratings(rows):
    ratings = rows("movie_id int, score int", (1, 5), (1, 4), (1, 5), (2, 5), (3, 1), (4, 5), (2, None))
    assert values(M.avg_score(ratings)) == [(1, 14 / 3), (2, 5.0), (3, 1.0), (4, 5.0)]
    assert values(M.avg_score(ratings, int_avg=True)) == [(1, 4), (2, 5), (3, 1), (4, 5)]
    assert values(M.five_star_count(ratings)) == [(1, 2), (2, 1), (4, 1)]
    movies = rows("movie_id int, title string", (1, "A"), (2, "B"), (3, "C"))
    got = [tuple(r) for r in M.hyped_movies(ratings, movies, 5).collect()]
    assert got == [(1, "A", 2, 14 / 3), (2, "B", 1, 5.0)]


def test_adjacency(rows):
    lines = rows("value string", (" 1 2 3 ",), ("1 4",), ("2",), ("3 1",), ("9 1",), ("4 5  6",))
    names = rows("id int, name string", (1, "one"), (2, "two"), (3, "three"), (4, "four"))
    connections = H.connections_by_id(lines)
    assert values(connections) == [("1", 3), ("2", 0), ("3", 1), ("4", 3), ("9", 1)]
    assert values(H.argmax_lookup(connections, names)) == [("one", 3)]
    assert values(H.min_scalar_semijoin(connections, names)) == [("three", 1)]
    assert values(H.min_scalar_semijoin(connections, names, exactly=3)) == [("four", 3), ("one", 3)]


def test_string_and_time_ranges(rows):
    df = rows("d string", ("2022-05-01",), ("1. 1. 2022 10:00",), ("2023-01-01",), (None,))
    assert values(R.filter_string_range(df, "d", "2022-01-01", "2023-01-01")) == [("2022-05-01",)]
    typed = df.select(F.col("d").try_cast("timestamp_ntz").alias("d"))
    assert R.filter_time_range(typed, "d", "2022-01-01", "2023-01-01").count() == 1


def test_random_rows_do_not_depend_on_partitions(spark):
    df = spark.range(1000)
    one = values(R.random_rows(df, "id", 5))
    assert one == values(R.random_rows(df.repartition(7), "id", 5)) and len(set(one)) == 5
    assert one != values(R.random_rows(df, "id", 5, seed=1))
