import pytest
from __spark_entry__ import queries
from conftest import SMALL, values
from pyspark.errors import PySparkException

from tallyfold.operators import graph as G
from tallyfold.operators import stores
from tallyfold.operators import tables as B
from tallyfold.plans.fixtures import Tables


@pytest.fixture
def people(rows):
    return rows("id long, labels array<string>, name string, born int",
                (1, ["Person"], "Tom", 1956), (2, ["Person"], "Ann", 1960), (3, ["Person"], "Bob", 1970),
                (4, ["Person"], "Eve", 1959), (5, ["Person"], "Tom", 1980))


@pytest.fixture
def movies(rows):
    return rows("id long, labels array<string>, title string",
                (1, ["Movie"], "M1"), (2, ["Movie"], "M2"), (3, ["Movie"], "M1"))


@pytest.fixture
def roles(rows):
    return rows("src long, dst long, earnings long",
                (2, 1, 20), (2, 2, 5), (3, 1, 20), (3, 3, None), (4, 2, 90), (5, 1, 7))


def test_reads(people, movies, roles):
    assert values(G.graph_any_nodes(people, movies, k=2)) == [(1, "Movie"), (2, "Movie")]
    assert values(G.graph_label_scan(movies, "Movie", "title", 2)) == [(1, "M1"), (2, "M2")]
    found = G.graph_in_neighbors(people, roles, movies, "title", "M1", "name")
    assert [r[0] for r in found.collect()] == ["Ann", "Bob", "Bob", "Tom"]
    assert values(G.graph_out_neighbors(people, roles, movies, "name", "Ann", "title")) == [("M1",), ("M2",)]
    assert G.graph_degree(people, roles, "name", "Tom").first()[0] == 1
    assert G.graph_degree(people, roles, "name", "nobody").first()[0] == 0
    assert G.graph_avg_edge_property(roles, "earnings").first()[0] == (20 + 5 + 20 + 90 + 7) / 5


def test_common_neighbors(people, movies, roles):
    def shared(a, b):
        return values(G.graph_common_neighbors(people, roles, movies, "name", a, b, "title"))

    assert shared("Ann", "Bob") == [("M1",)]
    assert shared("Ann", "Ann") == []  # an edge does not pair with itself
    assert shared("Tom", "Ann") == [("M1",)]


def test_undirected_hop(people, roles, rows):
    contacts = rows("src long, dst long", (1, 2), (2, 1), (3, 1), (1, 4), (1, 1))
    got = G.graph_undirected_hop(people, contacts, roles, "Tom", 1960, 10)
    # Ann is reached by two contact edges; Eve is too old; Tom himself has no role.
    assert [tuple(r) for r in got.collect()] == [("Ann", 1960, 20), ("Ann", 1960, 20), ("Bob", 1970, 20)]
    assert G.both_directions(contacts).count() == 9


def test_merge_is_idempotent(people, movies, roles, rows):
    batch = rows("name string, source_id long, title string, target_id long",
                 ("Ann", 77, "M2", 88), ("New", 9, "M9", 90), ("New", 8, "M9", 91), ("New", 9, "M2", 90))
    state = G.merge_by_key(people, roles, movies, batch, ("name", "Person"), ("title", "Movie"))
    assert [df.count() for df in state] == [6, 8, 4]
    assert (8, "New") in values(state[0], "id", "name")
    assert {(8, 90, None), (8, 2, None), (2, 2, 5)} <= set(values(state[1]))
    again = G.merge_by_key(*state, batch, ("name", "Person"), ("title", "Movie"))
    assert [values(df) for df in again] == [values(df) for df in state]


def test_set_property(people, rows):
    updates = rows("id long, born int, mood string", (1, 2000, "ok"))
    got = G.graph_set_property(people, updates.select("id", "born"), "id", "born")
    assert dict(values(got, "id", "born")) == {1: 2000, 2: 1960, 3: 1970, 4: 1959, 5: 1980}
    got = G.graph_set_property(people, updates.select("id", "mood"), "id", "mood")
    assert dict(values(got, "id", "mood")) == {1: "ok", 2: None, 3: None, 4: None, 5: None}


def test_having_label(people, roles):
    got = G.graph_having_label(people, roles, "earnings", 24, "Rich")
    assert values(got.filter("total is not null"), "id", "labels", "total") == [
        (2, ["Person", "Rich"], 25), (4, ["Person", "Rich"], 90)]
    assert got.count() == 5
    twice = G.graph_having_label(got.drop("total"), roles, "earnings", 24, "Rich")
    assert values(twice) == values(got)


def test_upsert_counter(rows):
    edges = rows("src long, dst long, count long", (1, 1, 4), (1, 2, 1))
    events = rows("src long, dst long", (1, 1), (1, 1), (3, 1))
    assert values(G.graph_upsert_counter(edges, events)) == [(1, 1, 6), (1, 2, 1), (3, 1, 1)]


def test_lookup_pair(people, movies):
    assert values(G.lookup_pair(people, movies, ("name", "Ann"), ("title", "M2"))) == [(2, 2)]
    assert values(G.lookup_pair(people, movies, ("name", "?"), ("title", "M2"))) == []
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        G.lookup_pair(people, movies, ("name", "Tom"), ("title", "M2")).collect()


def test_delete(rows, spark, tmp_path):
    df = rows("id int, at timestamp_ntz").unionByName(
        spark.sql("select 1 as id, timestamp_ntz'2019-12-31' as at union all "
                  "select 2, timestamp_ntz'2020-01-01' union all select 3, null"))
    kept, removed = B.delete_older_than(df, "at", "2020-01-01")
    assert values(kept, "id") == [(2,), (3,)] and removed.first()[0] == 1
    path = B.write_version(kept, str(tmp_path), 1)
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(PySparkException):
        B.write_version(kept, str(tmp_path), 1)


def test_incremental_append(rows):
    seen = rows("url string, o long", ("a", 0))
    one = rows("url string, o long", ("b", 1), ("a", 2), ("b", 3))
    two = rows("url string, o long", ("c", 2), ("b", 1))
    assert values(B.incremental_append(seen, one, "url", "o")) == [("b", 1)]
    every = B.incremental_append_all(seen.drop("o"), [one, two], "url", "o")
    assert values(every) == [("a",), ("b",), ("c",)]
    new = B.frontier_new_urls(rows("url string", ("a",), ("z",), ("z",), (None,)), seen)
    assert values(new) == [("z",)]


def test_roles_of_dealt_lines(spark):
    t = Tables(spark, SMALL)
    assert values(t.acted_in(5)) == values(t["v_acted_in"].select("src", "dst", "earnings"))


def test_buckets_of_the_merged_edges_grow_with_the_lines(spark, monkeypatch):
    made = []
    real = stores.create
    monkeypatch.setattr(stores, "create", lambda *a: made.append(real(*a)) or made[-1])
    monkeypatch.setattr(stores, "BUCKET_ROWS", 500)
    found = queries()["graph_merge_edge"](spark, SMALL)
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    edges = next(s for s in made if s.keys == ("src", "dst"))
    assert edges.buckets >= lines // 500 and found.count() == edges.rows().count()
