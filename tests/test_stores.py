import pytest
from conftest import values
from test_plans import plan

from tallyfold.operators import stores


@pytest.fixture
def edges(rows):
    return stores.create(rows("src long, dst long, earnings double", *[(i % 9, i, float(i)) for i in range(60)]),
                         ["src", "dst"], 4)


def files(store):
    return set(store.rows().inputFiles())


@pytest.fixture(params=["-1", "10485760"])
def threshold(request, spark):
    """Joins with and without broadcasts by size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_merge_edges_appends_what_is_new(threshold, edges, rows):
    before = files(edges)
    batch = rows("src long, dst long", (0, 0), (0, 1), (0, 1), (99, 0), (1, 1), (None, 5))
    stores.merge_edges(edges, batch)
    assert files(edges) > before  # no file is rewritten
    added = values(edges.rows().filter("earnings is null"), "src", "dst")
    assert added == sorted([(0, 1), (99, 0), (None, 5)], key=repr)
    stores.merge_edges(edges, batch.filter("src is not null"))
    assert edges.rows().count() == 63


def test_only_the_batch_is_shuffled(spark, edges, rows):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(edges.known(rows("src long, dst long", (0, 0))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = text.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "Bucketed: true" in line)
    side = [line for line in lines[:scan] if "Exchange" in line]
    assert not side, text
    assert text.count("Exchange hashpartitioning") + text.count("Exchange REPARTITION") <= 2


def test_merge_by_key_creates_in_place_and_again_nothing(threshold, rows):
    people = stores.create(rows("id long, labels array<string>, name string", (1, ["Person"], "a"), (2, ["Person"], "b")), ["name"], 3)
    films = stores.create(rows("id long, labels array<string>, title string", (7, ["Movie"], "x")), ["title"], 3)
    roles = stores.create(rows("src long, dst long, pay int", (1, 7, 5)), ["src", "dst"], 3)
    batch = rows("name string, title string, source_id long, target_id long",
                 ("a", "x", 50, 60), ("a", "y", 50, 61), ("c", "x", 52, 60), ("c", "x", 53, 60), ("c", "y", 52, 62))
    for _ in range(2):
        stores.merge_by_key(people, roles, films, batch, "Person", "Movie")
        assert values(people.rows(), "id", "name") == [(1, "a"), (2, "b"), (52, "c")]
        assert values(films.rows(), "id", "title") == [(61, "y"), (7, "x")]
        assert values(roles.rows(), "src", "dst", "pay") == [
            (1, 61, None), (1, 7, 5), (52, 61, None), (52, 7, None)]
    assert people.rows().filter("name = 'c'").first()["labels"] == ["Person"]


def test_counters_add_up_and_a_batch_counts_once(rows):
    table = stores.create_counters(rows("src long, dst long, count int", (1, 1, 5), (2, 1, 1)), ["src", "dst"], 4)
    events = rows("src long, dst long", (1, 1), (1, 1), (3, 1), (None, 1))
    stores.add_counts(table, events, batch=4)
    stores.add_counts(table, events, batch=4)
    stores.add_counts(table, events)
    assert values(stores.counts(table), "src", "dst", "count") == sorted(
        [(1, 1, 9), (2, 1, 1), (3, 1, 2), (None, 1, 2)], key=repr)
    assert "Exchange" not in plan(stores.counts(table))
    one = table.compacted(stores.counts(table))
    assert values(one.rows(), "src", "dst", "count") == values(stores.counts(table), "src", "dst", "count")
    assert len(files(one)) <= 4 < len(files(table))


def test_a_stream_of_batches_counts_once(spark, rows, tmp_path):
    """Numbers of micro-batches make a counter exact over a restart that repeats one."""
    table = stores.create_counters(rows("word string, count long"), ["word"], 2)
    for number, words in enumerate(["a b a", "b b", "c"]):
        for _ in range(2):
            stores.add_counts(table, rows("word string", *[(w,) for w in words.split()]), batch=number)
    assert values(stores.counts(table)) == [("a", 2), ("b", 3), ("c", 1)]


def test_property_log(spark, rows):
    nodes = stores.create(rows("id long, name string", (1, "a"), (2, "b"), (3, "c"), (None, "d")), ["id"], 3)
    log = stores.create_property_log(nodes, "int")
    assert values(stores.with_property(nodes, log, "age")) == sorted(
        [(1, "a", None), (2, "b", None), (3, "c", None), (None, "d", None)], key=repr)
    stores.set_property(log, rows("id long, value int", (1, 10), (2, 20), (9, 90)), batch=1)
    stores.set_property(log, rows("id long, value int", (1, 11), (2, None)), batch=2)
    stores.set_property(log, rows("id long, value int", (1, 99)), batch=1)  # seen before
    got = stores.with_property(nodes, log, "age")
    assert values(got) == sorted([(1, "a", 11), (2, "b", 20), (3, "c", None), (None, "d", None)], key=repr)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "Exchange" not in plan(stores.with_property(nodes, log, "age"))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_opened_again(spark, rows, tmp_path):
    store = stores.create(rows("id long, name string", *[(i, str(i)) for i in range(30)]), ["id"], 4, f"{tmp_path}/t")
    store.drop()
    again = stores.opened(spark, f"{tmp_path}/t", ["id"], 4)
    again.append(rows("id long", (77,)))
    assert again.rows().count() == 31
    assert "Exchange" not in plan(again.rows().groupBy("id").count())


def test_empty_tables_and_batches(rows):
    store = stores.create(rows("src long, dst long, x int"), ["src", "dst"], 2)
    stores.merge_edges(store, rows("src long, dst long"))
    assert store.rows().count() == 0
    stores.merge_edges(store, rows("src long, dst long", (1, 2)))
    assert values(store.rows()) == [(1, 2, None)]
