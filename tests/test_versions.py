import datetime

import pytest
from conftest import values

from tallyfold.operators import versions


def day(n):
    return datetime.datetime(2020, 1, 1) + datetime.timedelta(days=n)


@pytest.fixture
def table(rows, tmp_path):
    data = [(i, day(i // 10) if i % 50 else None) for i in range(400)]
    return versions.create(rows("id long, at timestamp_ntz", *data), "at", f"{tmp_path}/t", file_rows=20)


def left(version):
    return {r["id"] for r in version.rows().collect()}


def test_manifest_says_what_the_files_hold(table):
    listed = table.manifest().collect()
    assert sum(r["rows"] for r in listed) == 400 and sum(r["unknown"] for r in listed) == 8
    for r in listed:
        held = table.spark.read.parquet(r["file"]).filter("at is not null").agg({"at": "min"}).first()[0]
        assert held == r["least"]


def test_only_files_with_doomed_rows_are_rewritten(table):
    cut = day(17)
    before = {r["file"]: r for r in table.manifest().collect()}
    new, removed = versions.delete_before(table, cut)
    wanted = {i for i in range(400) if i % 50 == 0 or i // 10 >= 17}
    assert left(new) == wanted and removed == 400 - len(wanted)
    after = set(new.files())
    doomed = {f for f, r in before.items() if r["least"] is not None and r["least"] < cut}
    assert after & set(before) == set(before) - doomed and 0 < len(doomed) < len(before)
    # Files of nothing but doomed rows are not rewritten either: few new ones are made.
    mixed = [f for f in doomed if before[f]["greatest"] >= cut or before[f]["unknown"]]
    assert 1 <= len(after - set(before)) <= len(mixed)
    assert left(table) == set(range(400))  # the old version


def test_nothing_or_everything_to_delete(table):
    same, removed = versions.delete_before(table, day(-1))
    assert removed == 0 and set(same.files()) == set(table.files())
    none, removed = versions.delete_before(same, day(1000))
    assert removed == 392 and left(none) == set(range(0, 400, 50))
    again, removed = versions.delete_before(none, day(1000))
    assert removed == 0 and left(again) == left(none)


def test_whole_files_are_counted_without_being_read(rows, tmp_path):
    df = rows("id long, at date", *[(i, day(i).date()) for i in range(100)])
    table = versions.create(df, "at", f"{tmp_path}/t", file_rows=10)
    for file in table.files():
        assert file.endswith(".parquet")
    new, removed = versions.delete_before(table, day(200).date())
    assert (new.files(), removed, new.rows().count(), new.rows().columns) == ([], 100, 0, ["id", "at"])


def test_a_version_is_never_replaced(table):
    versions.delete_before(table, day(5))
    with pytest.raises(Exception, match="(?i)exist"):
        versions.delete_before(table, day(6))


def test_empty_table(rows):
    table = versions.create(rows("id long, at timestamp_ntz"), "at")
    new, removed = versions.delete_before(table, day(0))
    assert removed == 0 and values(new.rows()) == []
