"""What physical plans must not hold, with broadcasts by size switched off."""

import io
from contextlib import redirect_stdout

import pytest
from conftest import SMALL

from tallyfold.plans import REGISTRY as QUERIES

PYTHON = {"extract_articles", "extract_links"}
# Streams and model fits run while their frame is built; their inner plans are those of
# the operators below.
EAGER = {"late_data_drop", "multi_sink", "regress_tree", "classify_logistic", "classify_mlp",
         "fallback_model", "corpus_report", "append_jsonl_capped"} | {n for n in QUERIES if n.startswith("stream_")}


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture(scope="module")
def shuffling(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_plan(shuffling, name):
    text = plan(QUERIES[name](shuffling, SMALL))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    for python in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert python not in text
    assert ("MapInPandas" in text) == (name in PYTHON)
    # A window without keys may only follow a list of buckets or months, which is aggregated.
    lines = text.splitlines()
    for at, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "Aggregate" in lines[at + 1] or "Project" in lines[at + 1], text


def test_pushdown(spark):
    events = plan(QUERIES["multi_sink"](spark, SMALL)) and plan(
        spark.read.parquet(f"{SMALL}/events.parquet").filter("value > 100").select("event_id"))
    assert "GreaterThan(value,100.0)" in events and "ReadSchema: struct<event_id:bigint,value:double>" in events


def test_first_records_are_filtered_in_the_scan(spark):
    text = plan(QUERIES["first_n_records"](spark, SMALL))
    assert "LessThanOrEqual(o_orderkey" in text and "Exchange" not in text


def test_folds_do_not_move_rows(spark):
    assert "Exchange" not in plan(QUERIES["kfold_positional_split"](spark, SMALL))


@pytest.mark.parametrize("name, most", [
    ("union_years", 1), ("union_folds", 1), ("random_split", 1), ("kfold_positional_split", 1), ("graph_merge_edge", 4)])
def test_tables_are_scanned_once(spark, name, most):
    """Scans of the given tables; what a query has written itself is not counted."""
    scans = [line for line in plan(QUERIES[name](spark, SMALL)).splitlines() if "FileScan" in line]
    assert sum("testdata" in line for line in scans) <= most


@pytest.mark.parametrize("name", ["graph_merge_edge", "graph_set_property", "graph_upsert_counter"])
def test_stores_are_read_without_a_shuffle(shuffling, name):
    text = plan(QUERIES[name](shuffling, SMALL))
    assert "Exchange" not in text and "store-" in text


def test_no_text_is_dealt_anew_in_a_large_table(spark, monkeypatch):
    from tallyfold.sources import files

    monkeypatch.setattr(files, "SPREAD_BYTES", 0)
    assert "Exchange" not in plan(QUERIES["extract_articles"](spark, SMALL))
