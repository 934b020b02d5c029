import pytest
from conftest import values
from pyspark.sql import functions as F

from tallyfold.operators import learning as L
from tallyfold.operators import rows as R
from tallyfold.operators import splits as P
from tallyfold.session import materialize


@pytest.fixture(scope="module")
def flights(spark):
    """Delays that depend on the hour alone, with categories of distinct frequency."""
    return spark.range(3000).select(
        "id", (F.col("id") % 24).alias("hour"), (F.col("id") % 7).alias("day"),
        F.when(F.col("id") % 3 == 0, "B").otherwise("A").alias("carrier"),
        F.when(F.col("id") % 24 > 12, 1).otherwise(0).alias("label"),
    )


def ready(flights):
    indexed = L.index_categories(flights, ["carrier"])
    # Written once, as fits read their rows many times.
    return P.hash_split(materialize(L.assemble_features(indexed, ["hour", "day", "carrier_index"]), "features"), "id")


def test_index_by_frequency_then_name(rows):
    df = rows("c string", ("b",), ("a",), ("c",), ("c",), (None,))
    assert values(L.index_table(df, ["c"])) == [("c", "a", 1.0), ("c", "b", 2.0), ("c", "c", 0.0)]


def test_a_million_values_are_numbered_in_order(spark):
    df = spark.range(1_000_500).select(
        F.concat(F.lit("v"), F.lpad(F.when(F.col("id") < 1_000_000, F.col("id")).otherwise(7), 7, "0")).alias("c"))
    index = L.dictionary(df, "c")
    facts = index.agg(F.count("*"), F.countDistinct("idx"), F.min("idx"), F.max("idx")).first()
    assert tuple(facts) == (1_000_000, 1_000_000, 0.0, 999_999.0)
    picked = {r["value"]: r["idx"] for r in index.filter("value in ('v0000007', 'v0000000', 'v0000006', 'v0999999')").collect()}
    assert picked == {"v0000007": 0.0, "v0000000": 1.0, "v0000006": 7.0, "v0999999": 999_999.0}


def test_unseen_values(rows):
    seen, df = rows("c string", ("b",), ("b",), ("a",), (None,)), rows("c string, x int", ("a", 1), ("z", 2), (None, 3), ("b", 4))
    got = L.index_categories(df, ["c"], seen)
    assert got.columns == ["c", "x", "c_index"] and values(got, "x", "c_index") == [(1, 1.0), (4, 0.0)]
    kept = L.index_categories(df, ["c"], seen, "keep")
    assert values(kept, "x", "c_index") == [(1, 1.0), (2, 2.0), (3, 2.0), (4, 0.0)]
    with pytest.raises(Exception, match="no index for"):
        L.index_categories(df, ["c"], seen, "error").collect()
    assert L.index_table(rows("c string"), ["c"]).count() == 0


def test_features_skip_nulls(rows):
    df = rows("a int, b double", (1, 2.0), (None, 1.0))
    assert L.assemble_features(df, ["a", "b"]).count() == 1
    with pytest.raises(Exception, match="null"):
        L.assemble_features(df, ["a", "b"], invalid="error").collect()


def test_labels_and_casts(rows):
    df = rows("d string, c int", ("5", 0), ("-1", 0), ("NA", 0), ("3", 1))
    df = R.cast_columns(df, {"d": "int"})
    df = R.filter_flag_notnull(df, F.col("c") == 0, "d")
    assert values(R.with_label(df, F.col("d") > 0), "d", "label") == [(-1, 0), (5, 1)]


def test_tree(spark):
    df = spark.range(2000).select("id", (F.col("id") % 50).alias("x"), ((F.col("id") % 50) * 3.0).alias("y"))
    train, test = P.hash_split(df, "id")
    predicted = L.regress_tree(train, test, ["x"], "y")
    rmse = L.eval_rmse(predicted, "y").first()[0]
    spread = test.agg(F.stddev_pop("y")).first()[0]
    assert predicted.count() == test.count() and rmse < spread / 5


def test_metrics(rows):
    df = rows("label double, prediction double", (1.0, 1.0), (0.0, 2.0), (0.0, 0.0), (1.0, 1.0))
    assert L.eval_accuracy(df, "label").first()[0] == 0.75
    assert L.eval_rmse(df, "label").first()[0] == 1.0
    assert L.eval_accuracy(df.limit(0), "label").first()[0] is None


def test_logistic_and_fallback(flights):
    train, test = ready(flights)
    accuracy = L.eval_accuracy(L.classify_logistic(train, test, partitions=4), "label").first()[0]
    assert accuracy > 0.9
    assert values(L.fallback_model(train, test, 0.55), "model", "chosen") == [("logistic", True)]
    assert values(L.fallback_model(train, test, 1.01), "model", "chosen") == [
        ("logistic", False), ("mlp", True)]


def test_training_rows_are_not_shuffled_again(spark):
    rows = spark.range(0, 3000, 1, 6).select((F.col("id") % 24).alias("hour"), (F.col("id") % 2).cast("double").alias("late"))
    ready = L.repartition_for_training(L.assemble_features(rows, ["hour"]), 4, "late")
    text = ready._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "FileScan" in text
    assert ready.count() == 3000 and ready.rdd.getNumPartitions() >= 4
    small = L.repartition_for_training(L.assemble_features(rows.limit(3).coalesce(1), ["hour"]), 4, "late")
    assert small.count() == 3 and small.rdd.getNumPartitions() == 4
