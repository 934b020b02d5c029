import random

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfold.operators import asof, ordered, splits
from tallyfold.operators.skew import salted_lookup


@pytest.fixture(scope="module")
def table(spark):
    """5000 rows in a shuffled, unevenly spaced order; one user has a third of them."""
    draw = random.Random(7)
    data = [
        (i * i if i % 2 else -i, draw.choice(["hot"] + ["u%d" % (i % 40)] * 2), draw.randrange(1000),
         draw.randrange(3))
        for i in range(5000)
    ]
    draw.shuffle(data)
    return spark.createDataFrame(data, "seq long, user string, v int, w long").repartition(6).persist()


@pytest.mark.parametrize("keys", [[], ["user"]])
def test_running_equals_window(table, keys):
    w = Window.partitionBy(*keys).orderBy("seq")
    for include, end in ((False, -1), (True, 0)):
        frame = w.rowsBetween(Window.unboundedPreceding, end)
        got = ordered.running_max(table, "v", "seq", keys, "m", include, rows_per_bucket=70)
        want = table.withColumn("m", F.max("v").over(frame))
        assert got.exceptAll(want).count() == 0 and got.count() == 5000
    got = ordered.running_sum(table, F.col("w"), "seq", keys, "m", rows_per_bucket=70)
    assert got.exceptAll(table.withColumn("m", F.sum("w").over(w))).count() == 0
    got = ordered.ordinal(table, "seq", keys, "m", rows_per_bucket=70)
    assert got.exceptAll(table.withColumn("m", F.row_number().over(w).cast("long"))).count() == 0


def test_out_of_order_small(rows):
    df = rows("a long, t timestamp_ntz, k string")
    assert ordered.out_of_order(df, "t", "a").count() == 0
    df = rows("a long, t int, k string", (1, 5, "x"), (2, 4, "y"), (3, 5, "x"), (4, None, "x"), (5, 3, "x"))
    assert values(ordered.out_of_order(df, "t", "a"), "a", "previous_time") == [(2, 5), (5, 5)]
    assert values(ordered.out_of_order(df, "t", "a", ["k"]), "a") == [(5,)]


def test_bounds_from_a_sample(table, monkeypatch):
    monkeypatch.setattr(ordered, "SAMPLES_PER_BUCKET", 10)
    sizes = [r["count"] for r in ordered.bucketed(table, "seq", 100).groupBy("_bucket").count().collect()]
    assert len(sizes) > 30 and max(sizes) < 600 and sum(sizes) == 5000
    got = ordered.ordinal(table, "seq", rows_per_bucket=100).orderBy("seq").select("ordinal").collect()
    assert [r[0] for r in got] == list(range(1, 5001))
    assert ordered.cutoff(table, "seq", 1234, rows_per_bucket=100) == sorted(
        r[0] for r in table.select("seq").collect())[1233]


def test_null_key_is_a_group(rows):
    df = rows("a long, t int, k string", (1, 5, None), (2, 4, None))
    assert values(ordered.out_of_order(df, "t", "a", ["k"]), "a") == [(2,)]


def test_cutoffs_equal_sorted_list(table):
    seqs = sorted(r[0] for r in table.select("seq").collect())
    limits = [0, 1, 2, 777, 2500, 4999, 5000, 6000]
    got = ordered.cutoffs(table, "seq", limits, rows_per_bucket=100)
    assert got == [None] + [seqs[min(n, 5000) - 1] for n in limits[1:]]


def test_weighted_cutoff(table):
    pairs = sorted((r[0], r[1]) for r in table.select("seq", "w").collect())
    for limit in (0, 1, 400, 2000, 10**6):
        total, last = 0, None
        for seq, w in pairs:
            total += w
            if total > limit:
                break
            last = seq
        assert ordered.cutoff(table, "seq", limit, F.col("w"), rows_per_bucket=60) == last


def test_cutoff_with_one_dominant_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2000, 5).otherwise(F.col("id")).alias("k"))
    assert ordered.cutoffs(df, "k", [1999, 2000, 2001], rows_per_bucket=50) == [None, 5, 2000]


def test_first_and_capped(rows):
    df = rows("o long, t string", (3, "ccc"), (1, "a"), (2, "žž"))
    assert values(ordered.first_n_records(df, "o", 2), "o") == [(1,), (2,)]
    assert ordered.first_n_records(df, "o", 0).count() == 0
    line = len('{"t":"a"}\n')
    assert values(ordered.capped_rows(df, "o", line), "o") == [(1,)]
    assert values(ordered.capped_rows(df, "o", 2 * line + 3), "o") == [(1,), (2,)]
    assert ordered.capped_rows(df, "o", line - 1).count() == 0


def test_order_of_times_and_dates(spark):
    df = spark.range(2000).select(
        F.timestamp_micros(F.col("id") * 7_000_001).alias("ts"), "id",
        F.timestamp_micros(F.col("id") * 7_000_001).cast("timestamp_ntz").alias("ntz"),
        F.date_add(F.lit("1960-01-01"), F.col("id").cast("int")).alias("d"),
    )
    for column in ("ts", "ntz", "d"):
        got = ordered.ordinal(df, column, rows_per_bucket=100)
        assert got.filter("ordinal <> id + 1").count() == 0
    with pytest.raises(TypeError):
        ordered.bucketed(df.withColumn("s", F.lit("x")), "s")


def test_kfold(spark):
    df = spark.range(103).select((F.col("id") * 7).alias("seq"))
    split = splits.kfold_positional_split(df, "seq", 5, rows_per_bucket=10)
    assert values(split.groupBy("fold").count()) == [(1, 21), (2, 21), (3, 21), (4, 21), (5, 19)]
    fixed = splits.kfold_positional_split(df, "seq", 5, fold_size=20, rows_per_bucket=10)
    assert dict(values(fixed.groupBy("fold").count())) == {i: 20 for i in range(1, 6)} | {None: 3}
    base, test = splits.fold_pair(fixed, 2, "seq")
    assert test.count() == 20 and base.count() == 83
    assert [r[0] for r in test.take(2)] == [140, 147]
    assert base.join(test, "seq").count() == 0
    assert splits.union_folds(base, test).exceptAll(df).count() == 0


def test_leave_n_out_equals_loop(table):
    rows = sorted((r["seq"], r["user"]) for r in table.collect())
    for cap in (0, 50, 10**6):
        seen, taken, want = {}, 0, set()
        for seq, user in rows:
            seen[user] = seen.get(user, 0) + 1
            if (cap <= 0 or taken < cap) and 3 <= seen[user] <= 6:
                taken += 1
                want.add(seq)
        got = splits.leave_n_out_split(table, "user", "seq", 3, 6, cap, rows_per_bucket=90)
        assert {r["seq"] for r in got.filter("is_test").collect()} == want and got.count() == 5000


def test_hash_split(spark):
    df = spark.range(20_000)
    train, test = splits.hash_split(df, "id")
    assert train.count() + test.count() == 20_000 and train.join(test, "id").count() == 0
    assert abs(test.count() - 2000) < 150
    again = splits.hash_split(df.repartition(3), "id")[1]
    assert again.exceptAll(test).count() == 0
    parts = splits.random_split(df, [0.9, 0.1])
    assert sum(p.count() for p in parts) == 20_000


def test_previous_time(spark, rows):
    df = rows("id long, t int", (1, 5), (2, 5), (3, 9), (4, None), (5, 7))
    got = asof.previous_time_lookup(df, "t", "id")
    assert values(got, "id", "previous_time") == [(1, None), (2, None), (3, 7), (4, None), (5, 5)]


def test_salted_lookup_keeps_every_row(spark):
    rows = spark.range(9000).select(
        "id", F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 100 == 1, None)
        .otherwise(F.col("id") % 500).alias("k"),
    )
    lookup = rows.filter("k is not null").groupBy("k").agg(F.count("*").alias("n"))
    lookup = lookup.withColumn("name", F.concat(F.lit("n"), "k"))
    got = salted_lookup(rows, lookup, "k", "id", "n", "left", splits=16)
    want = rows.join(lookup.drop("n"), "k", "left").select("k", "id", "name")
    assert got.select("k", "id", "name").exceptAll(want).count() == 0 and got.count() == 9000


@pytest.mark.parametrize("per_bucket", [5, 100, ordered.ROWS_PER_SEARCH])
def test_null_order_keys_come_last_at_any_bucket_size(spark, per_bucket):
    df = spark.range(1000).select(
        F.when(F.col("id") % 100 != 7, F.col("id")).alias("o"), (F.col("id") % 4).cast("string").alias("user"),
        F.lit("x").alias("t"))
    assert ordered.first_n_records(df, "o", 50, per_bucket).count() == 50
    assert ordered.first_n_records(df, "o", 995, per_bucket).count() == 990
    assert ordered.first_n_records(df, "o", 1000, per_bucket).count() == 1000
    line = len('{"user":"1","t":"x"}\n')
    assert ordered.capped_rows(df, "o", 50 * line, rows_per_bucket=per_bucket).count() == 50
    assert ordered.capped_rows(df, "o", 1000 * line, rows_per_bucket=per_bucket).count() == 1000
    folds = splits.kfold_positional_split(df, "o", 5, rows_per_bucket=per_bucket)
    assert dict(values(folds.groupBy("fold").count())) == {i: 200 for i in range(1, 6)}
    left = splits.leave_n_out_split(df, "user", "o", 2, 4, 7, rows_per_bucket=per_bucket)
    # Per user the second to fourth row, and the first seven of these along the order.
    assert sorted(r["o"] for r in left.filter("is_test").collect()) == [4, 5, 6, 8, 9, 10, 11]
    numbers = ordered.ordinal(df, "o", rows_per_bucket=per_bucket)
    assert [r[0] for r in numbers.orderBy("ordinal").select("ordinal").collect()] == list(range(1, 1001))
    assert numbers.filter("o is null").agg(F.min("ordinal")).first()[0] == 991


def test_all_keys_null(rows):
    df = rows("o long, t string", (None, "a"), (None, "b"))
    assert ordered.first_n_records(df, "o", 1).count() == 0 and ordered.first_n_records(df, "o", 2).count() == 2
    assert values(ordered.ordinal(df, "o"), "ordinal") == [(1,), (2,)]


def test_buckets_split_what_doubles_and_seconds_cannot(spark):
    df = spark.range(20_000).select(
        (F.col("id") + F.lit(1 << 60)).alias("big"),
        F.timestamp_micros(F.col("id")).cast("timestamp_ntz").alias("time"),
        F.when(F.col("id") < 10_000, F.lit(-(1 << 63)) + F.col("id")).otherwise(F.lit((1 << 62)) + F.col("id") * 5000).alias("wide"))
    for column in ("big", "time"):
        assert ordered.bucketed(df, column, 1000).select("_bucket").distinct().count() >= 20
    for column in ("big", "time", "wide"):
        got = ordered.ordinal(df, column, rows_per_bucket=1000).select("ordinal").distinct()
        assert got.count() == 20_000
        wanted = sorted(r[0] for r in df.select(column).collect())[4320]
        assert ordered.cutoff(df, column, 4321, rows_per_bucket=1000) == wanted


def test_one_shuffle_without_a_hot_user(spark, capsys):
    df = spark.range(60_000).select("id", (F.col("id") % 20_000).alias("user"))
    numbered = ordered.ordinal(df, "id", ["user"])
    numbered.explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 1
