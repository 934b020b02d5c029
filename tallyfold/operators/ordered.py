"""Running aggregates and exact cut-offs along one global order.

A window without partition keys would sort the whole table in one task. Here the
order is cut into buckets of about equal row counts (quantiles, so a dense
stretch of the order does not fill one bucket); each bucket is reduced to one
row, the short list of buckets is accumulated, and only then are rows ordered,
inside their bucket. With grouping keys, groups of more rows than a bucket spread over
the buckets they cover; all others are ordered whole.

Order keys have to be unique: rows that share one fall into the same bucket. A null
key comes after all others, whatever the size of the table: it counts, and rows with
null keys are chosen last, all together or not at all, like rows of any one key.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyfold.session import materialize

ROWS_PER_BUCKET = 1_000_000
# Bounds every list of one row per bucket. Above 65 billion rows buckets grow with the
# table, to 15 million rows at a trillion; sorting them spills but stays in many tasks.
MAX_BUCKETS = 65_536
SAMPLES_PER_BUCKET = 200
ROWS_PER_SEARCH = 100_000  # rows among which a cut-off is looked up in one task
_BUCKET, _POSITION = "_bucket", "_position"


class _Everything:
    """In place of a last key: all rows, those with null keys included."""

    def __repr__(self) -> str:
        return "EVERYTHING"


EVERYTHING = _Everything()


def _whole_number(df: DataFrame, order: str) -> Column | None:
    """The order key as a long, without loss; None if it is a fraction."""
    kind, col = df.schema[order].dataType, F.col(order)
    if isinstance(kind, T.IntegralType):
        return col.cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(kind, T.TimestampNTZType):
        # Field by field: independent of the session zone and its clock changes.
        minutes = (F.unix_date(F.to_date(col)).cast("long") * 24 + F.hour(col)) * 60 + F.minute(col)
        return minutes * 60_000_000 + (F.date_part(F.lit("SECOND"), col) * 1_000_000).cast("long")
    if isinstance(kind, T.NumericType):
        return None
    raise TypeError(f"cannot bucket an order key of type {kind.simpleString()}")


def _positioned(df: DataFrame, order: str) -> tuple[DataFrame, int, int]:
    """``df`` with ``_position``, its rows with a key, and those without.

    A position is a double that never decreases along the order: the distance from the
    least key. It is exact up to 2**53; beyond that at most 2**11 whole keys share one.
    """
    number = _whole_number(df, order)
    col = F.col(order) if number is None else number
    facts = df.agg(
        F.count(order).alias("rows"), F.count("*").alias("all"), F.min(col).alias("low"), F.max(col).alias("high")
    ).first()
    if number is not None and facts["low"] is not None:
        if facts["high"] - facts["low"] < 1 << 63:
            col = number - F.lit(facts["low"])
        else:
            col = number.cast("decimal(20,0)") - F.lit(facts["low"]).cast("decimal(20,0)")
    return df.withColumn(_POSITION, col.cast("double")), facts["rows"], facts["all"] - facts["rows"]


def _inner_bounds(slim: DataFrame, buckets: int, rows: int) -> list[float]:
    """Quantiles of ``_position`` that cut ``slim`` into at most ``buckets`` pieces.

    A long table is sampled for them: bounds only balance the buckets, results do
    not depend on where they lie.
    """
    if buckets < 2:
        return []
    share = SAMPLES_PER_BUCKET * buckets / rows
    sample = slim.select(_POSITION) if share >= 1 else slim.select(_POSITION).sample(share, seed=42)
    fractions = [i / buckets for i in range(1, buckets)]
    return sorted(set(sample.approxQuantile(_POSITION, fractions, 1 / (5 * buckets))))


def bucketed(
    df: DataFrame, order: str, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """``df`` with a ``_bucket`` column; bucket numbers rise along ``order``.

    The bounds are literals, so a task run again after a lost executor assigns
    the same buckets. Rows without a key fill the last buckets, dealt by their content.
    """
    columns = [f"`{c}`" for c in df.columns]
    df, rows, without = _positioned(df, order)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Enough buckets to keep all tasks busy, but none for a handful of rows.
    wanted = max(min(4 * tasks, rows // 1000), math.ceil(rows / rows_per_bucket))
    bounds = _inner_bounds(df.filter(F.col(_POSITION).isNotNull()), min(wanted, MAX_BUCKETS), rows)
    cut = _cut(df, bounds)
    more = min(math.ceil(without / rows_per_bucket), MAX_BUCKETS)
    if more > 1:
        dealt = F.pmod(F.xxhash64(*columns), F.lit(more)).cast("int")
        cut = cut.withColumn(
            _BUCKET, F.when(F.col(order).isNull(), F.col(_BUCKET) + dealt).otherwise(F.col(_BUCKET)))
    return cut


def _cut(df: DataFrame, bounds: Sequence[float]) -> DataFrame:
    cutter = Bucketizer(
        splits=[-math.inf, *bounds, math.inf] if bounds else [-math.inf, 0.0, math.inf],
        inputCol=_POSITION, outputCol=_BUCKET, handleInvalid="keep",
    )
    # A null is no position for the cutter; it goes behind all of them.
    last = F.lit(max(len(bounds), 1) + 1)
    return cutter.transform(df).withColumn(
        _BUCKET, F.coalesce(F.col(_BUCKET).cast("int"), last)).drop(_POSITION)


def _running(
    df: DataFrame, order: str, keys: Sequence[str], value: Column,
    gather: Callable[[str], Column], include_self: bool, rows_per_bucket: int, out: str,
) -> DataFrame:
    """``gather`` over the earlier rows.

    Rows of a key with at most ``rows_per_bucket`` of them are ordered whole, in one shuffle.
    Only keys beyond that, of which there are few by their number of rows, are cut into buckets.
    """
    if keys:
        hot = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows_per_bucket).drop("_n")
        hot = materialize(hot, "hot-keys")
        inside = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(order)).rowsBetween(
            Window.unboundedPreceding, Window.currentRow if include_self else -1)
        if hot.isEmpty():
            return df.withColumn(out, gather(value).over(inside))
        named = hot.select(*[F.col(k).alias(f"_hot_{i}") for i, k in enumerate(keys)], F.lit(True).alias("_hot"))
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_hot_{i}")) for i, k in enumerate(keys)])
        # At most one row in ``rows_per_bucket`` of the table.
        flagged = df.join(F.broadcast(named), same, "left")
        cold = flagged.filter(F.col("_hot").isNull()).select(df.columns)
        rest = _in_buckets(
            flagged.filter("_hot").select(df.columns), order, keys, value, gather, include_self, rows_per_bucket, out)
        return cold.withColumn(out, gather(value).over(inside)).unionByName(rest)
    return _in_buckets(df, order, keys, value, gather, include_self, rows_per_bucket, out)


def _in_buckets(
    df: DataFrame, order: str, keys: Sequence[str], value: Column,
    gather: Callable[[str], Column], include_self: bool, rows_per_bucket: int, out: str,
) -> DataFrame:
    """``gather`` over the earlier rows, bucket by bucket.

    What the buckets before have gathered enters each bucket as one more row, ahead
    of all others: one shuffle and one sort of the rows, and no join.
    """
    rows = bucketed(df.withColumn("_value", value), order, rows_per_bucket)
    per_bucket = rows.groupBy(*keys, _BUCKET).agg(gather("_value").alias("_total"))
    # Without keys this orders one row per bucket, MAX_BUCKETS at most.
    before = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = per_bucket.select(*keys, _BUCKET, gather("_total").over(before).alias("_value"))
    both = rows.withColumn("_carried", F.lit(False)).unionByName(
        carried.withColumn("_carried", F.lit(True)), allowMissingColumns=True
    )
    inside = Window.partitionBy(*keys, _BUCKET).orderBy(
        F.desc("_carried"), F.asc_nulls_last(order)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if include_self else -1
    )
    gathered = both.select(*df.columns, "_carried", gather("_value").over(inside).alias(out))
    return gathered.filter(~F.col("_carried")).drop("_carried")


def running_max(
    df: DataFrame, value: str, order: str, keys: Sequence[str] = (), out: str = "running_max",
    include_self: bool = False, rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Largest ``value`` among the earlier rows (of the same ``keys``)."""
    return _running(df, order, keys, F.col(value), F.max, include_self, rows_per_bucket, out)


def running_sum(
    df: DataFrame, value: Column, order: str, keys: Sequence[str] = (), out: str = "running_sum",
    include_self: bool = True, rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Sum of ``value`` up to each row; nulls count as nothing."""
    sums = _running(df, order, keys, value, F.sum, include_self, rows_per_bucket, out)
    return sums.withColumn(out, F.coalesce(out, F.lit(0)))


def ordinal(
    df: DataFrame, order: str, keys: Sequence[str] = (), out: str = "ordinal",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """1-based position along ``order`` (within ``keys``)."""
    return running_sum(
        df, F.lit(1).cast("long"), order, keys, out, rows_per_bucket=rows_per_bucket
    )


def out_of_order(
    df: DataFrame, time: str, arrival: str, keys: Sequence[str] = (),
    out: str = "previous_time", rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Rows whose event time lies before one that arrived earlier, with that time."""
    seen = running_max(df, time, arrival, keys, out, rows_per_bucket=rows_per_bucket)
    return seen.filter(F.col(time) < F.col(out))


def cutoffs(
    df: DataFrame, order: str, limits: Sequence[int], weight: Column | None = None,
    rows_per_bucket: int = ROWS_PER_SEARCH,
) -> list:
    """Per limit, the last order key up to which the total weight is at most the limit.

    EVERYTHING where rows with null keys fit too; None where not even the first row fits.

    Weights must not be negative; without one each row weighs 1, so the result
    is the ``limit``-th smallest key.
    Rows are only counted per bucket, not moved; the bucket that holds a crossing
    is looked at again, until it is small.
    """
    if weight is None:
        slim = df.select(order, F.lit(1).cast("long").alias("_weight"))
    else:  # weights are computed from whole rows: once
        weight = F.coalesce(weight.cast("long"), F.lit(0))
        slim = materialize(df.select(order, weight.alias("_weight")), "weights")
    slim, rows, without = _positioned(slim, order)
    limits, found = list(limits), []
    if rows:
        found = _cutoffs(slim.filter(F.col(order).isNotNull()), order, limits, rows, rows_per_bucket)
    else:
        found = [None] * len(limits)
    if without:
        total = slim.agg(F.sum("_weight")).first()[0]
        found = [EVERYTHING if limit >= total else last for limit, last in zip(limits, found)]
    return found


def up_to(order: str, last) -> Column:
    """Whether a row lies at or before a cut-off; null for a null key beyond it."""
    if last is None or last is EVERYTHING:
        return F.lit(last is EVERYTHING)
    return F.col(order) <= F.lit(last)


def _cutoffs(
    slim: DataFrame, order: str, limits: list[int], rows: int, rows_per_bucket: int
) -> list:
    whole = (-math.inf, math.inf, limits)
    if rows <= rows_per_bucket:
        return _search(slim, order, [whole])[0]
    bounds = _inner_bounds(slim, min(math.ceil(rows / rows_per_bucket), MAX_BUCKETS), rows)
    tallies = (
        _cut(slim.withColumn("_at", F.col(_POSITION)), bounds)
        .groupBy(_BUCKET)
        .agg(F.sum("_weight").alias("weight"), F.max(order).alias("last"),
             F.count("*").alias("n"), F.min("_at").alias("low"), F.max("_at").alias("high"))
        .orderBy(_BUCKET)
        .collect()  # at most MAX_BUCKETS rows
    )
    if len(tallies) < 2:  # one position only
        return _search(slim, order, [whole])[0]
    found: list = [None] * len(limits)
    crossings: dict[int, list[tuple[int, int]]] = {}
    for i, room in enumerate(limits):
        for at, tally in enumerate(tallies):
            if tally["weight"] > room:
                crossings.setdefault(at, []).append((i, room))
                break
            room -= tally["weight"]
            found[i] = tally["last"]
    inner: dict[int, list] = {}
    small = [at for at in crossings if tallies[at]["n"] <= 2 * rows_per_bucket]
    ranges = [(tallies[at]["low"], tallies[at]["high"], [room for _, room in crossings[at]])
              for at in small]
    if small:
        inner.update(zip(small, _search(slim, order, ranges)))
    for at in set(crossings) - set(small):
        tally, rooms = tallies[at], [room for _, room in crossings[at]]
        part = slim.filter(F.col(_POSITION).between(tally["low"], tally["high"]))
        inner[at] = _cutoffs(part, order, rooms, tally["n"], rows_per_bucket)
    for at, asked in crossings.items():
        for (i, _), last in zip(asked, inner[at]):
            found[i] = found[i] if last is None else last
    return found


def _search(
    slim: DataFrame, order: str, ranges: list[tuple[float, float, list[int]]]
) -> list[list]:
    """Cut-offs within short ranges of positions, all in one scan; a task per range."""
    part = F.coalesce(*[
        F.when(F.col(_POSITION).between(low, high), i) for i, (low, high, _) in enumerate(ranges)
    ])
    inside = Window.partitionBy("_part").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    sums = (
        slim.withColumn("_part", part).filter(F.col("_part").isNotNull())
        .groupBy("_part", order).agg(F.sum("_weight").alias("_weight"))
        .select("_part", order, F.sum("_weight").over(inside).alias("_sum"))
    )
    asked = [(i, limit) for i, (_, _, limits) in enumerate(ranges) for limit in limits]
    fits = [
        F.max(F.when((F.col("_part") == i) & (F.col("_sum") <= limit), F.col(order))).alias(str(at))
        for at, (i, limit) in enumerate(asked)
    ]
    answers = iter(sums.agg(*fits).first())
    return [[next(answers) for _ in limits] for _, _, limits in ranges]


def cutoff(df: DataFrame, order: str, limit: int, weight: Column | None = None,
           rows_per_bucket: int = ROWS_PER_SEARCH):
    """``cutoffs`` for a single limit."""
    return cutoffs(df, order, [limit], weight, rows_per_bucket)[0]


def first_n_records(
    df: DataFrame, order: str, n: int, rows_per_bucket: int = ROWS_PER_SEARCH
) -> DataFrame:
    """The first ``n`` rows along a unique ``order``.

    ``n`` may be large: the n-th key is found from the order column alone, and
    the wide rows are then filtered where they lie.
    """
    return df.filter(up_to(order, cutoff(df, order, n, rows_per_bucket=rows_per_bucket)))


def json_bytes(df: DataFrame, order: str) -> Column:
    """Bytes of a row (without its order key) as one JSON line."""
    fields = [c for c in df.columns if c != order]
    return F.octet_length(F.to_json(F.struct(*fields))) + F.lit(1)


def capped_rows(
    df: DataFrame, order: str, cap_bytes: int, size: Column | None = None,
    rows_per_bucket: int = ROWS_PER_SEARCH,
) -> DataFrame:
    """The longest run of first rows whose total size is at most ``cap_bytes``."""
    size = json_bytes(df, order) if size is None else size
    return df.filter(up_to(order, cutoff(df, order, cap_bytes, size, rows_per_bucket)))
