"""Joins that hold up when one key has a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPLITS = 64


def salted_lookup(
    rows: DataFrame, lookup: DataFrame, on: str, spread: str, weight: str,
    how: str = "inner", splits: int = SPLITS, hot_share: float = 0.005,
) -> DataFrame:
    """Join ``rows`` to ``lookup``, which holds each ``on`` value once.

    ``weight`` is the number of rows of that key, already counted with the
    lookup. Keys with more than ``hot_share`` of all rows, at most 1/hot_share of
    them, are copied ``splits`` times and their rows spread by the hash of
    ``spread``; every other row takes part unsalted. No row is lost either way.
    """
    total = lookup.agg(F.sum(weight)).scalar()
    sized = lookup.withColumn("_hot", F.col(weight) > total * F.lit(hot_share))
    hot = F.broadcast(sized.filter("_hot").select(on, F.lit(True).alias("_is_hot")))
    salted_rows = rows.join(hot, on, "left").withColumn(
        "_salt",
        F.when(
            F.col("_is_hot") | F.col(on).isNull(),
            F.pmod(F.xxhash64(spread), F.lit(splits)).cast("int"),
        ).otherwise(0),
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(splits - 1))).otherwise(
        F.array(F.lit(0))
    )
    salted_lookup_side = sized.withColumn("_salt", F.explode(copies)).drop("_hot", weight)
    return salted_rows.drop("_is_hot").join(salted_lookup_side, [on, "_salt"], how).drop("_salt")
