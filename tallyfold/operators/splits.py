"""Training and test splits."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.ordered import (
    ROWS_PER_BUCKET, ROWS_PER_SEARCH, cutoff, cutoffs, ordinal, up_to,
)
from tallyfold.session import materialize


def kfold_positional_split(
    df: DataFrame, order: str, folds: int = 5, fold_size: int | None = None,
    rows_per_bucket: int = ROWS_PER_SEARCH,
) -> DataFrame:
    """``df`` with the fold (1 to ``folds``) of each row by position along ``order``.

    Only the few boundary keys are searched; rows get their fold by comparison
    and are not moved. With a ``fold_size``, rows past the last fold get none.
    """
    size = fold_size or max(1, math.ceil(df.count() / folds))
    sizes = [size * i for i in range(1, folds + 1 if fold_size else folds)]
    ends = cutoffs(df, order, sizes, rows_per_bucket=rows_per_bucket) if sizes else []
    passed = [F.when(up_to(order, end), 0).otherwise(1) for end in ends if end is not None]
    fold = F.lit(1) + reduce(Column.__add__, passed, F.lit(0))
    return df.withColumn("fold", F.when(fold <= folds, fold))


def fold_pair(
    split: DataFrame, fold: int, *sort: str
) -> tuple[DataFrame, DataFrame]:
    """Base and test rows of one fold, sorted for writing."""
    is_test = F.col("fold").eqNullSafe(F.lit(fold))
    base, test = split.filter(~is_test).drop("fold"), split.filter(is_test).drop("fold")
    return (base.orderBy(*sort), test.orderBy(*sort)) if sort else (base, test)


def leave_n_out_split(
    df: DataFrame, user: str, order: str, start: int, stop: int, max_test: int = 0,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``df`` with ``is_test``: the rows numbered start to stop of each user.

    At most ``max_test`` rows in all, the first along ``order``; 0 or less sets no
    cap. A user with a large part of all rows is numbered in several tasks.
    """
    numbered = ordinal(df, order, [user], "_n", rows_per_bucket)
    is_test = F.col("_n").between(start, stop)
    if max_test > 0:
        tests = materialize(numbered.filter(is_test).select(order), "tests")
        last = cutoff(tests, order, max_test, rows_per_bucket=min(rows_per_bucket, ROWS_PER_SEARCH))
        is_test = is_test & F.coalesce(up_to(order, last), F.lit(False))
    return numbered.withColumn("is_test", is_test).drop("_n")


def random_split(df: DataFrame, weights: list[float], seed: int = 42) -> list[DataFrame]:
    """Spark's own random split; which rows go where depends on the partitioning."""
    return df.randomSplit(weights, seed)


def split_share(key: str, seed: int = 42) -> Column:
    """A number in [0, 1) fixed by seed and key."""
    digest = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def hash_split(
    df: DataFrame, key: str, train: float = 0.9, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Random split that is the same on every run and after a lost executor."""
    share = split_share(key, seed)
    return df.filter(share < train), df.filter(share >= train)


def united_folds(split: DataFrame) -> DataFrame:
    """The rows of all folds of a labelled split, in one pass."""
    return split.filter(F.col("fold").isNotNull()).drop("fold")


def union_folds(*folds: DataFrame) -> DataFrame:
    """The full set out of disjoint folds."""
    return reduce(DataFrame.unionByName, folds)
