"""Deletes and incremental appends on stored tables.

A table is never overwritten while it is read: each change is written as a new
version next to the old one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def delete_where(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Kept rows, and a one-row count of the removed. Unknown conditions keep the row."""
    doomed = F.coalesce(condition, F.lit(False))
    return df.filter(~doomed), df.agg(F.count_if(doomed).alias("removed"))


def delete_older_than(df: DataFrame, column: str, day: str) -> tuple[DataFrame, DataFrame]:
    """Remove rows dated before ``day``; rows without a known date stay."""
    return delete_where(df, F.col(column) < F.lit(day).cast("timestamp_ntz"))


def write_version(df: DataFrame, root: str, version: int) -> str:
    """Write one version of a table; fails rather than replace an existing one."""
    path = f"{root.rstrip('/')}/v={version:08d}"
    df.write.mode("error").parquet(path)
    return path


def first_per_key(batch: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key along ``order``, which is unique within a key.

    Only keys and order numbers are grouped; whole rows are then picked by both,
    so copies of one key do not meet in one task.
    """
    first = batch.groupBy(F.col(key).alias("_key")).agg(F.min(order).alias("_first"))
    same = batch[key].eqNullSafe(first["_key"]) & (batch[order] == first["_first"])
    return batch.join(first, same, "left_semi")


def anti_join_seen(batch: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``seen``."""
    return batch.join(seen.select(key).distinct(), key, "left_anti")


def frontier_new_urls(candidates: DataFrame, collected: DataFrame, key: str = "url") -> DataFrame:
    """Candidate keys not collected yet, each once."""
    return anti_join_seen(candidates.select(key).filter(F.col(key).isNotNull()).distinct(),
                          collected, key)


def incremental_append(
    collected: DataFrame, batch: DataFrame, key: str, order: str
) -> DataFrame:
    """Rows of ``batch`` to append: unseen keys, the first row of each."""
    return anti_join_seen(first_per_key(batch, key, order), collected, key)


def incremental_append_all(
    collected: DataFrame, batches: list[DataFrame], key: str, order: str
) -> DataFrame:
    """The table after a list of batches in turn; ``order`` counts within a batch.

    The earliest batch and row of a key win, which is what appending batch by
    batch gives, in one pass over all of them.
    """
    numbered = [
        b.withColumn("_batch", F.struct(F.lit(i).alias("batch"), F.col(order).alias("row")))
        for i, b in enumerate(batches)
    ]
    rows = reduce(DataFrame.unionByName, numbered)
    fresh = incremental_append(collected, rows, key, "_batch").drop("_batch", order)
    return collected.unionByName(fresh)
