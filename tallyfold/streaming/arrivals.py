"""Out-of-order detection on a stream."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tallyfold.operators.ordered import ROWS_PER_BUCKET, out_of_order
from tallyfold.streaming.runner import BATCH, batch_folder, read_batches, run_batches


def stream_out_of_order(
    df: DataFrame, time: str, arrival: str, keys: Sequence[str] = (), out: str = "previous_time",
    rows_per_bucket: int = ROWS_PER_BUCKET, compact_every: int = 50, trigger: dict | None = None,
    root: str | None = None,
) -> DataFrame:
    """Rows that came after a row (of the same keys) with a later event time.

    ``arrival`` is a number that grows from batch to batch. State is the latest
    time per key: each micro-batch writes the keys it touched, and every
    ``compact_every``-th the merged table. The state of the keys in a batch joins
    it as rows that arrived before all others. Rows are then compared by ordered
    buckets, so a key with most of the rows is not handed to one task, as a keyed
    state function would.
    """
    spark = df.sparkSession

    def latest(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(F.max(time).alias(time))

    def known_before(batch_id: int, root: str) -> DataFrame | None:
        if batch_id == 0:
            return None
        base = (batch_id - 1) // compact_every * compact_every
        folders = [batch_folder(f"{root}/state", i) for i in range(base, batch_id)]
        return latest(spark.read.parquet(*folders))

    def each(batch: DataFrame, batch_id: int, root: str) -> None:
        batch.persist()
        try:
            rows, changed = batch, latest(batch)
            known = known_before(batch_id, root)
            if known is not None:
                start = batch.agg(F.min(arrival) - 1).scalar()
                touched = _of_keys(known, batch, keys) if keys else known
                rows = batch.unionByName(touched.withColumn(arrival, start), allowMissingColumns=True)
                if batch_id % compact_every == 0:
                    changed = latest(known.unionByName(changed))
            found = out_of_order(rows, time, arrival, keys, out, rows_per_bucket)
            found.write.mode("overwrite").parquet(batch_folder(f"{root}/found", batch_id))
            changed.write.mode("overwrite").parquet(batch_folder(f"{root}/state", batch_id))
        finally:
            batch.unpersist()

    root = run_batches(df, "arrivals", "append", each, trigger, root)
    schema = StructType([*df.schema.fields, StructField(out, df.schema[time].dataType)])
    return read_batches(spark, f"{root}/found", schema).drop(BATCH)


def _of_keys(known: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state of the keys in a batch; a null key is a key."""
    here = batch.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return known.join(here, same, "left_semi")
