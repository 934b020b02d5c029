"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution is on by default in Spark 4; it is named here because the
# joins in this package rely on its runtime broadcast and skew handling.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Batches for Python by size as well: pages and texts differ a thousandfold.
    "spark.sql.execution.arrow.maxBytesPerBatch": "33554432",
}


def build_session(app_name: str = "tallyfold", **conf: str) -> SparkSession:
    """Session with the settings above; the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**ENGINE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the folder named by ``spark.checkpoint.dir``.

    Every executor must see the folder. Where none is named, it is a folder beside the
    session's tables, in the warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


# Paths written by ``materialize``, newest last; one list for each open ``scratch`` block.
_written: list[list[str]] = [[]]


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    Used where several results are taken from one expensive pass: the table
    survives lost executors, and its readers prune columns. It goes at the end of the
    ``scratch`` block around it, else when the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    until_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def until_end(spark: SparkSession, path: str) -> None:
    """Has a written folder deleted when ``materialize`` deletes its own."""
    _written[-1].append(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(target)


def release(spark: SparkSession, path: str) -> None:
    """Delete a folder written for a result that is no longer needed."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what ``materialize`` wrote inside; use the results before."""
    _written.append([])
    try:
        yield
    finally:
        for path in _written.pop():
            release(spark, path)
