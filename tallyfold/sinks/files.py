"""Batch sinks. Results stay in as many files as the frame has partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyfold.operators.ordered import capped_rows
from tallyfold.operators.tables import incremental_append


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = False) -> None:
    df.write.option("sep", sep).option("header", header).csv(path)


def write_text_rolled(df: DataFrame, path: str, column: str, max_records: int) -> None:
    """Text files of at most ``max_records`` lines each."""
    df.select(column).write.option("maxRecordsPerFile", max_records).text(path)


def convert_jsonl(
    spark: SparkSession, source: str, target: str, schema: StructType | str, fmt: str = "json"
) -> None:
    """JSON lines to another layout, partition by partition."""
    spark.read.schema(schema).json(source).write.format(fmt).save(target)


def append_jsonl_capped(
    batch: DataFrame, path: str, schema: StructType | str, key: str, order: str, cap_bytes: int
) -> None:
    """Append the unseen records of ``batch`` until the store holds ``cap_bytes``.

    The store takes records in ``order``; ``order`` itself is not stored. A store that does
    not exist yet is made.
    """
    spark = batch.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if files.exists(folder):
        stored, used = spark.read.schema(schema).json(path), stored_bytes(spark, path)
    else:
        stored, used = spark.createDataFrame([], schema), 0
    fresh = incremental_append(stored.select(key), batch, key, order)
    capped_rows(fresh, order, max(cap_bytes - used, 0)).drop(order).write.mode("append").json(path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below ``path``, from the file listing alone."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .selectExpr("coalesce(sum(length), 0) as bytes")
    )
    return listing.first()["bytes"]


def register_view(name: str, df: DataFrame) -> None:
    df.createOrReplaceTempView(name)
