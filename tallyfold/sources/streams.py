"""Streaming readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

from tallyfold.sources.files import parse_json_records


def stream_text_dir(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Lines of the text files that appear in a directory."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def stream_table(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files that appear below ``path``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def stream_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a TCP peer. The socket source cannot replay: not for recovery."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def kafka_options(
    servers: str, topic: str, group_id: str | None = None, starting_offsets: str = "latest"
) -> dict[str, str]:
    """Options of the Kafka source."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if group_id:
        options["kafka.group.id"] = group_id
    return options


def kafka_reader(spark: SparkSession, **options: str) -> DataStreamReader:
    """Kafka reader; the session needs the spark-sql-kafka package."""
    return spark.readStream.format("kafka").options(**options)


def stream_kafka_raw(spark: SparkSession, servers: str, topic: str, **kwargs) -> DataFrame:
    """Message values as strings."""
    return raw_values(kafka_reader(spark, **kafka_options(servers, topic, **kwargs)).load())


def stream_kafka_json(
    spark: SparkSession, servers: str, topic: str, schema: StructType | str, **kwargs
) -> DataFrame:
    """JSON messages as typed columns, stamped with the time of processing."""
    return typed_messages(stream_kafka_raw(spark, servers, topic, **kwargs), schema)


def raw_values(messages: DataFrame) -> DataFrame:
    return messages.select(F.col("value").cast("string").alias("value"))


def typed_messages(
    values: DataFrame, schema: StructType | str, time_column: str = "ts"
) -> DataFrame:
    """Typed columns of JSON values plus an ingest timestamp."""
    return ingest_timestamp(parse_json_records(values, schema), time_column)


def ingest_timestamp(df: DataFrame, column: str = "ts") -> DataFrame:
    """Processing time as event time."""
    return df.withColumn(column, F.current_timestamp())
