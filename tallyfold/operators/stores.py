"""Keyed tables that take batches in place: bucketed by their keys and only ever appended to.

A stored table is written once in buckets of its keys. A batch is dealt into the same buckets, so a join, an
anti-join or a group-by with the table moves the batch alone, however large the table is. Changes are further
rows of the same buckets: new edges and nodes, increments of counters, later values of a property. Reading
adds them up inside each bucket, without a shuffle; ``compacted`` writes the table anew when its buckets hold many
small files.

Every append is one Spark write with its commit protocol. A batch with a number is applied once: given again, as
after a failed stream, it changes nothing. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyfold.session import scratch_path, until_end

#: Rows of a bucket, about, when a table is first written.
BUCKET_ROWS = 1_000_000
#: Column that numbers the batches, where a table keeps one.
BATCH = "_batch"


@dataclass(frozen=True)
class Store:
    """A bucketed table: its name in the catalog, its folder, keys and number of buckets."""

    spark: SparkSession
    name: str
    path: str
    keys: tuple[str, ...]
    buckets: int

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def dealt(self, batch: DataFrame) -> DataFrame:
        """A batch in the buckets of the table; the only shuffle of an upsert."""
        return batch.repartition(self.buckets, *self.keys)

    def append(self, batch: DataFrame) -> None:
        """Adds rows. Columns that the batch lacks are null."""
        schema = self.rows().schema
        full = [F.col(f.name) if f.name in batch.columns else F.lit(None).alias(f.name) for f in schema.fields]
        typed = batch.select(*full).to(StructType(schema.fields))
        _write(self.dealt(typed), self, "append")

    def known(self, batch: DataFrame) -> DataFrame:
        """Rows of the table whose keys are in the batch; the table is read where it lies, the batch is hashed."""
        keys = self.dealt(batch.select(*self.keys)).distinct()
        return self.rows().join(keys.hint("shuffle_hash"), list(self.keys), "left_semi")

    def compacted(self, read: DataFrame, path: str | None = None) -> Store:
        """A new table of the rows ``read`` from this one, each bucket in one file. The old one stays."""
        return create(read, self.keys, self.buckets, path)

    def drop(self) -> None:
        """Forgets the table; its files stay."""
        self.spark.sql(f"drop table if exists `{self.name}`")


def _write(df: DataFrame, store: Store, mode: str) -> None:
    first, *rest = store.keys
    writer = df.write.format("parquet").mode(mode).option("path", store.path)
    writer.bucketBy(store.buckets, first, *rest).sortBy(first, *rest).saveAsTable(store.name)


def bucket_count(spark: SparkSession, rows: int) -> int:
    """Buckets of a table of that many rows, so that what a task holds of one does not grow with the table."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // BUCKET_ROWS))


def create(df: DataFrame, keys: Sequence[str], buckets: int | None = None, path: str | None = None) -> Store:
    """Writes ``df`` as a bucketed table, below ``path`` or in the scratch folder until the application ends.

    Without ``buckets`` the rows are counted: one for each BUCKET_ROWS.
    """
    spark = df.sparkSession
    count = buckets or bucket_count(spark, df.count())
    store = Store(spark, f"store_{uuid.uuid4().hex}", path or scratch_path(spark, "store"), tuple(keys), count)
    _write(store.dealt(df), store, "error")
    if path is None:
        until_end(spark, store.path)
    return store


def opened(spark: SparkSession, path: str, keys: Sequence[str], buckets: int) -> Store:
    """A table that an earlier session has written, under a new name."""
    store = Store(spark, f"store_{uuid.uuid4().hex}", path, tuple(keys), buckets)
    listed = ", ".join(f"`{k}`" for k in keys)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    spark.sql(f"create table `{store.name}` ({columns}) using parquet clustered by ({listed}) sorted by ({listed}) "
              f"into {buckets} buckets location '{path}'")
    return store


def merge_edges(edges: Store, batch: DataFrame) -> None:
    """Appends the (src, dst) pairs of ``batch`` that have no edge yet."""
    # Dealt first: a task holds the distinct pairs of one bucket.
    wanted = edges.dealt(batch.select("src", "dst")).distinct()
    edges.append(wanted.join(edges.known(wanted).select("src", "dst").distinct(), ["src", "dst"], "left_anti"))


def merge_nodes(nodes: Store, batch: DataFrame, label: str) -> DataFrame:
    """Appends the keys of ``batch (key, new_id)`` that no node has; returns key and id of all of them.

    The key identifies a node; of several new ids of a key the least counts.
    """
    (key,) = nodes.keys
    once = batch.groupBy(key).agg(F.min("new_id").alias("new_id"))
    known = nodes.known(once).select(key, F.col("id").alias("known_id"))
    found = once.join(known, key, "left").select(
        key, F.coalesce("known_id", "new_id").alias("id"), F.col("known_id").isNull().alias("is_new"))
    fresh = found.filter("is_new").select(key, "id", F.array(F.lit(label)).alias("labels"))
    nodes.append(fresh)
    return nodes.known(once).select(key, "id")


def merge_by_key(
    sources: Store, edges: Store, targets: Store, batch: DataFrame, source_label: str, target_label: str
) -> None:
    """Creates node, node and edge where absent, in place.

    ``batch`` holds the key of both node tables with ``source_id`` and ``target_id``, which serve for nodes that are
    new. Nodes are appended before the edges, so a batch that broke off is completed by giving it again.
    """
    (from_key,), (to_key,) = sources.keys, targets.keys
    from_ids = merge_nodes(sources, batch.select(from_key, F.col("source_id").alias("new_id")), source_label)
    to_ids = merge_nodes(targets, batch.select(to_key, F.col("target_id").alias("new_id")), target_label)
    pairs = batch.select(from_key, to_key).distinct()
    pairs = pairs.join(from_ids.withColumnRenamed("id", "src"), from_key)
    merge_edges(edges, pairs.join(to_ids.withColumnRenamed("id", "dst"), to_key))


def _applied(store: Store, batch: int | None) -> bool:
    return batch is not None and not store.rows().filter(F.col(BATCH) == batch).isEmpty()


def create_counters(counts: DataFrame, keys: Sequence[str], buckets: int | None = None, path: str | None = None) -> Store:
    """A table of counters: the keys and ``count``."""
    return create(counts.select(*keys, F.col("count").cast("long"), F.lit(None).cast("long").alias(BATCH)),
                  keys, buckets, path)


def add_counts(store: Store, events: DataFrame, batch: int | None = None) -> None:
    """Adds the number of events per key; a numbered batch is added once."""
    if not _applied(store, batch):
        added = store.dealt(events.select(*store.keys)).groupBy(*store.keys).agg(F.count("*").alias("count"))
        store.append(added.withColumn(BATCH, F.lit(batch).cast("long")))


def counts(store: Store) -> DataFrame:
    """The counters: increments of a key are added up in its bucket."""
    return store.rows().groupBy(*store.keys).agg(F.sum("count").alias("count"))


def create_property_log(nodes: Store, value: str) -> Store:
    """An empty log of later values of a property, in the buckets of the nodes. ``value``: its type."""
    fields = ", ".join(f"`{k}` {nodes.rows().schema[k].dataType.simpleString()}" for k in nodes.keys)
    empty = nodes.spark.createDataFrame([], f"{fields}, value {value}, {BATCH} long")
    return create(empty, nodes.keys, nodes.buckets)


def set_property(log: Store, updates: DataFrame, batch: int) -> None:
    """Later values (keys, value), one row a key; batches count up, and one given again is left out."""
    if not _applied(log, batch):
        log.append(updates.select(*log.keys, "value", F.lit(batch).cast("long").alias(BATCH)))


def with_property(nodes: Store, log: Store, prop: str) -> DataFrame:
    """The nodes with the newest value of the property; a null sets nothing. Both lie in the same buckets: no shuffle."""
    newest = log.rows().filter("value is not null").groupBy(*log.keys).agg(F.max_by("value", BATCH).alias("_new"))
    rows = nodes.rows()
    old = F.col(prop) if prop in rows.columns else F.lit(None)
    rest = [c for c in rows.columns if c != prop]
    return rows.join(newest, list(nodes.keys), "left").select(*rest, F.coalesce("_new", old).alias(prop))
