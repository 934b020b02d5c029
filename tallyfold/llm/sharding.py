"""Sharding over fixed virtual slots.

Records are hashed into a fixed number of virtual slots. Rows and bytes are counted per slot, and
a slot-to-shard map with a version number says where a slot lives. Only the map changes when
shards are added or become uneven; a record never changes its slot.

All work on records is DataFrame work. A map has one row per slot, so its size is the number of
slots, a parameter, however many records there are.

Defined cases: a null text has no bytes and a null checksum; an empty text has no bytes and
checksum 0; a record with a null id is hashed by the text's checksum alone. Equal rows fall in
the same slot, so the slot of a record repeated very often is as heavy as its copies; hash more
columns to spread it. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 4096
#: Bytes that a record needs besides its text.
OVERHEAD = 8


def virtual_slot(*columns: Column | str, slots: int = SLOTS) -> Column:
    """The slot of a record: a hash of the columns given, from 0 to ``slots`` - 1."""
    return F.pmod(F.xxhash64(*columns), F.lit(slots)).cast("int")


def text_size(text: Column | str, overhead: int = OVERHEAD) -> Column:
    """UTF-8 bytes of a text (null: none) and the overhead of a record."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(overhead)


def slot_sizes(records: DataFrame, slot: str = "virtual_slot", size: str = "size") -> DataFrame:
    """Rows and bytes of each slot that has records. Sums are combined in each task first."""
    return records.groupBy(slot).agg(
        F.count("*").alias("n_rows"), F.sum(size).alias("n_bytes")
    )


def balanced_map(sizes: DataFrame, shards: int, version: int = 1) -> DataFrame:
    """A first map: slots by falling size, each to the shard with the fewest bytes so far.

    Returns virtual_slot, n_rows, n_bytes, shard, map_version. One array of all slots is folded;
    it has as many elements as there are slots.
    """
    ordered = sizes.agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("n_bytes")).alias("down"), "virtual_slot", "n_rows", "n_bytes"))).alias("slots"))

    def place(state: Column, slot: Column) -> Column:
        least = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int") - 1
        loads = F.transform(
            state["loads"], lambda load, i: F.when(i == least, load + slot["n_bytes"]).otherwise(load)
        )
        return F.struct(
            loads.alias("loads"), F.concat(state["placed"], F.array(least)).alias("placed")
        )

    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"),
        F.array().cast("array<int>").alias("placed"),
    )
    placed = ordered.select("slots", F.aggregate("slots", start, place)["placed"].alias("placed"))
    return placed.select(F.explode(F.arrays_zip("slots", "placed")).alias("one")).select(
        F.col("one.slots.virtual_slot").alias("virtual_slot"),
        F.col("one.slots.n_rows").alias("n_rows"),
        F.col("one.slots.n_bytes").alias("n_bytes"),
        F.col("one.placed").alias("shard"),
        F.lit(version).alias("map_version"),
    )


def rebalanced_map(old: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The next version of a map for ``shards`` shards, with the sizes of today.

    Slots leave a shard only for what it holds beyond its share of the bytes (all of them if the
    shard is gone), largest first; those that stay keep their place. Slots that leave, and
    slots which the old map does not know, fill the room below the share, shard by shard. So at
    growth rows move only into new shards, up to one slot at each shard's edge.
    """
    known = sizes.join(F.broadcast(old.select("virtual_slot", "shard", "map_version")),
                       "virtual_slot", "left")
    version = old.agg(F.max("map_version") + 1).scalar()
    share = sizes.agg(F.sum("n_bytes") / F.lit(shards)).scalar()
    # The smallest slots stay first, so that few slots move.
    within = Window.partitionBy("shard").orderBy("n_bytes", "virtual_slot")
    held = known.withColumn("held", F.sum("n_bytes").over(within))
    stays = F.col("shard").isNotNull() & (F.col("shard") < shards) & (F.col("held") <= share)
    split = held.withColumn("stays", F.coalesce(stays, F.lit(False)))
    kept = split.filter("stays").select("virtual_slot", "n_rows", "n_bytes", "shard")
    room = (
        sizes.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
        .join(F.broadcast(kept.groupBy("shard").agg(F.sum("n_bytes").alias("used"))), "shard", "left")
        .withColumn("room", F.greatest(share - F.coalesce("used", F.lit(0)), F.lit(0.0)))
    )
    # Both lists are at most as long as the map: running sums over them give each slot its shard.
    to = Window.orderBy("shard")
    filled = room.select("shard", F.sum("room").over(to).alias("upto")).orderBy("shard").collect()
    edges = F.array(*[
        F.struct(F.lit(float(e["upto"])).alias("upto"), F.lit(e["shard"]).alias("shard"))
        for e in filled
    ])
    order = Window.orderBy(F.desc("n_bytes"), "virtual_slot")
    moving = (
        split.filter(~F.col("stays"))
        .withColumn("at", F.sum("n_bytes").over(order) - F.col("n_bytes") / 2)
        .select("virtual_slot", "n_rows", "n_bytes", F.coalesce(
            F.filter(edges, lambda e: e["upto"] >= F.col("at"))[0]["shard"],
            F.lit(shards - 1)).alias("shard"))
    )
    return kept.union(moving).withColumn("map_version", F.lit(version).cast("int"))


def placed_records(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Records with their shard, the map's version, and ``slot``, their place in the shard.

    Places run from 0 without a gap: first by virtual slot, then by doc_id within it. Rows are
    ordered only within a virtual slot; the places before a slot come from the counts in the
    map. The map is broadcast: it has a row per slot.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot")
    starts = slot_map.select("virtual_slot", "shard", "map_version", (
        F.sum("n_rows").over(before) - F.col("n_rows")).alias("start"))
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        records.withColumn("inside", F.row_number().over(inside))
        .join(F.broadcast(starts), "virtual_slot")
        .withColumn("slot", (F.col("start") + F.col("inside") - 1).cast("long"))
        .drop("start", "inside")
    )


def record_facts(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot; the texts themselves go no further."""
    return docs.select(
        "doc_id", text_size("text").alias("size"), F.crc32("text").alias("text_crc32"),
    ).withColumn("virtual_slot", virtual_slot("doc_id", "text_crc32", slots=slots))


def read_map(spark: SparkSession, path: str) -> DataFrame:
    """The map with the highest version below ``path``, where each version is a folder."""
    maps = spark.read.option("mergeSchema", False).parquet(path)
    latest = maps.agg(F.max("map_version")).scalar()
    return maps.filter(F.col("map_version") == latest)
