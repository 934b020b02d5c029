"""Property-graph queries over node and edge frames.

Nodes are ``(id, labels array<string>, properties…)``; a relation is one frame of
``(src, dst, properties…)`` whose end labels are fixed. Joins are planned at run time:
adaptive execution broadcasts a side that turns out small, as a few matched nodes
do, and splits the skewed partitions of a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.values import ratio
from tallyfold.operators.rows import union_all
from tallyfold.session import materialize


def as_nodes(df: DataFrame, label: str, id_column: str = "id") -> DataFrame:
    """Rows of a table as nodes of one label."""
    rest = [c for c in df.columns if c != id_column]
    return df.select(F.col(id_column).alias("id"), F.array(F.lit(label)).alias("labels"), *rest)


def graph_any_nodes(*nodes: DataFrame, k: int = 10) -> DataFrame:
    """The first ``k`` nodes by label and id."""
    every = union_all(*[n.select("id", F.array_join("labels", ",").alias("labels")) for n in nodes])
    return every.orderBy("labels", "id").limit(k)


def graph_label_scan(nodes: DataFrame, label: str, prop: str, k: int = 10) -> DataFrame:
    """A property of the first ``k`` nodes with a label."""
    chosen = nodes.filter(F.array_contains("labels", label))
    return chosen.orderBy("id").limit(k).select("id", prop)


def _matched(nodes: DataFrame, prop: str, value, out: str) -> DataFrame:
    return nodes.filter(F.col(prop) == value).select(F.col("id").alias(out))


def _edges_of(edges: DataFrame, nodes: DataFrame, end: str, prop: str, value) -> DataFrame:
    """Edges whose ``end`` is a node with the property value."""
    return edges.join(_matched(nodes, prop, value, end), end)


def graph_in_neighbors(
    sources: DataFrame, edges: DataFrame, targets: DataFrame, prop: str, value, show: str
) -> DataFrame:
    """``show`` of the nodes with an edge to a matched node, in order."""
    hits = _edges_of(edges, targets, "dst", prop, value).select("src")
    found = hits.join(sources, hits["src"] == sources["id"])
    return found.select(show).orderBy(show)


def graph_out_neighbors(
    sources: DataFrame, edges: DataFrame, targets: DataFrame, prop: str, value, show: str
) -> DataFrame:
    """``show`` of the nodes that a matched node has an edge to."""
    hits = _edges_of(edges, sources, "src", prop, value).select("dst")
    return hits.join(targets, hits["dst"] == targets["id"]).select(show)


def graph_degree(sources: DataFrame, edges: DataFrame, prop: str, value) -> DataFrame:
    """Number of edges that leave the matched nodes."""
    return _edges_of(edges, sources, "src", prop, value).agg(F.count("*").alias("n"))


def graph_common_neighbors(
    sources: DataFrame, edges: DataFrame, targets: DataFrame, prop: str, one, other, show: str
) -> DataFrame:
    """``show`` of targets that two matched nodes share, one row per pair of edges.

    ``edges`` holds one edge per pair of nodes, so an edge pairs with itself only
    where both patterns match the same node.
    """
    left = _edges_of(edges, sources, "src", prop, one).select("dst", F.col("src").alias("a"))
    right = _edges_of(edges, sources, "src", prop, other).select("dst", F.col("src").alias("b"))
    shared = left.join(right, "dst").filter(F.col("a") != F.col("b"))
    return shared.join(targets, shared["dst"] == targets["id"]).select(show)


def graph_merge_nodes(nodes: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Insert the nodes of ``batch`` whose ``key`` is not present yet.

    The batch may name a key many times; its smallest id is then taken.
    """
    once = batch.groupBy(key).agg(F.min("id").alias("id"), F.min("labels").alias("labels"))
    fresh = once.join(nodes.select(key).distinct(), key, "left_anti")
    return nodes.unionByName(fresh, allowMissingColumns=True)


def graph_merge_edge(edges: DataFrame, batch: DataFrame) -> DataFrame:
    """Insert the (src, dst) pairs of ``batch`` that have no edge yet."""
    wanted = batch.select("src", "dst").distinct()
    fresh = wanted.join(edges.select("src", "dst").distinct(), ["src", "dst"], "left_anti")
    return edges.unionByName(fresh, allowMissingColumns=True)


def merge_by_key(
    sources: DataFrame, edges: DataFrame, targets: DataFrame, batch: DataFrame,
    source: tuple[str, str], target: tuple[str, str],
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Create node, node and edge where absent, for a batch of any size.

    ``source`` and ``target`` are (key property, label); each key identifies a
    node. ``batch`` holds both keys with ``source_id`` and ``target_id``, which
    serve for nodes that are new. Returns the new sources, edges and targets.
    """
    source_key, target_key = source[0], target[0]
    # The batch is computed once, as its distinct pairs of keys.
    batch = materialize(
        batch.groupBy(source_key, target_key).agg(
            F.min("source_id").alias("source_id"), F.min("target_id").alias("target_id")),
        "merge-pairs")

    def resolved(nodes: DataFrame, key: str, new_id: str) -> DataFrame:
        """The node of each key of the batch, and whether it is new."""
        once = batch.groupBy(key).agg(F.min(new_id).alias("new_id"))
        known = once.join(nodes.select(key, F.col("id").alias("known_id")), key, "left")
        return materialize(known.select(
            key, F.coalesce("known_id", "new_id").alias("id"), F.col("known_id").isNull().alias("is_new")
        ), "merge-nodes")

    def with_new(nodes: DataFrame, keys: DataFrame, key: str, label: str) -> DataFrame:
        fresh = keys.filter("is_new").select(key, "id", F.array(F.lit(label)).alias("labels"))
        return nodes.unionByName(fresh, allowMissingColumns=True)

    from_keys, to_keys = resolved(sources, source_key, "source_id"), resolved(targets, target_key, "target_id")
    pairs = (
        batch.select(source_key, target_key)
        .join(from_keys.select(source_key, F.col("id").alias("src")), source_key)
        .join(to_keys.select(target_key, F.col("id").alias("dst")), target_key)
    )
    return (
        with_new(sources, from_keys, *source), graph_merge_edge(edges, pairs), with_new(targets, to_keys, *target))


def graph_set_property(nodes: DataFrame, updates: DataFrame, key: str, prop: str) -> DataFrame:
    """Set ``prop`` on the nodes named in ``updates (key, prop)``, one row per key."""
    new = updates.select(F.col(key), F.col(prop).alias("_new"))
    old = F.col(prop) if prop in nodes.columns else F.lit(None)
    rest = [c for c in nodes.columns if c != prop]
    joined = nodes.join(new, key, "left")
    return joined.select(*rest, F.coalesce("_new", old).alias(prop))


def graph_avg_edge_property(edges: DataFrame, prop: str) -> DataFrame:
    """Mean of a property over the edges that have it."""
    present = edges.filter(F.col(prop).isNotNull())
    return present.agg(ratio(F.sum(prop), F.count("*")).alias("avg_value"))


def both_directions(edges: DataFrame) -> DataFrame:
    """Each edge as seen from either end; a loop is one edge and seen once."""
    there = F.struct("src", "dst")
    back = F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))
    loop = F.col("src") == F.col("dst")
    return edges.select(F.inline(F.when(loop, F.array(there)).otherwise(F.array(there, back))))


def graph_undirected_hop(
    people: DataFrame, contacts: DataFrame, roles: DataFrame, name: str,
    born_from: int, earnings_from,
) -> DataFrame:
    """Well-paid roles of the contacts of one person, best paid first.

    One row per contact edge and role edge.
    """
    ends = _matched(people, "name", name, "end")
    # Edges are turned round only once they are known to touch the person; a loop counts once.
    outward = contacts.join(ends, contacts["src"] == ends["end"], "left_semi").select("src", "dst")
    inward = contacts.filter("src != dst").join(ends, contacts["dst"] == ends["end"], "left_semi").select(
        F.col("dst").alias("src"), F.col("src").alias("dst"))
    near = outward.unionByName(inward).select(F.col("dst").alias("id"))
    near = near.join(people.filter(F.col("born") >= born_from).select("id", "name", "born"), "id")
    paid = roles.filter(F.col("earnings") >= earnings_from).select("src", "earnings")
    found = near.join(paid, near["id"] == paid["src"])
    return found.select("name", "born", "earnings").orderBy(F.desc("earnings"), "name")


def total_by_source(edges: DataFrame, prop: str) -> DataFrame:
    return edges.groupBy("src").agg(F.sum(prop).alias("total"))


def graph_having_label(
    nodes: DataFrame, edges: DataFrame, prop: str, floor, label: str
) -> DataFrame:
    """All nodes, with ``label`` added where the edges of a node sum to more than ``floor``.

    The sum is by node, not by name, and is shown as ``total`` where it qualifies.
    """
    rich = total_by_source(edges, prop).filter(F.col("total") > floor)
    marked = nodes.join(rich, nodes["id"] == rich["src"], "left")
    labels = F.when(
        F.col("total").isNotNull(), F.array_union("labels", F.array(F.lit(label)))
    ).otherwise(F.col("labels"))
    rest = [nodes[c] for c in nodes.columns if c != "labels"]
    return marked.select(*rest, labels.alias("labels"), "total")


def graph_upsert_counter(edges: DataFrame, events: DataFrame) -> DataFrame:
    """Add the number of events per (src, dst) to the edge counters, creating edges."""
    delta = events.groupBy("src", "dst").agg(F.count("*").alias("_delta"))
    joined = edges.select("src", "dst", "count").join(delta, ["src", "dst"], "full")
    return joined.select(
        "src", "dst",
        (F.coalesce("count", F.lit(0)) + F.coalesce("_delta", F.lit(0))).alias("count"),
    )


def lookup_pair(
    sources: DataFrame, targets: DataFrame, source: tuple[str, object], target: tuple[str, object]
) -> DataFrame:
    """(src, dst) of two looked-up nodes; no row unless both exist.

    The source property identifies one node: its id is a scalar subquery, which
    fails on a second match, so nothing is multiplied out.
    """
    src = _matched(sources, *source, "src").scalar()
    return _matched(targets, *target, "dst").select(src.alias("src"), "dst").filter("src IS NOT NULL")
