"""Co-appearance lists: lines of ``id neighbour neighbour …``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.session import materialize


def token_array_ops(lines: DataFrame, column: str = "value") -> DataFrame:
    """First token and number of further ones; split at each single blank."""
    tokens = F.split(F.trim(column), " ")
    keep = [c for c in lines.columns if c != column]
    return lines.select(
        *keep, F.get(tokens, F.lit(0)).alias("id"),
        (F.size(tokens) - 1).cast("long").alias("connections"),
    )


def connections_by_id(lines: DataFrame, column: str = "value") -> DataFrame:
    """Neighbours per id, summed over all of its lines."""
    return token_array_ops(lines, column).groupBy("id").agg(
        F.sum("connections").alias("connections")
    )


def join_names(connections: DataFrame, names: DataFrame) -> DataFrame:
    """Names in place of ids; ids come as text and are cast to the names' type."""
    kind = names.schema["id"].dataType
    return connections.withColumn("id", F.col("id").try_cast(kind)).join(names, "id").select(
        "name", "connections"
    )


def argmax_lookup(connections: DataFrame, names: DataFrame) -> DataFrame:
    """Name and count of the best connected id, found in one job."""
    best = connections.orderBy(F.desc("connections"), "id").limit(1)
    return join_names(best, names)


def min_scalar_semijoin(
    connections: DataFrame, names: DataFrame, exactly: int | None = None
) -> DataFrame:
    """Names with the smallest positive count, or with a fixed one."""
    if exactly is None:
        connections = materialize(connections, "connections")  # read twice below
        wanted = connections.filter(F.col("connections") > 0).agg(F.min("connections")).scalar()
    else:
        wanted = F.lit(exactly)
    return join_names(connections.filter(F.col("connections") == wanted), names)
