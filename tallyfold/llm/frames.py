"""Frames that pass through an operator with further columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def room_for(df: DataFrame, ddl: str) -> tuple[DataFrame, StructType]:
    """``df`` without columns of the names in ``ddl``, which an operator is to add, and the schema with them.

    So a column that has the name of a result is replaced by it.
    """
    added = StructType.fromDDL(ddl)
    names = {f.name.lower() for f in added.fields}
    kept = df.select(*[quoted(f.name) for f in df.schema.fields if f.name.lower() not in names])
    return kept, StructType([*kept.schema.fields, *added.fields])


def bounded_sample(df: DataFrame, size: int, *keys: str) -> DataFrame:
    """At most ``size`` rows, drawn by a hash of ``keys``; all rows if there are no more.

    Rows are first thinned where they lie, to about ``size``, so that hardly more than these are
    sorted, on whatever number of partitions the table has.
    """
    rows = df.count()
    if rows > size:
        share = int(size / rows * (1 << 30)) + 1
        df = df.filter(F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) < share)
    return df.orderBy(F.xxhash64(F.lit(1), *keys), *keys).limit(size)


def quoted(name: str) -> Column:
    """A column by its name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")
