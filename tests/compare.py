"""Row comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

from tallyfold.plans.fixtures import BASE


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in BASE:
        con.execute(f"create view {name} as select * from '{Path(sf_dir) / name}.parquet'")
    return con


def difference(spark_df, con, sql: str) -> str | None:
    """What differs, or None. Row order does not count; values must be equal exactly."""
    names = sorted(spark_df.columns)
    result = con.execute(sql)
    described = {d[0]: str(d[1]) for d in result.description}
    if names != sorted(described):
        return f"columns {names} != {sorted(described)}"
    found = Counter(map(repr, map(tuple, spark_df.select(*[f"`{n}`" for n in names]).collect())))
    at = [list(described).index(n) for n in names]
    wanted = Counter(repr(tuple(row[i] for i in at)) for row in result.fetchall())
    if found != wanted:
        extra, missing = list((found - wanted))[:3], list((wanted - found))[:3]
        return f"{found.total()} rows != {wanted.total()}: only Spark {extra}, only SQL {missing}"
    return None


SPARK_TO_SQL = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}


def type_difference(spark_df, con, sql: str) -> str | None:
    ours = {n: SPARK_TO_SQL.get(k, k) for n, k in spark_df.dtypes}
    theirs = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    wrong = {n: (ours[n], theirs.get(n)) for n in ours if ours[n] != theirs.get(n)}
    return f"types {wrong}" if wrong else None
