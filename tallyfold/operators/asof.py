"""Earlier-time lookup without a range join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.ordered import ROWS_PER_BUCKET, running_max
from tallyfold.operators.skew import salted_lookup
from tallyfold.session import materialize


def previous_time_lookup(
    df: DataFrame, time: str, spread: str, out: str = "previous_time",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Each row with the largest time in the table that is smaller than its own.

    Works on the distinct times, each with its number of rows, and joins the
    answer back; times shared by very many rows are salted by ``spread``.
    """
    times = materialize(
        df.filter(F.col(time).isNotNull()).groupBy(time).agg(F.count("*").alias("_n")), "times"
    )
    earlier = materialize(
        running_max(times, time, time, out=out, rows_per_bucket=rows_per_bucket), "earlier-times")
    return salted_lookup(df, earlier, time, spread, "_n", "left")
