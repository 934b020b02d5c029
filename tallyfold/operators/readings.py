"""Station readings, spend, and plain grouped averages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.values import MONEY, tenths_to_celsius, tenths_to_fahrenheit
from tallyfold.operators.rows import filter_contains, parse_delimited_lines

READING = {"station": (0, "string"), "entry_type": (2, "string"), "tenths": (3, "double")}


def station_readings(lines: DataFrame, column: str = "value") -> DataFrame:
    """Station, entry type and reading in tenths of a degree."""
    return parse_delimited_lines(lines, READING, ",", column)


def max_by_station(lines: DataFrame, entry: str = "TMAX") -> DataFrame:
    """Largest reading per station in Celsius, to two decimals."""
    chosen = filter_contains(station_readings(lines), "entry_type", entry)
    hottest = tenths_to_celsius(F.max("tenths"))
    return chosen.groupBy("station").agg(F.round(hottest, 2).alias("max_c"))


def min_by_station(lines: DataFrame, entry: str = "TMIN") -> DataFrame:
    """Smallest reading per station in Fahrenheit, to two decimals."""
    chosen = filter_contains(station_readings(lines), "entry_type", entry)
    coldest = tenths_to_fahrenheit(F.min("tenths"))
    return chosen.groupBy("station").agg(F.round(coldest, 2).alias("min_f"))


def spend_by_customer(df: DataFrame, customer: str, price: str) -> DataFrame:
    """Total spend per customer, largest first; sums are exact decimals."""
    total = F.sum(F.col(price).cast(MONEY))
    return (
        df.groupBy(F.col(customer).alias("customer_id"))
        .agg(total.alias("total"))
        .orderBy(F.desc("total"), "customer_id")
        .select("customer_id", F.col("total").cast("double").alias("total_spent"))
    )


def avg_by_group_sql(df: DataFrame, group: str, value: str) -> DataFrame:
    """Average per group through SQL text, to two decimals, ordered by group.

    Values enter with ten decimals, so sums are exact and only the result is rounded to two.
    """
    return df.sparkSession.sql(
        f"""
        SELECT `{group}` AS group_key,
               CAST(ROUND(AVG(CAST(`{value}` AS DECIMAL(28, 10))), 2) AS DOUBLE) AS avg_value
        FROM {{rows}} GROUP BY `{group}` ORDER BY `{group}`
        """,
        rows=df,
    )


def conditional_counts(df: DataFrame, flag: Column, *keys: Column) -> DataFrame:
    """Rows and rows with a true flag; the latter is null when no flag is known."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum(flag.cast("int")).alias("n_matched")
    )
