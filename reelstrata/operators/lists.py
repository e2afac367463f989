"""Roll values of a key up into one ordered array.

Rows are reduced to distinct (key, value) pairs before they meet under their key: the first
shuffle spreads a hot key over all tasks and combines its repeats on the map side, so the task that
builds an array receives one row per element of that array's distinct values, never the raw rows.
Values order by bytes and NULL, if any, comes last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordered_list(rows: DataFrame, key: str, value: str, into: str) -> DataFrame:
    """Every value of a key, repeats kept, ascending."""
    counted = rows.groupBy(key, value).agg(F.count("*").cast("int").alias("n"))
    run = F.struct(F.col(value).isNull().alias("last"), F.col(value).alias("v"), "n")
    runs = counted.groupBy(key).agg(F.array_sort(F.collect_list(run)).alias("runs"))
    repeated = F.transform("runs", lambda r: F.array_repeat(r["v"], r["n"]))
    return runs.select(key, F.flatten(repeated).alias(into))


def distinct_list(rows: DataFrame, key: str, value: str, into: str) -> DataFrame:
    """The distinct values of a key, ascending."""
    pairs = rows.select(key, value).distinct()
    item = F.struct(F.col(value).isNull().alias("last"), F.col(value).alias("v"))
    items = pairs.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("items"))
    return items.select(key, F.col("items.v").alias(into))
