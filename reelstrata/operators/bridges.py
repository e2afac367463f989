"""Array columns to one row per element, and display names for keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exploded(rows: DataFrame, array: str, element: str) -> DataFrame:
    """One row per array element; rows without elements vanish."""
    kept = [c for c in rows.columns if c != array]
    present = rows.where(F.col(array).isNotNull())
    return present.select(*kept, F.explode(array).alias(element))


def tagged_union(
    rows: DataFrame, tag: str, arrays: dict[str, str], element: str, keep: list[str]
) -> DataFrame:
    """Explode several array columns, each under its tag, and stack the results."""
    parts = [
        exploded(rows.select(*keep, array), array, element).withColumn(tag, F.lit(name))
        for name, array in arrays.items()
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked


def named(rows: DataFrame, lookup: DataFrame, key: str, name: str, into: str) -> DataFrame:
    """Left join the display name of a key, the key itself standing in for a missing name."""
    names = lookup.select(key, F.col(name).alias(into))
    return rows.join(names, key, "left").withColumn(into, F.coalesce(into, key))
