"""Tables stored in buckets of their key, so that joins on it need no exchange.

A bucket is one file, sorted by the key. Tables of one key with the same number of buckets meet bucket by bucket, in every
session: the definition is made again from the path, since a session's catalog need not outlive it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from reelstrata.sources.tables import COMPRESSION


def _name(path: str) -> str:
    return f"bucketed_{hashlib.md5(path.encode()).hexdigest()}"


def write_bucketed(rows: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Replace the table at `path`. For keys that are unique or nearly so: the rows of a key are in one bucket."""
    spark, name = rows.sparkSession, _name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (
        rows.repartition(buckets, key)
        .write.format("parquet")
        .mode("overwrite")
        .option("path", path)
        .option("compression", COMPRESSION)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(name)
    )
    return spark.table(name)


def scan_bucketed(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """The bucketed table at `path`; `buckets` must be the number it was written with."""
    name, columns = _name(path), spark.read.parquet(path).schema
    listed = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in columns)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({listed}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
