"""Substring search by trigrams: which rows can match an ILIKE pattern, from an index of three-character pieces.

The index holds each piece of the lower-cased text with the keys that have it, sorted by piece within its files. A pattern's literal
runs give the pieces that a match must have; rows that have all of them are candidates, and the pattern itself decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstrata.sources.tables import write_table

SIZE = 3
PIECE = "piece"


def pieces(text: Column) -> Column:
    """The distinct pieces of a lower-cased text; none if it is shorter than one."""

    def cut(low: Column) -> Column:
        places = F.when(F.length(low) >= SIZE, F.sequence(F.lit(1), F.length(low) - (SIZE - 1))).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(places, lambda place: F.substring(low, place, F.lit(SIZE)))

    # the text is lower-cased once, as the variable of the outer transform
    return F.array_distinct(F.transform(F.array(F.lower(text)), cut)[0])


def write_index(rows: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """Store `piece, key` of the rows; a row without text has no piece. No shuffle, so a frequent piece stays spread."""
    found = rows.where(F.col(text).isNotNull()).select(F.explode(pieces(F.col(text))).alias(PIECE), key)
    return write_table(found, path, lookup=PIECE, sort=(key,))


def literal_runs(pattern: str) -> list[str]:
    """What stands between the wildcards of a LIKE pattern, with escapes resolved."""
    runs, characters = [""], iter(pattern)
    for character in characters:
        if character in "%_":
            runs.append("")
        else:
            runs[-1] += next(characters, "") if character == "\\" else character
    return [run for run in runs if run]


def needed(spark: SparkSession, pattern: str) -> list[str]:
    """The pieces that every match of an ILIKE pattern has."""
    low = spark.sql("SELECT lower(:pattern) AS low", args={"pattern": pattern}).first()["low"]
    return sorted({run[i : i + SIZE] for run in literal_runs(low) for i in range(len(run) - SIZE + 1)})


def candidates(index: DataFrame, key: str, wanted: list[str]) -> DataFrame:
    """The keys that have all wanted pieces, and perhaps a few more where a key has several rows."""
    hits = index.where(F.col(PIECE).isin(wanted)).groupBy(key).agg(F.count("*").alias("hits"))
    return hits.where(F.col("hits") >= len(wanted)).select(key)
