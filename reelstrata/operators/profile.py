"""One profile per key domain: how often every column that holds a key of the domain holds each of its values.

Uniqueness, missing keys, orphans and row totals all follow from it, so a relation is read once and a key
is shuffled once, however many checks ask about it. Counts combine on the map side: a key that holds a large
share of the rows arrives at its task as a few partial counts per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstrata.operators.checks import union_all

MEASURES = ("row_count", "null_rows", "distinct_keys", "repeated_keys", "child_rows", "orphan_rows")


@dataclass(frozen=True)
class Domain:
    """Columns that hold the same kind of key, as (relation, column); the first one is the parent of the others."""

    name: str
    columns: tuple[tuple[str, str], ...]


def other_columns(domains: Sequence[Domain], present: Mapping[str, Sequence[str]]) -> list[tuple[str, str]]:
    """Columns that must be present and hold no key of a domain."""
    keys = {pair for domain in domains for pair in domain.columns}
    return [(r, c) for r, columns in present.items() for c in columns if (r, c) not in keys]


def key_entries(
    tables: Mapping[str, DataFrame], domains: Sequence[Domain], others: Sequence[tuple[str, str]] = ()
) -> DataFrame:
    """`domain, slot, key`: an entry per row and key column, NULL keys included, from one pass over each relation.

    The other columns are a domain of their own after the last; they give an entry for each row that lacks them.
    """
    entries: dict[str, list[Column]] = {}

    def entry(domain: int, slot: int, key: Column) -> Column:
        return F.struct(F.lit(domain).alias("domain"), F.lit(slot).alias("slot"), key.cast("string").alias("key"))

    for number, domain in enumerate(domains):
        for slot, (relation, column) in enumerate(domain.columns):
            entries.setdefault(relation, []).append(entry(number, slot, F.col(column)))
    for slot, (relation, column) in enumerate(others):
        lacking = F.when(F.col(column).isNull(), entry(len(domains), slot, F.lit(None)))
        entries.setdefault(relation, []).append(lacking)
    return union_all(
        [
            tables[relation].select(F.inline(F.array(*listed))).where("domain IS NOT NULL")
            for relation, listed in entries.items()
        ]
    )


def key_counts(entries: DataFrame, width: int) -> DataFrame:
    """`domain, key, counts`: one row per key with its rows in each of `width` columns; the only shuffle of keys."""
    counted = entries.groupBy("domain", "key").agg(
        *[F.count_if(F.col("slot") == slot).alias(f"n{slot}") for slot in range(width)]
    )
    return counted.select("domain", "key", F.array(*[f"n{slot}" for slot in range(width)]).alias("counts"))


def measures(counts: DataFrame) -> DataFrame:
    """The measures of each (domain, slot) that has an entry.

    Children count as in a left join from the child to the parent: once per row of their parent, at least once.
    """
    cells = counts.select(
        "domain", "key", F.col("counts")[0].alias("parents"), F.posexplode("counts").alias("slot", "n")
    ).where("n > 0")
    known, n, zero = F.col("key").isNotNull(), F.col("n"), F.lit(0).cast("long")
    return cells.groupBy("domain", "slot").agg(
        F.sum(n).alias("row_count"),
        F.coalesce(F.sum(F.when(~known, n)), zero).alias("null_rows"),
        F.count_if(known).alias("distinct_keys"),
        F.count_if(known & (n > 1)).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(known, n * F.greatest("parents", F.lit(1)))), zero).alias("child_rows"),
        F.coalesce(F.sum(F.when(known & (F.col("parents") == 0), n)), zero).alias("orphan_rows"),
    )


def key_profile(
    tables: Mapping[str, DataFrame], domains: Sequence[Domain], present: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """`domain, parent_key, relation, column_name` and the measures: a row for each key column of each domain.

    Each further column that must be present has a row without a domain, of which `null_rows` alone is meant.
    """
    others = other_columns(domains, present or {})
    slots = [*(domain.columns for domain in domains), others]
    found = measures(key_counts(key_entries(tables, domains, others), max(map(len, slots))))
    names = [
        (number, slot, *((domain.name, domain.columns[0][1]) if domain else (None, None)), relation, column)
        for number, (domain, columns) in enumerate(zip([*domains, None], slots, strict=True))
        for slot, (relation, column) in enumerate(columns)
    ]
    listed = found.sparkSession.createDataFrame(
        names, "d int, s int, domain_name string, parent_key string, relation string, column_name string"
    )
    met = listed.join(found, (F.col("d") == F.col("domain")) & (F.col("s") == F.col("slot")), "left")
    zero = F.lit(0).cast("long")
    return met.select(
        F.col("domain_name").alias("domain"),
        "parent_key",
        "relation",
        "column_name",
        *[F.coalesce(m, zero).alias(m) for m in MEASURES],
    )


def repeated_grains(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """`relation, findings`: composite keys that occur more than once, NULL counting as a value, all relations in one shuffle."""
    width = max(map(len, keys.values()))
    parts = []
    for relation, columns in keys.items():
        padded = [F.col(c) for c in columns] + [F.lit(None)] * (width - len(columns))
        parts.append(
            tables[relation].select(
                F.lit(relation).alias("relation"), *[c.cast("string").alias(f"k{i}") for i, c in enumerate(padded)]
            )
        )
    by = ["relation", *[f"k{i}" for i in range(width)]]
    counted = union_all(parts).groupBy(*by).agg(F.count("*").alias("copies")).where("copies > 1")
    return counted.groupBy("relation").agg(F.count("*").alias("findings"))
