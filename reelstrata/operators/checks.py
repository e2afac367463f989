"""Data checks as Spark jobs. Each returns only the violations, one row per finding.

The common row shape is `check, relation, key, detail`, all text. Group checks count before they
shuffle, so a key that holds a large share of the rows arrives at its task as a few partial counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: share of child rows that may lack a parent.
MAX_ORPHAN_RATIO = Decimal("0.0001")

FINDING = "check string, relation string, key string, detail string"


def violation(check: str, relation: Column, key: Column, detail: Column) -> list[Column]:
    """The four columns of a finding."""
    return [
        F.lit(check).alias("check"),
        relation.cast("string").alias("relation"),
        key.cast("string").alias("key"),
        detail.cast("string").alias("detail"),
    ]


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames pair by pair, so that long lists do not re-analyse one growing plan."""
    while len(frames) > 1:
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        frames = [pair[0].unionByName(pair[1]) if len(pair) == 2 else pair[0] for pair in pairs]
    return frames[0]


def _as_text(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def null_counts(rows: DataFrame, relation: str, columns: Sequence[str]) -> DataFrame:
    """`relation, column_name, null_rows` for each column, all from one pass over the table."""
    counted = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "null_rows").select(
        F.lit(relation).alias("relation"), "column_name", "null_rows"
    )


def not_null(rows: DataFrame, relation: str, columns: Sequence[str]) -> DataFrame:
    found = null_counts(rows, relation, columns).where("null_rows > 0")
    detail = F.concat(F.col("null_rows").cast("string"), F.lit(" null rows"))
    return found.select(
        *violation("not_null", F.col("relation"), F.col("column_name"), detail)
    )


def repeated(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once with their number of rows; NULL counts as a key value."""
    return rows.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def duplicate_keys(
    rows: DataFrame,
    relation: str,
    keys: Sequence[str],
    *,
    check: str = "grain",
    label: Column | None = None,
) -> DataFrame:
    """Repeated composite keys, NULL keys included."""
    return repeated(rows, keys).select(
        *violation(
            check,
            F.lit(relation),
            _as_text(keys) if label is None else label,
            F.concat(F.col("copies").cast("string"), F.lit(" rows")),
        )
    )


def unique(rows: DataFrame, relation: str, column: str) -> DataFrame:
    """Repeated values of one column; NULLs are left to the not-null check."""
    present = rows.where(F.col(column).isNotNull())
    return duplicate_keys(present, relation, [column], check="unique")


def orphan_metrics(
    children: Mapping[str, tuple[DataFrame, str]],
    parent: DataFrame,
    field: str,
    max_ratio: Decimal = MAX_ORPHAN_RATIO,
) -> DataFrame:
    """`link, child_rows, orphan_rows, orphan_ratio, maximum_orphan_ratio` per child column.

    The counts are those of child left join parent. All children are counted per key first and
    the parent once, so both sides meet with one row per key however skewed the links are.
    """
    names = list(children)
    keys = union_all(
        [
            rows.select(F.lit(i).alias("link"), F.col(column).alias("child_key"))
            for i, (rows, column) in enumerate(children.values())
        ]
    ).where(F.col("child_key").isNotNull())
    per_key = keys.groupBy("child_key").agg(
        *[F.count_if(F.col("link") == i).alias(f"n{i}") for i in range(len(names))]
    )
    parents = (
        parent.where(F.col(field).isNotNull())
        .groupBy(F.col(field).alias("child_key"))
        .agg(F.count("*").alias("copies"))
    )
    joined = per_key.join(parents, "child_key", "left")
    zero = F.lit(0).cast("long")
    totals = joined.agg(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("link"),
                    F.coalesce(F.sum(F.col(f"n{i}") * F.coalesce("copies", F.lit(1))), zero).alias(
                        "child_rows"
                    ),
                    F.coalesce(
                        F.sum(F.when(F.col("copies").isNull(), F.col(f"n{i}"))), zero
                    ).alias("orphan_rows"),
                )
                for i, name in enumerate(names)
            ]
        ).alias("links")
    )
    return totals.select(F.inline("links")).select(
        "link",
        "child_rows",
        "orphan_rows",
        (F.col("orphan_rows").cast("double") / F.nullif("child_rows", F.lit(0))).alias(
            "orphan_ratio"
        ),
        F.lit(float(max_ratio)).alias("maximum_orphan_ratio"),
    )


def above_limit(max_ratio: Decimal = MAX_ORPHAN_RATIO) -> Column:
    """Whether a link is above the limit, compared in exact decimals: at the limit still passes."""
    return F.col("orphan_rows") > F.col("child_rows") * F.lit(max_ratio)


def too_many_orphans(metrics: DataFrame, max_ratio: Decimal = MAX_ORPHAN_RATIO) -> DataFrame:
    return metrics.where(above_limit(max_ratio))


def orphan_ratio(
    children: Mapping[str, tuple[DataFrame, str]],
    parent: DataFrame,
    field: str,
    max_ratio: Decimal = MAX_ORPHAN_RATIO,
) -> DataFrame:
    found = too_many_orphans(orphan_metrics(children, parent, field, max_ratio), max_ratio)
    detail = F.concat_ws(" of ", F.col("orphan_rows"), F.col("child_rows"))
    return found.select(
        *violation("orphan_ratio", F.col("link"), F.lit(field), detail)
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """`relation_name, row_count` for each table."""
    return union_all(
        [
            rows.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("relation_name"), "row_count"
            )
            for name, rows in tables.items()
        ]
    )


def paired_counts(
    pairs: Mapping[str, tuple[DataFrame, DataFrame]], left: str, right: str
) -> DataFrame:
    """`relation_name, <left>_count, <right>_count` for each pair of tables."""
    sides = [
        row_counts({name: rows}).withColumn("side", F.lit(side))
        for name, pair in pairs.items()
        for side, rows in zip((left, right), pair, strict=True)
    ]
    picked = [
        F.sum(F.when(F.col("side") == side, F.col("row_count"))).alias(f"{side}_count")
        for side in (left, right)
    ]
    return union_all(sides).groupBy("relation_name").agg(*picked)


def count_mismatch(
    pairs: Mapping[str, tuple[DataFrame, DataFrame]], left: str, right: str
) -> DataFrame:
    found = paired_counts(pairs, left, right).where(f"{left}_count != {right}_count")
    detail = F.concat_ws(" != ", f"{left}_count", f"{right}_count")
    check = f"rows_{left}_{right}"
    return found.select(
        *violation(check, F.col("relation_name"), F.lit("row_count"), detail)
    )


def out_of_range(
    rows: DataFrame, relation: str, key: str, label: str, outside: Column
) -> DataFrame:
    """Rows for which `outside` holds; a NULL value is never outside."""
    return rows.where(outside).select(
        *violation("value_range", F.lit(relation), F.col(key), F.lit(label))
    )


def outside(column: str, low: float, high: float) -> Column:
    return ~F.col(column).between(low, high)


def not_accepted(
    rows: DataFrame, relation: str, key: str, column: str, accepted: Sequence[str]
) -> DataFrame:
    """Rows whose value is none of the accepted ones; NULL is never selected."""
    return rows.where(~F.col(column).isin(*accepted)).select(
        *violation("accepted_values", F.lit(relation), F.col(key), F.col(column))
    )


def schema_violations(
    spark: SparkSession, relation: str, actual: T.StructType, contract: T.StructType
) -> DataFrame:
    """Differences from a contract in names, order or types; an empty result means equal."""
    have = [(f.name, f.dataType.simpleString()) for f in actual]
    want = [(f.name, f.dataType.simpleString()) for f in contract]
    missing = [("", "")]
    width = max(len(have), len(want))
    pairs = zip(
        have + missing * (width - len(have)), want + missing * (width - len(want)), strict=True
    )
    found = [
        ("contract", relation, w[0] or h[0], f"expected {' '.join(w)}, found {' '.join(h)}")
        for h, w in pairs
        if h != w
    ]
    return spark.createDataFrame(found, FINDING)


def without_lineage(
    rows: DataFrame, relation: str, files: DataFrame, table_name: str, load_id: str
) -> DataFrame:
    """Loads present in a raw table without a file row for (load, table).

    A table holds very few loads, so its rows are counted per load before the anti join.
    """
    loads = rows.groupBy(load_id).agg(F.count("*").alias("n")).withColumn(
        "table_name", F.lit(table_name)
    )
    lost = loads.join(files.select(load_id, "table_name"), [load_id, "table_name"], "left_anti")
    return lost.select(
        *violation(
            "lineage",
            F.lit(relation),
            F.coalesce(load_id, F.lit("no load id")),
            F.concat(F.col("n").cast("string"), F.lit(" rows")),
        )
    )


def tally(
    rows: DataFrame,
    relation: str,
    measures: Sequence[tuple[str, Column | None, Column]],
    by: Sequence[str] = (),
) -> DataFrame:
    """`check, relation, item, value`: any number of counts of a table from one pass over it.

    A measure is a check, what it counts (a column of `by` or a literal) and the count itself.
    """
    counted = rows.groupBy(*by).agg(*[value.alias(f"m{i}") for i, (*_, value) in enumerate(measures)])
    entries = [
        F.struct(
            F.lit(check).alias("check"),
            (F.lit(None) if item is None else item).cast("string").alias("item"),
            F.col(f"m{i}").cast("long").alias("value"),
        )
        for i, (check, item, _) in enumerate(measures)
    ]
    return counted.select(F.lit(relation).alias("relation"), F.inline(F.array(*entries)))


def key_tally(rows: DataFrame, relation: str, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Numbers of repeated keys as `tally` rows, from one grouping: `grain` counts NULL keys, `unique` does not."""
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    counts = {"grain": F.count("*"), "unique": F.count_if(known)}
    return tally(repeated(rows, keys), relation, [(name, None, counts[name]) for name in names])


def fired(tallies: DataFrame) -> DataFrame:
    """`check, relation, findings` of the checks that fired, from `tally` rows.

    Checks of rows or keys have as many findings as their values add up to. All others have one for each item
    whose values do not cancel out, unless a NULL value excuses the item.
    """
    items = tallies.groupBy("check", "relation", "item").agg(
        F.coalesce(F.sum("value"), F.lit(0)).alias("value"),
        (F.count_if(F.col("value").isNull()) > 0).alias("excused"),
    )
    each = F.col("check").isin("value_range", "accepted_values", "grain", "unique")
    one = ((F.col("value") != 0) & ~F.col("excused")).cast("long")
    found = items.groupBy("check", "relation").agg(
        F.sum(F.when(each, F.col("value")).otherwise(one)).alias("findings")
    )
    return found.where("findings > 0")


def missing_relations(required: DataFrame, found: DataFrame, on: Sequence[str]) -> DataFrame:
    """Required names that were not found."""
    return required.join(found, list(on), "left_anti")
