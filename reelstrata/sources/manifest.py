"""Manifest of acquired files: scan, checks, upsert, backfill, lineage, completeness.

Every function takes and returns DataFrames. Checks return one row per problem with the columns
`check, relation, key, detail`.
"""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstrata.operators.checks import duplicate_keys, violation
from reelstrata.sources.registry import FILE_COLUMNS, FILE_SCHEMA, LOAD_ID

# Fixed value: the manifest layout these functions understand.
MANIFEST_VERSION = 1

#: Bytes of entries in one document: a document is read as one value.
DOCUMENT_BYTES = 2 * 1024**2

REQUIRED_TEXT = [n for n, (kind, null) in FILE_COLUMNS.items() if kind == "string" and not null]
REGISTERED = ("dataset", "file_name", "url")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Manifest documents as one VARIANT column; no rows when nothing was written yet."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], "doc variant")
        raise
    return text.select(F.parse_json("value").alias("doc"))


def _raw_entries(documents: DataFrame) -> DataFrame:
    listed = F.try_variant_get("doc", "$.entries", "array<variant>")
    return documents.select(F.explode(listed).alias("entry"))


def _field_kind(name: str) -> Column:
    return F.schema_of_variant(F.try_variant_get("entry", f"$.{name}", "variant"))


def _variant_kind(name: str) -> str:
    return "BIGINT" if FILE_COLUMNS[name][0] == "long" else "STRING"


def _field(name: str) -> Column:
    value = F.try_variant_get("entry", f"$.{name}", FILE_COLUMNS[name][0])
    return F.when(_field_kind(name) == _variant_kind(name), value).alias(name)


def entries_of(documents: DataFrame) -> DataFrame:
    """One typed row per entry; a value of the wrong JSON type is NULL (see the checks)."""
    return _raw_entries(documents).select(*[_field(name) for name in FILE_COLUMNS])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return entries_of(read_documents(spark, path))


def write_manifest(entries: DataFrame, path: str) -> None:
    """The entries, one for each table, in versioned documents of about DOCUMENT_BYTES, a file each.

    Tables are dealt to the documents by hash, so neither a task nor the reader holds more than a few of them.
    """
    if entries.groupBy("table_name").count().where("count > 1").head(1):
        raise ValueError("a manifest holds one entry for each table")
    written = F.octet_length(F.to_json(F.struct(*FILE_COLUMNS), {"ignoreNullFields": "false"}))
    size = entries.agg(F.sum(written)).first()[0] or 0
    documents = max(1, math.ceil(size / DOCUMENT_BYTES))
    rows = F.array_sort(F.collect_list(F.struct("table_name", F.struct(*FILE_COLUMNS))))
    listed = F.transform(rows, lambda row: row["col2"]).alias("entries")
    if documents == 1:
        dealt = entries.agg(listed)
    else:
        dealt = entries.groupBy(F.pmod(F.xxhash64("table_name"), F.lit(documents)).alias("n")).agg(listed)
    document = dealt.select(F.lit(MANIFEST_VERSION).alias("version"), "entries")
    options = {"ignoreNullFields": "false", "maxRecordsPerFile": 1}
    document.write.mode("overwrite").options(**options).json(path)


def document_violations(documents: DataFrame) -> DataFrame:
    """Problems of the document as a whole, and entry values of a wrong JSON type."""
    kind = F.schema_of_variant("doc")
    version = F.try_variant_get("doc", "$.version", "double")
    entries = F.try_variant_get("doc", "$.entries", "array<variant>")
    problem = (
        F.when(~F.startswith(kind, F.lit("OBJECT")), "not a JSON object")
        .when(F.coalesce(version != MANIFEST_VERSION, F.lit(True)), "unsupported version")
        .when(entries.isNull(), "no entries array")
    )
    whole = documents.select(
        *violation("manifest_document", F.lit("manifest"), F.lit("document"), problem)
    ).where("detail is not null")
    mistyped = [
        F.when(
            _field_kind(name).isNotNull() & ~_field_kind(name).isin(_variant_kind(name), "VOID"),
            F.lit(name),
        )
        for name in FILE_COLUMNS
    ]
    table = F.coalesce(F.try_variant_get("entry", "$.table_name", "string"), F.lit(""))
    typed = (
        _raw_entries(documents)
        .select(table.alias("t"), F.explode(F.array_compact(F.array(*mistyped))).alias("f"))
        .select(*violation("manifest_type", F.col("t"), F.col("f"), F.lit("wrong JSON type")))
    )
    return whole.unionByName(typed)


def entry_violations(entries: DataFrame) -> DataFrame:
    """Missing or empty required text, missing or negative sizes, negative row counts."""
    problems = [
        F.when(
            F.col(name).isNull() | (F.col(name) == ""),
            F.struct(F.lit(name).alias("f"), F.lit("must be a non-empty string").alias("d")),
        )
        for name in REQUIRED_TEXT
    ]
    negative = F.struct(
        F.lit("size_bytes").alias("f"), F.lit("must be a non-negative integer").alias("d")
    )
    problems.append(
        F.when(F.col("size_bytes").isNull() | (F.col("size_bytes") < 0), negative)
    )
    uncounted = F.struct(
        F.lit("row_count").alias("f"), F.lit("must be a non-negative integer or null").alias("d")
    )
    problems.append(F.when(F.col("row_count") < 0, uncounted))
    found = entries.select(
        F.coalesce("table_name", F.lit("")).alias("t"),
        F.explode(F.array_compact(F.array(*problems))).alias("p"),
    )
    return found.select(
        *violation("manifest_field", F.col("t"), F.col("p.f"), F.col("p.d"))
    )


def duplicate_entries(entries: DataFrame) -> DataFrame:
    """Tables with more than one entry."""
    named = entries.where(F.col("table_name").isNotNull())
    return duplicate_keys(named, "manifest", ["table_name"], check="manifest_duplicate")


def upsert(entries: DataFrame, replacements: DataFrame) -> DataFrame:
    """Replace or add entries by table name; the result is ordered by table name."""
    kept = entries.join(replacements.select("table_name"), "table_name", "left_anti")
    merged = kept.unionByName(replacements).select(*entries.columns)
    return merged.orderBy("table_name")


def backfill_row_counts(entries: DataFrame, counts: DataFrame) -> DataFrame:
    """Entries with the counted rows of their file (`file_name, row_count`) where known."""
    counted = counts.select("file_name", F.col("row_count").alias("counted"))
    filled = entries.join(counted, "file_name", "left").withColumn(
        "row_count", F.coalesce("counted", "row_count")
    )
    return filled.select(*entries.columns)


def completeness_violations(entries: DataFrame, registry: DataFrame) -> DataFrame:
    """Registered tables without an entry, and entries nobody registered."""
    have = entries.select("table_name").distinct().withColumn("have", F.lit(True))
    want = registry.select("table_name").withColumn("want", F.lit(True))
    state = F.when(F.col("have").isNull(), "missing").when(F.col("want").isNull(), "unexpected")
    found = want.join(have, "table_name", "full").select(
        *violation("snapshot_complete", F.col("table_name"), F.lit("table_name"), state)
    )
    return found.where("detail is not null")


def metadata_violations(entries: DataFrame, registry: DataFrame) -> DataFrame:
    """Entries whose data set, file name or URL differs from the registered one."""
    want = registry.select("table_name", *[F.col(c).alias(f"want_{c}") for c in REGISTERED])
    differs = [F.when(~F.col(c).eqNullSafe(F.col(f"want_{c}")), F.lit(c)) for c in REGISTERED]
    found = entries.join(want, "table_name").select(
        F.col("table_name"), F.explode(F.array_compact(F.array(*differs))).alias("f")
    )
    return found.select(
        *violation("manifest_metadata", F.col("table_name"), F.col("f"), F.lit("differs"))
    )


def snapshot_violations(entries: DataFrame, registry: DataFrame) -> DataFrame:
    """All conditions a manifest must meet before its files are loaded."""
    return (
        entry_violations(entries)
        .unionByName(duplicate_entries(entries))
        .unionByName(completeness_violations(entries, registry))
        .unionByName(metadata_violations(entries, registry))
    )


def reuse_status(registry: DataFrame, entries: DataFrame, inventory: DataFrame) -> DataFrame:
    """Per registered source: whether the retained file can be reused, else why not.

    `inventory` has `file_name, size_bytes, sha256, header_ok, row_count` of the files found.
    """
    found = inventory.select(
        "file_name",
        F.col("size_bytes").alias("found_bytes"),
        F.col("sha256").alias("found_sha256"),
        "header_ok",
        F.col("row_count").alias("found_rows"),
    )
    known = entries.select(
        "table_name",
        F.lit(True).alias("known"),
        *[F.col(c).alias(f"known_{c}") for c in (*REGISTERED, "size_bytes", "sha256")],
    )
    same_metadata = F.lit(True)
    for name in REGISTERED:
        same_metadata = same_metadata & F.col(name).eqNullSafe(F.col(f"known_{name}"))
    same_content = F.col("known_size_bytes").eqNullSafe(F.col("found_bytes")) & F.col(
        "known_sha256"
    ).eqNullSafe(F.col("found_sha256"))
    status = (
        F.when(F.col("known").isNull(), "no entry")
        .when(~same_metadata, "metadata differs")
        .when(F.col("found_bytes").isNull(), "file missing")
        .when(~same_content, "checksum differs")
        .when(~F.coalesce("header_ok", F.lit(False)), "header differs")
        .otherwise("reuse")
    )
    return (
        registry.join(known, "table_name", "left")
        .join(found, "file_name", "left")
        .select(
            "table_name",
            "file_name",
            status.alias("status"),
            F.when(status == "reuse", F.col("found_rows")).alias("row_count"),
        )
    )


def file_lineage(entries: DataFrame, load_id: str) -> DataFrame:
    """Rows of the lineage table: the manifest entries plus the load they belong to."""
    kinds = {field.name: field.dataType for field in FILE_SCHEMA}
    return entries.select(
        *[F.col(name).cast(kinds[name]).alias(name) for name in FILE_COLUMNS],
        F.lit(load_id).alias(LOAD_ID),
    )
