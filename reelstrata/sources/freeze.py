"""Frozen schemas: the columns of every landed table, with a version, stored with each build and compared at the next load.

A schema is data here, one row per column, so that the comparison of many tables is one join and can run before the first
row of a load is read.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstrata.operators.checks import violation
from reelstrata.sources.catalog import Scanner
from reelstrata.sources.registry import FILE_SCHEMA, LOAD_ID, SOURCES
from reelstrata.sources.tables import Build, write_table

SCHEMA_ROW = "table_name string, position int, column_name string, data_type string"
VERSIONED_ROW = f"{SCHEMA_ROW}, schema_version long"

#: Where a build keeps the schemas of its raw tables.
STORED = ("meta", "table_schemas")


def schema_rows(spark: SparkSession, schemas: Mapping[str, T.StructType]) -> DataFrame:
    rows = [
        (table, position, field.name, field.dataType.simpleString())
        for table, schema in schemas.items()
        for position, field in enumerate(schema, 1)
    ]
    return spark.createDataFrame(rows, SCHEMA_ROW)


def registered_schemas() -> dict[str, T.StructType]:
    """What the next load will land: the registered headers as text, the file rows, and the load."""
    return {
        **{name: source.schema.add(LOAD_ID, "string") for name, source in SOURCES.items()},
        "ingestion_files": T.StructType(list(FILE_SCHEMA)).add(LOAD_ID, "string"),
    }


def schema_changes(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Columns that were added, removed, moved or retyped, as findings. Tables that were not stored yet are free."""
    old = stored.select("table_name", "column_name", F.struct("position", "data_type").alias("old"))
    new = incoming.select("table_name", "column_name", F.struct("position", "data_type").alias("new"))
    known = stored.select("table_name").distinct()
    met = old.join(new, ["table_name", "column_name"], "full").join(known, "table_name", "left_semi")
    moved = F.concat_ws(" to ", F.col("old.position"), F.col("new.position"))
    retyped = F.concat_ws(" to ", "old.data_type", "new.data_type")
    detail = (
        F.when(F.col("old").isNull(), F.lit("added"))
        .when(F.col("new").isNull(), F.lit("removed"))
        .when(F.col("old.data_type") != F.col("new.data_type"), F.concat(F.lit("type "), retyped))
        .when(F.col("old.position") != F.col("new.position"), F.concat(F.lit("moved "), moved))
    )
    found = met.select(*violation("schema_frozen", F.col("table_name"), F.col("column_name"), detail))
    return found.where("detail IS NOT NULL")


def next_schemas(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """The incoming columns with their schema version: 1 for a new table, one more where anything changed."""
    versions = stored.groupBy("table_name").agg(F.max("schema_version").alias("version"))
    changed = schema_changes(stored, incoming).select(F.col("relation").alias("table_name")).distinct()
    marked = changed.withColumn("step", F.lit(1).cast("long"))
    zero = F.lit(0).cast("long")
    rows = incoming.join(versions, "table_name", "left").join(marked, "table_name", "left")
    version = F.when(F.col("version").isNull(), F.lit(1)).otherwise(F.col("version") + F.coalesce("step", zero))
    return rows.select(*incoming.columns, version.cast("long").alias("schema_version"))


def stored_schemas(spark: SparkSession, build: Build | None) -> DataFrame:
    """The versioned schemas of a build; those of its raw tables, as version 1, if it was built before they were kept."""
    if build is None:
        return spark.createDataFrame([], VERSIONED_ROW)
    try:
        return build.scan(spark, *STORED)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    scan = Scanner(spark, build)
    raw = {name: scan("raw", name).schema for name in registered_schemas()}
    return schema_rows(spark, raw).withColumn("schema_version", F.lit(1).cast("long"))


def frozen_changes(stored: DataFrame, incoming: DataFrame, may_change: Collection[str] = ()) -> DataFrame:
    """Changes of tables that are not allowed to change."""
    return schema_changes(stored, incoming).where(~F.col("relation").isin(list(may_change) or [""]))


def store_schemas(schemas: DataFrame, build: Build) -> DataFrame:
    return write_table(schemas.coalesce(1), build.location(*STORED))
