"""What a build consists of, stored with it: its relations with their columns, and its files with rows and key ranges.

Listing, presence, row counts and the choice of files for a key are answered from these two small tables, in any session,
without a scan of the build. A table may also hold files of an earlier build, which compaction keeps where they are.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstrata.operators.checks import union_all
from reelstrata.sources.tables import Build, write_table

COLUMNS = ("meta", "relations")
FILES = ("meta", "files")
COLUMN_ROW = "schema string, relation string, stored boolean, position int, column_name string, data_type string"


def column_rows(spark: SparkSession, relations: Mapping[str, Mapping[str, DataFrame]], stored: Mapping[str, str]) -> DataFrame:
    """A row for each column of each relation; `stored` names the tables, with their schema."""
    rows = [
        (schema, name, stored.get(name) == schema, position, field.name, field.dataType.simpleString())
        for schema, frames in relations.items()
        for name, frame in frames.items()
        for position, field in enumerate(frame.schema, 1)
    ]
    return spark.createDataFrame(rows, COLUMN_ROW)


def file_rows(rows: DataFrame, schema: str, relation: str, key: str | None = None) -> DataFrame:
    """A row for each file of a stored table that holds rows: size, rows, least and greatest key. Only the key is read."""
    # the path as it was given, not as a URI spells it
    path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    keyed = rows.select(
        path.alias("path"),
        F.col("_metadata.file_size").alias("size_bytes"),
        (F.col(key) if key else F.lit(None)).cast("string").alias("key"),
    )
    measured = keyed.groupBy("path", "size_bytes").agg(
        F.count("*").alias("row_count"),
        F.min("key").alias("least_key"),
        F.max("key").alias("greatest_key"),
        F.count_if(F.col("key").isNull()).alias("rows_without_key"),
    )
    return measured.select(F.lit(schema).alias("schema"), F.lit(relation).alias("relation"), *measured.columns)


def write_catalog(
    spark: SparkSession,
    build: Build,
    relations: Mapping[str, Mapping[str, DataFrame]],
    stored: Mapping[str, str],
    keys: Mapping[str, str],
) -> None:
    """Store what the relations of a build consist of. Stored tables are measured as they are read back."""
    write_table(column_rows(spark, relations, stored).coalesce(1), build.location(*COLUMNS))
    measured = [
        file_rows(relations[schema][name], schema, name, keys.get(name))
        for name, schema in stored.items()
        if relations[schema][name].inputFiles()
    ]
    write_table(union_all(measured).coalesce(1), build.location(*FILES))


def _read(spark: SparkSession, build: Build, table: tuple[str, str]) -> DataFrame | None:
    try:
        return build.scan(spark, *table)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def columns_of(spark: SparkSession, build: Build) -> DataFrame:
    """COLUMN_ROW of a build; no rows if it has no catalog."""
    found = _read(spark, build, COLUMNS)
    return spark.createDataFrame([], COLUMN_ROW) if found is None else found


def relations_of(spark: SparkSession, build: Build) -> DataFrame:
    """`schema, name` of every relation."""
    return columns_of(spark, build).select("schema", F.col("relation").alias("name")).distinct()


def files_of(spark: SparkSession, build: Build) -> DataFrame | None:
    return _read(spark, build, FILES)


def counted_rows(spark: SparkSession, build: Build, schema: str) -> DataFrame:
    """`relation_name, row_count` of the stored tables of a schema, empty ones included, from the files' counts."""
    listed = columns_of(spark, build).where((F.col("schema") == schema) & F.col("stored")).select("relation").distinct()
    files = files_of(spark, build)
    if files is None:
        raise ValueError(f"{build.build_id} has no catalog")
    totals = files.where(F.col("schema") == schema).groupBy("relation").agg(F.sum("row_count").alias("n"))
    return listed.join(totals, "relation", "left").select(
        F.col("relation").alias("relation_name"), F.coalesce("n", F.lit(0)).cast("long").alias("row_count")
    )


class Scanner:
    """Scans the stored tables of a build: their folder, or file by file where some lie in an earlier build."""

    def __init__(self, spark: SparkSession, build: Build):
        self.spark, self.build = spark, build
        self.foreign: dict[tuple[str, str], list[str]] = {}
        self.columns: dict[tuple[str, str], T.StructType] = {}
        files = files_of(spark, build)
        if files is None:
            return
        own = F.concat(F.lit(f"/builds/{build.build_id}/"), F.col("schema"), F.lit("/"))
        mixed = files.groupBy("schema", "relation").agg(F.every(F.contains("path", own)).alias("own")).where(~F.col("own"))
        for row in files.join(mixed, ["schema", "relation"]).select("schema", "relation", "path").collect():
            self.foreign.setdefault((row["schema"], row["relation"]), []).append(row["path"])
        # a table without rows has no files here, but its columns are known
        bare = columns_of(spark, build).where("stored").join(files, ["schema", "relation"], "left_anti")
        for row in sorted(bare.collect(), key=lambda row: row["position"]):
            fields = self.columns.setdefault((row["schema"], row["relation"]), T.StructType())
            fields.add(row["column_name"], T.StructType.fromDDL(f"c {row['data_type']}")["c"].dataType)

    def source(self, schema: str, name: str) -> str | list[str]:
        """The folder or the files of a table."""
        return sorted(self.foreign.get((schema, name), [])) or self.build.location(schema, name)

    def __call__(self, schema: str, name: str) -> DataFrame:
        if (schema, name) in self.columns:
            return self.spark.createDataFrame([], self.columns[schema, name])
        source = self.source(schema, name)
        return self.spark.read.parquet(*([source] if isinstance(source, str) else source))


def scan_key(spark: SparkSession, build: Build, schema: str, name: str, key: str, value: str) -> DataFrame:
    """The rows with a key, from the files whose range holds it."""
    files = files_of(spark, build)
    if files is None:
        rows = build.scan(spark, schema, name)
    else:
        near = files.where((F.col("schema") == schema) & (F.col("relation") == name))
        near = near.where(F.lit(value).between(F.col("least_key"), F.col("greatest_key")))
        paths = sorted(row["path"] for row in near.select("path").collect())
        rows = spark.read.parquet(*paths) if paths else Scanner(spark, build)(schema, name).where("false")
    return rows.where(F.col(key) == value)
