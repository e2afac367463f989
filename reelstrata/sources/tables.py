"""Parquet tables of one build, the published build, and compaction."""

from __future__ import annotations

import json
import math
import secrets
from dataclasses import dataclass
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

COMPRESSION = "zstd"

_PUBLISHED = "build_id string, published_at string, version long, based_on long"
VERSION_DIGITS = 12

#: Wanted size of a file after compaction.
FILE_BYTES = 512 * 1024**2

#: Share of the wanted size from which a file counts as full.
FULL = 0.75


@dataclass(frozen=True)
class Build:
    """Tables of one isolated build: `<root>/builds/<build_id>/<schema>/<table>`."""

    root: str
    build_id: str

    def location(self, schema: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/builds/{self.build_id}/{schema}/{table}"

    def scan(self, spark: SparkSession, schema: str, table: str) -> DataFrame:
        return spark.read.parquet(self.location(schema, table))


def new_build_id(now: datetime | None = None, token: str | None = None) -> str:
    moment = (now or datetime.now(timezone.utc)).astimezone(timezone.utc)
    return f"{moment:%Y%m%dT%H%M%SZ}-{token or secrets.token_hex(4)}"


def write_table(
    rows: DataFrame,
    path: str,
    *,
    lookup: str | None = None,
    sort: tuple[str, ...] = (),
    mode: str = "overwrite",
) -> DataFrame:
    """Replace the table at `path`, or refuse to with another save mode.

    `lookup` names the column point queries filter on. Rows are sorted by it inside each task's
    file (no shuffle, so a hot key stays spread) and its bloom filters are written, which lets a
    point query skip nearly every row group.
    """
    writer = rows
    if lookup or sort:
        writer = rows.sortWithinPartitions(*([lookup] if lookup else []), *sort)
    out = writer.write.mode(mode).option("compression", COMPRESSION)
    if lookup:
        out = out.option(f"parquet.bloom.filter.enabled#{lookup}", "true")
    out.parquet(path)
    return rows.sparkSession.read.parquet(path)


class PublishConflict(RuntimeError):
    """Another build was published since the version that this one was made from."""


def _history(spark: SparkSession, root: str) -> list[Row]:
    """The publications in force, oldest first, and nothing else of the log: an entry counts if it names the one
    in force before it, so of two entries made from the same version only the lower number does."""
    try:
        rows = spark.read.schema(_PUBLISHED).json(f"{root}/published").where("build_id IS NOT NULL").collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    history: list[Row] = []
    for row in sorted(rows, key=lambda row: row["version"]):
        if row["based_on"] == (history[-1]["version"] if history else 0):
            history.append(row)
    return history


def _taken(spark: SparkSession, root: str) -> int:
    """The highest number in the log, that of a publication which was never finished included."""
    number = F.regexp_extract("path", r"(\d+)\.json$", 1).try_cast("long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json")
    try:
        return files.load(f"{root}/published").agg(F.max(number)).first()[0] or 0
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise


def _create(spark: SparkSession, path: str, text: str) -> None:
    """A new file, or a conflict if there is one: the storage decides who was first."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        out = system.create(target, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            raise PublishConflict(f"{path} was published by another build") from None
        raise
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def publish(spark: SparkSession, build: Build, based_on: int, now: datetime | None = None) -> int:
    """Make a build current if `based_on` is still the version in force, and return its version.

    The log is a numbered file for each publication. A file is created only if its number is free, so of two
    publishers that start from one version the second fails; no clock is asked. Earlier builds stay readable.
    """
    if current_version(spark, build.root) != based_on:
        raise PublishConflict(f"{build.build_id} was made from version {based_on}, which is no longer current")
    moment = (now or datetime.now(timezone.utc)).astimezone(timezone.utc)
    version = _taken(spark, build.root) + 1
    row = {
        "build_id": build.build_id,
        "published_at": f"{moment:%Y-%m-%dT%H:%M:%S.%fZ}",
        "version": version,
        "based_on": based_on,
    }
    _create(spark, f"{build.root}/published/{version:0{VERSION_DIGITS}d}.json", json.dumps(row) + "\n")
    if all(entry["version"] != version for entry in _history(spark, build.root)):
        raise PublishConflict(f"{build.build_id}: another build was published from version {based_on}")
    return version


def published_builds(spark: SparkSession, root: str) -> DataFrame:
    """Every publication that was in force, newest first."""
    return spark.createDataFrame(_history(spark, root)[::-1], _PUBLISHED)


def current_version(spark: SparkSession, root: str) -> int:
    """The version in force, 0 before the first."""
    history = _history(spark, root)
    return history[-1]["version"] if history else 0


def current_build(spark: SparkSession, root: str) -> Build | None:
    history = _history(spark, root)
    return Build(root, history[-1]["build_id"]) if history else None


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the data files under `path`; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.sum("length")).first()[0] or 0


def fingerprint(rows: DataFrame) -> tuple:
    """Row count and order-free content sum, to compare two copies of a table."""
    mixed = F.xxhash64(*rows.columns).cast("decimal(20,0)")
    return tuple(rows.agg(F.count("*"), F.sum(mixed)).first())


def full_files(spark: SparkSession, path: str | list[str], file_bytes: int) -> tuple[list[str], list[str]]:
    """The files of a table that are about as large as wanted, and those that are smaller; the listing alone is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    rows = files.select("path", (F.col("length") >= file_bytes * FULL).alias("full")).collect()
    return sorted(r["path"] for r in rows if r["full"]), sorted(r["path"] for r in rows if not r["full"])


def _packing(spark: SparkSession, file_bytes: int) -> SparkSession:
    """A session whose scans pack whole files into tasks of at most this size; the settings of the given one stay."""
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(file_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    return own


def compact(
    spark: SparkSession,
    source: str | list[str],
    target: str,
    *,
    lookup: str | None = None,
    sort: tuple[str, ...] = (),
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """The table at `source`, a folder or its files, in fewer files, without a shuffle.

    Small files are packed into tasks of up to `file_bytes` and written as one file each, at the new path. Files that are
    about as large are neither read nor copied; the result refers to them where they are.
    With `lookup` and `sort` the rows are sorted again inside the new files and bloom filters are written.
    """
    if isinstance(source, str) and source.rstrip("/") == target.rstrip("/"):
        raise ValueError("compaction must write to a new path")
    kept, small = full_files(spark, source, file_bytes)
    if len(small) < 2:
        return spark.read.parquet(*kept, *small) if kept or small else spark.read.parquet(source)
    schema = spark.read.parquet(small[0]).schema
    rows = _packing(spark, file_bytes).read.schema(schema).parquet(*small)
    write_table(rows, target, lookup=lookup, sort=sort, mode="errorifexists")
    packed = spark.read.schema(schema).parquet(target)
    if fingerprint(rows) != fingerprint(packed):
        raise RuntimeError(f"compaction changed the rows of {source}")
    return spark.read.schema(schema).parquet(target, *kept) if kept else packed
