"""Helpers shared by the operators: words, fresh column names, shared scratch tables, sampling."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text, in order; an empty array for NULL."""
    found = F.array_remove(F.split(text, SPACES), "")
    return F.coalesce(found, F.array().cast("array<string>"))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def fresh(frame: DataFrame, stem: str) -> str:
    """A column name that the frame does not have, compared without case."""
    taken = {name.lower() for name in frame.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


#: Rows and bytes of an Arrow batch at most. A Python worker holds a batch several times over, as text and as what it makes of it.
BATCH_ROWS, BATCH_BYTES = 2_000, 4 << 20


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each Spark context, as Spark ships Python code, and bound what its
    Python workers are given at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if getattr(context, "_reelstrata_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    folder = Path(tempfile.mkdtemp(prefix="run-"))
    with zipfile.ZipFile(folder / "reelstrata_code.zip", "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    context.addPyFile(str(folder / "reelstrata_code.zip"))
    context._reelstrata_shipped = True


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; it has to be set, since executors share no other."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return folder.rstrip("/")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back: cuts lineage, survives lost executors."""
    path = f"{shared_folder(frame.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def crc_mod(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo the divisor; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def spread_sample(frame: DataFrame, group: Column, per_group: int) -> list[int]:
    """Ids of at most per_group rows of each group: the id of least hash in each of per_group hash buckets.

    Buckets combine on the map side, so a hot group costs no more than a small one, and the same
    rows are chosen on every run. Only ids reach the driver.
    """
    key = F.xxhash64(F.col("doc_id"), F.lit("sample"))
    chosen = (
        frame.where(F.col("doc_id").isNotNull())
        .groupBy(group.alias("g"), F.pmod(key, F.lit(per_group)).alias("b"))
        .agg(F.min_by("doc_id", F.struct(key, F.col("doc_id"))).alias("doc_id"))
    )
    return sorted(row.doc_id for row in chosen.select("doc_id").collect())
