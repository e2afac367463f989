"""Lossless scan of tab-separated text and its landing as an all-string table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reelstrata.session import SCAN_BYTES, configure
from reelstrata.sources.inventory import line_counts, line_of, listing
from reelstrata.sources.registry import LOAD_ID, Source
from reelstrata.sources.tables import COMPRESSION

#: Rows of one task have ids that differ in this many low bits only, and its first one has them all 0.
TASK_BITS = 33


@dataclass(frozen=True)
class Landing:
    """A raw table as it is stored, and the rows that were counted on the way."""

    rows: DataFrame
    row_count: int


def check_headers(spark: SparkSession, path: str | list[str], source: Source, once: bool = False) -> None:
    """Refuse files that do not begin with the registered header, or, with `once`, hold it again; one pass."""
    counted = line_counts(spark, path, header=source.header_line)
    fits = F.col("header_ok") & (F.col("headers") == 1) if once else F.col("header_ok")
    wrong = counted.where(~fits).agg(F.min("file_name")).first()[0]
    if wrong is not None:
        raise ValueError(f"{wrong} must have the header of {source.file_name} as its first line{' only' if once else ''}")


def fields_of(lines: DataFrame, source: Source) -> DataFrame:
    """The columns of the lines, which must all have as many fields as the header."""
    fields = lines.select(F.split("line", "\t", -1).alias("fields"))
    wrong = F.raise_error(F.lit(f"a line of {source.file_name} has not {len(source.headers)} fields"))
    fits = F.when(F.size("fields") == len(source.headers), F.lit(True)).otherwise(wrong)
    return fields.where(fits.cast("boolean")).select(
        *[F.col("fields")[i].alias(c) for i, c in enumerate(source.headers)]
    )


def read_tsv(spark: SparkSession, path: str | list[str], source: Source) -> DataFrame:
    """All columns as written: marker text, empty fields, blanks, quotes, backslashes and NULs survive.

    Lines end with a newline or with a carriage return and a newline. Each file must carry the
    registered header, in exact case, as its first line, and every line, an empty one too, the same
    number of fields; anything else fails the read. A lazy scan knows the header by its text alone, so a file
    that holds it again is refused here, while `land` takes the later ones as rows. `path` may be a file, a folder or a list.
    """
    check_headers(spark, path, source, once=True)
    lines = spark.read.text(path, lineSep="\n").select(line_of("value").alias("line"))
    return fields_of(lines.where(F.col("line") != source.header_line), source)


def with_load_id(rows: DataFrame, load_id: str) -> DataFrame:
    return rows.withColumn(LOAD_ID, F.lit(load_id))


def scan_tasks(split_bytes: int = SCAN_BYTES) -> Column:
    """How many tasks can read the listed text at once."""
    tasks = F.when(F.endswith("path", F.lit(".gz")), F.lit(1)).otherwise(
        F.ceil(F.col("length") / F.lit(split_bytes))
    )
    return F.coalesce(F.sum(tasks), F.lit(0))


def _one_file_per_task(spark: SparkSession) -> SparkSession:
    """A session whose scans never put two files into one task; the settings of the given one stay as they are."""
    own = configure(spark.newSession())
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.files.openCostInBytes", own.conf.get("spark.sql.files.maxPartitionBytes"))
    return own


def land(spark: SparkSession, path: str | list[str], source: Source, load_id: str, target: str) -> Landing:
    """Replace the raw table at `target` with the whole content of the text at `path`, in one pass over it.

    The first line of every file must be the registered header; anything after it is a row. The first line of a task that
    starts at byte 0 of a file is known without a sort, since a task reads one file here. Lines and headers are counted while
    they are written. Where a lost executor made tasks count twice, the counts are taken again from what is stored.

    A gzip file is one task however large. With fewer scan tasks than cores the rows are spread
    before encoding; with many files the scan is parallel already and nothing is shuffled.
    """
    own = _one_file_per_task(spark)
    files, tasks = listing(spark, path).agg(F.count("*"), scan_tasks()).first()
    low = F.lit((1 << TASK_BITS) - 1).cast("long")
    lines = own.read.text(path, lineSep="\n").select(
        line_of("value").alias("line"),
        (F.col("_metadata.file_block_start") == 0).alias("from_start"),
        F.monotonically_increasing_id().bitwiseAND(low).alias("place"),
        F.col("_metadata.file_name").alias("file_name"),
    )
    lines = lines.withColumn("first", F.col("from_start") & (F.col("place") == 0))
    seen = Observation()
    lines = lines.observe(seen, F.count("*").alias("lines"), F.count_if("first").alias("headers"))
    refused = F.concat("file_name", F.lit(f" must have the header of {source.file_name} as its first line"))
    is_row = (
        F.when(~F.col("first"), F.lit(True))
        .when(F.col("line") == source.header_line, F.lit(False))
        .otherwise(F.raise_error(refused).cast("boolean"))
    )
    rows = with_load_id(fields_of(lines.where(is_row), source), load_id)
    if tasks < spark.sparkContext.defaultParallelism:
        rows = rows.hint("rebalance")
    rows.write.mode("overwrite").parquet(target, compression=COMPRESSION)
    landed = spark.read.schema(rows.schema).parquet(target)
    counted = seen.get
    if counted["headers"] == files:
        return Landing(landed, counted["lines"] - counted["headers"])
    check_headers(spark, path, source)
    if line_counts(spark, path, header=source.header_line).count() < files:
        raise ValueError(f"a file without a line lacks the header of {source.file_name}")
    return Landing(landed, landed.count())
