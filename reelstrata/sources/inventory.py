"""What is in the raw folder: size, digest, header and row count of each file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstrata.sources.registry import SOURCES

# The codec that leaves bytes alone, and the names of its setting in plain and in shaded Hadoop clients.
PASSTHROUGH = "org.apache.hadoop.io.compress.PassthroughCodec"
PASSTHROUGH_EXTENSION = (
    "io.compress.passthrough.extension",
    "org.apache.hadoop.shaded.io.compress.passthrough.extension",
)

DIGEST = "path string, size_bytes long, sha256 string"


def listing(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """`path, length` of every file that holds a byte, and its `uri` as all scans give it; contents are not read."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", F.col("_metadata.file_path").alias("uri"))


def _name(path_column: str) -> Column:
    return F.element_at(F.split(path_column, "/"), -1).alias("file_name")


def _digests_of_lines():
    """The task function: a running hash over the lines of one file after the other, shipped to workers by value."""
    schema = DIGEST

    def hashed(batches):
        import hashlib
        from itertools import groupby

        import pyarrow as pa

        mark = b"\xef\xbb\xbf"  # the line reader leaves it out at the start of a file
        path, size, seen, plain, marked = None, 0, 0, None, None
        done = []

        def finish():
            if size is None:  # lines, each with its newline
                plain.update(b"\n")
                done.append((path, seen + 1, plain.hexdigest()))
                return
            # the size tells whether a mark came first and a newline last
            rest = size - seen
            digest = marked if rest >= len(mark) else plain
            rest -= len(mark) if rest >= len(mark) else 0
            if rest not in (0, 1):
                raise ValueError(f"{path}: {seen} of {size} bytes were read")
            digest.update(b"\n" * rest)
            done.append((path, size, digest.hexdigest()))

        for batch in batches:
            start = 0
            for name, run in groupby(batch.column(0).to_pylist()):
                count = sum(1 for _ in run)
                text = b"\n".join(batch.column(2).slice(start, count).to_pylist())
                if name != path:
                    if path is not None:
                        finish()
                    path, size, seen = name, batch.column(1)[start].as_py(), 0
                    plain, marked = hashlib.sha256(), hashlib.sha256(mark)
                else:
                    text = b"\n" + text
                plain.update(text)
                if size is not None:
                    marked.update(text)
                seen += len(text)
                start += count
        if path is not None:
            finish()
        columns = list(zip(*done)) or [(), (), ()]
        kinds = {"long": pa.int64(), "string": pa.string()}
        fields = [(n, kinds[kind]) for n, kind in (f.split() for f in schema.split(","))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, (_, kind) in zip(columns, fields)], [n for n, _ in fields]
        )

    return hashed


def file_digests(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """`path, file_name, size_bytes, sha256` for every file of the pattern, which ends in a plain extension (`*.gz`).

    The bytes come through Spark's line reader, so any storage that Spark reads will do, and a file of any size is
    hashed as a stream by one task. The extension is declared as not compressed, which gives the bytes as they are stored
    and keeps a file in one piece. Only what stands between two newline bytes is held at once. Spark's listing leaves out
    files without a byte; to a snapshot they are missing.
    """
    stem, dot, extension = pattern.rpartition(".")
    if not dot or not extension.isalnum():
        raise ValueError(f"the pattern must end in a plain extension: {pattern}")
    stored = (
        spark.read.option("pathGlobFilter", pattern)
        .options(**{"io.compression.codecs": PASSTHROUGH, **dict.fromkeys(PASSTHROUGH_EXTENSION, f".{extension}")})
        .text(path, lineSep="\n")
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_size").alias("size_bytes"),
            F.col("value").cast("binary").alias("value"),
        )
    )
    hashed = stored.mapInArrow(_digests_of_lines(), DIGEST).select(F.col("path").alias("hashed_uri"), "sha256")
    listed = listing(spark, path, pattern)
    # a file of a byte-order mark alone has no line
    unread = F.raise_error(F.concat(F.col("path"), F.lit(" was not read"))).cast("string")
    lineless = F.when(F.col("length") == 3, F.lit("\ufeff"))
    digest = F.coalesce("sha256", F.sha2(lineless.cast("binary"), 256), unread)
    return listed.join(hashed, F.col("uri") == F.col("hashed_uri"), "left").select(
        "path", _name("path"), F.col("length").alias("size_bytes"), digest.alias("sha256")
    )


def line_digests(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """`path, file_name, size_bytes, sha256` of the lines of every file that has one, each line with a newline after it.

    For files that are kept compressed: they are unpacked as they are hashed, a stream and a task for each, and what they
    hold is never stored.
    """
    split = F.raise_error(F.concat(F.col("_metadata.file_path"), F.lit(" is read in pieces")))
    lines = spark.read.option("pathGlobFilter", pattern).text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("path"),
        F.when(F.col("_metadata.file_block_start") > 0, split).cast("long").alias("size_bytes"),
        F.col("value").cast("binary").alias("value"),
    )
    hashed = lines.mapInArrow(_digests_of_lines(), DIGEST)
    return hashed.select("path", _name("path"), "size_bytes", "sha256")


def line_of(value: str) -> Column:
    """A line without the carriage return before its newline."""
    text = F.col(value)
    return F.when(F.endswith(text, F.lit("\r")), F.left(text, F.length(text) - 1)).otherwise(text)


def line_counts(
    spark: SparkSession, path: str | list[str], pattern: str | None = None, header: str | None = None
) -> DataFrame:
    """`file_name, row_count, header_ok, headers`: lines after the header, also without a last newline.

    Each file is held to its registered header, or all of them to `header` if that is given: it must be the
    first line. Later lines equal to it are rows; `headers` counts them all.
    One pass and a count per file. The first line of a file is the one with the smallest row id
    in the block that starts at byte 0, so the header test needs no sort.
    """
    reader = spark.read
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if header is None:
        headers = F.create_map(
            *[F.lit(text) for s in SOURCES.values() for text in (s.file_name, s.header_line)]
        )
        wanted = headers[F.col("_metadata.file_name")]
    else:
        wanted = F.lit(header)
    lines = reader.text(path, lineSep="\n").select(
        F.col("_metadata.file_name").alias("file_name"),
        F.when(
            F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()
        ).alias("id"),
        (line_of("value") == wanted).alias("is_header"),
    )
    counted = lines.groupBy("file_name").agg(
        (F.count("*") - 1).alias("row_count"),
        F.min("id").alias("first"),
        F.min(F.when(F.col("is_header"), F.col("id"))).alias("header"),
        F.count_if("is_header").alias("headers"),
    )
    return counted.select(
        "file_name",
        "row_count",
        F.coalesce(F.col("first") == F.col("header"), F.lit(False)).alias("header_ok"),
        "headers",
    )


def inventory(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Size, digest, row count and header state per file; an empty file has no header."""
    counted = line_counts(spark, path, pattern).drop("headers")
    return (
        file_digests(spark, path, pattern)
        .drop("path")
        .join(counted, "file_name", "left")
        .withColumn("header_ok", F.coalesce("header_ok", F.lit(False)))
    )
