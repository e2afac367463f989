"""Counting the tokens of each document in flat token files that have no index.

A token file is a run of 16-bit identifiers, highest byte first, with one separator identifier after each
document. A file of any size is read by as many tasks as Spark cuts it into, through Spark's line reader: a byte that
the separator does not have stands for the end of a line, so no cut hits a separator. Runs of lines make blocks of bytes; in each
block all separators are found by vectorised comparison, at even and at odd places, since a block does not know how many bytes come
before it. A prefix scan over the blocks of a file, as narrow rows, gives each block its place, and with it which of the two holds, the
number of documents before it and the last separator before it, so a document that spans blocks and tasks is stitched from its parts.

Token files of documents are written in one job together with the ids of the documents, row for row, so nothing depends on
how a later job would cut the documents; a row without a counterpart fails the query.

Defined results: two separators in a row hold a document of 0 tokens; identifiers after the last separator
are no document; an empty file or folder holds none; a NULL or empty text is written as a document of 0 tokens, and a NULL id stays
NULL; repeated rows count each; texts of any length are one run of identifiers; further columns do not matter.
"""

from __future__ import annotations

import base64
import uuid
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelstrata.llm.common import shared_folder, stored

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: An identifier that the vocabulary does not use and whose two bytes are the UTF-8 form of one character,
#: so that Spark's text writer can put it after every row.
SEPARATOR = 0xC480
#: Bytes of a block, but for the line that ends it.
BLOCK = 1 << 20
#: Documents of a token file that is written here, at most.
FILE_ROWS = 4_096


@cache
def encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("flat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def tokenised(path: str):
    """The identifiers of a text as big-endian 16-bit numbers."""

    @F.arrow_udf("binary")
    def run(texts: pa.Array) -> pa.Array:
        encode = encoder(path).encode_ordinary
        return pa.array([np.array(encode(t or ""), ">u2").tobytes() for t in texts.to_pylist()], pa.binary())

    return run


#: Folders of a written corpus: the flat files, and the ids of their documents.
TOKENS, IDS = "kind=tokens", "kind=ids"
PLACE_BITS = 33


def _letter(separator: int) -> str:
    """The separator as the one character whose UTF-8 form its two bytes are."""
    return separator.to_bytes(2, "big").decode()


def write_tokens(docs: DataFrame, folder: str, path: str = VOCABULARY) -> None:
    """Token files of up to FILE_ROWS documents each, and beside each a file of the same name with the place and the id of
    every document, from one job: a task writes both from the same rows, in the order of their places."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    rows = docs.select(
        place.alias("place"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        tokenised(path)("text").cast("string").alias("tokens"),
    )
    entries = F.array(
        F.struct(F.lit("ids").alias("kind"), F.concat_ws(",", F.col("place").cast("string"), "id").alias("value")),
        F.struct(F.lit("tokens").alias("kind"), F.col("tokens").alias("value")),
    )
    both = rows.select("place", F.inline(entries)).sortWithinPartitions("kind", "place").select("kind", "value")
    out = both.write.partitionBy("kind").option("lineSep", _letter(SEPARATOR))
    out.option("maxRecordsPerFile", FILE_ROWS).text(folder)


BLOCKS = "file string, split long, block long, n_bytes long, even array<int>, odd array<int>"


def _blocks(separator: int, line_end: int, block: int):
    """The task function: for each run of lines its bytes, and where separators begin at even and at odd places."""

    def run(batches):
        from itertools import groupby

        now, number, held, size = None, 0, [], 0

        def row():
            content = np.frombuffer(b"".join(line + bytes([line_end]) for line in held), np.uint8)
            pairs = (content[:-1].astype(np.int32) << 8 | content[1:]) == separator
            at = np.flatnonzero(pairs).astype(np.int32)
            lists = [pa.array([at[at % 2 == parity]], pa.list_(pa.int32())) for parity in (0, 1)]
            fixed = [pa.array([now[0]]), *(pa.array([v], pa.int64()) for v in (now[1], number, len(content)))]
            return pa.RecordBatch.from_arrays([*fixed, *lists], ["file", "split", "block", "n_bytes", "even", "odd"])

        for batch in batches:
            at = 0
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for key, same in groupby(keys):
                if key != now:
                    if held:
                        yield row()
                    now, number, held, size = key, 0, [], 0
                for line in batch.column(2).slice(at, sum(1 for _ in same)).to_pylist():
                    held.append(line)
                    size += len(line) + 1
                    at += 1
                    if size >= block:
                        yield row()
                        number, held, size = number + 1, [], 0
        if held:
            yield row()

    return run


def count_tokens(spark: SparkSession, folder: str, separator: int = SEPARATOR, block: int = BLOCK) -> DataFrame:
    """file, number of the document in it, position of its first token, number of its tokens."""
    line_end = next(b for b in (0x0A, 0x09, 0x20, 0x2C) if b not in separator.to_bytes(2, "big"))
    lines = spark.read.text(folder, lineSep=chr(line_end)).select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("line"),
    )
    found = stored(lines.mapInArrow(_blocks(separator, line_end, block), BLOCKS), "separators")
    order = Window.partitionBy("file").orderBy("split", "block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    zero, nowhere = F.lit(0).cast("long"), F.lit(-1).cast("long")
    narrow = found.select(
        "file", "split", "block", "n_bytes",
        F.coalesce(F.sum("n_bytes").over(before), zero).alias("start"),
        *[F.size(c).alias(f"n_{c}") for c in ("even", "odd")],
        *[F.try_element_at(F.col(c), F.lit(-1)).cast("long").alias(f"last_{c}") for c in ("even", "odd")],
    )
    aligned = F.col("start") % 2 == 0
    narrow = narrow.select(
        "file", "split", "block", "start",
        F.when(aligned, F.col("n_even")).otherwise(F.col("n_odd")).cast("long").alias("n"),
        F.when(aligned, F.col("last_even")).otherwise(F.col("last_odd")).alias("last"),
    )
    scanned = narrow.select(
        "file", "split", "block", "start",
        F.coalesce(F.sum("n").over(before), zero).alias("docs_before"),
        F.coalesce(F.max((F.col("start") + F.col("last")) / 2).over(before).cast("long"), nowhere).alias("last_before"),
    )
    places = F.when(aligned, F.col("even")).otherwise(F.col("odd"))
    ends = found.join(scanned, ["file", "split", "block"]).select(
        "file", "docs_before", "last_before", "start", places.alias("at"), F.posexplode(places).alias("i", "offset")
    )
    place = lambda offset: ((F.col("start") + offset) / 2).cast("long")
    previous = F.when(F.col("i") > 0, place(F.get("at", F.col("i") - 1))).otherwise(F.col("last_before"))
    return ends.select(
        "file",
        (F.col("docs_before") + F.col("i")).alias("doc_no"),
        (previous + 1).alias("first_token"),
        (place(F.col("offset")) - previous - 1).alias("n_tokens"),
    )


def written_ids(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """`file, doc_no, doc_id` of a written corpus."""
    rows = spark.read.text(f"{folder}/{IDS}", lineSep=_letter(SEPARATOR))
    parts = F.split("value", ",", 2)
    return rows.select(
        F.col("_metadata.file_name").alias("file"),
        (parts[0].cast("long") % FILE_ROWS).alias("doc_no"),
        F.nullif(parts[1], F.lit("")).cast(kind).alias("doc_id"),
    )


def document_tokens(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, file, doc_no, first_token and n_tokens of documents, through flat token files."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/llm/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, folder, path)
    if docs.isEmpty():
        return spark.createDataFrame([], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, file string, doc_no long, first_token long, n_tokens long")
    counted = count_tokens(spark, f"{folder}/{TOKENS}")
    ids = written_ids(spark, folder, docs.schema["doc_id"].dataType.simpleString())
    ids = ids.select(F.col("file").alias("id_file"), F.col("doc_no").alias("id_no"), "doc_id")
    on = (F.col("file") == F.col("id_file")) & (F.col("doc_no") == F.col("id_no"))
    lost = F.raise_error(F.lit("token files and ids differ")).cast("string")
    both = F.col("file").isNotNull() & F.col("id_file").isNotNull()
    return counted.join(ids, on, "full").select(
        "doc_id", F.when(both, F.col("file")).otherwise(lost).alias("file"), "doc_no", "first_token", "n_tokens"
    )
