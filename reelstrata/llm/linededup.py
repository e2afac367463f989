r"""Line dedup: lines that many documents share lose their place in all of them.

A text is split at \n. The key of a line is the line without `[\x20\x09-\x0D]` at both ends and with A-Z lower-cased.
Keys are hashed to 128 bits, the documents of each hash are counted, and the lines whose key reaches the threshold are
dropped from every document; the other lines stay as written, in their order, joined by \n.

The hashes of a text's lines are computed once and stored, beside a 128-bit hash of the text. A document counts once for
a key because its hashes are made distinct before they are exploded, and counts combine on the map side, so a
line that stands in a third of all documents is a few partial counts. Which places are dropped depends on the text
alone, so places are gathered per different text and met again by the hash of the text: a text with many copies is one row on
that side, and adaptive joins split the other side. No line is shuffled as text.

Defined results: every row is a document, repeated rows and NULL ids included; NULL and empty texts are one empty
line; blank lines have an empty key and stay unless `min_chars` is 0; a document that loses all its lines has an empty text;
no rows give no rows; further columns are kept whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstrata.llm.common import fresh, lower_ascii, stored

MIN_DOCUMENTS, MIN_CHARS = 10, 1
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def hash128(value: Column) -> Column:
    """Two 64-bit hashes from independent seeds."""
    return F.struct(F.xxhash64(value).alias("a"), F.xxhash64(F.lit("line"), value).alias("b"))


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """`a, b` (hash of the text) and `keys`: a hash per line in order, NULL where the key is too short to count."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = F.transform(text_lines(text), line_key)
    hashed = F.transform(keys, lambda key: F.when(F.length(key) >= min_chars, hash128(key)))
    return docs.select(hash128(text).alias("t"), hashed.alias("keys")).select("t.a", "t.b", "keys")


def frequent(hashes: DataFrame, min_documents: int) -> DataFrame:
    """`key_a, key_b, documents` of the keys found in enough documents."""
    once = hashes.select(F.explode(F.array_distinct("keys")).alias("key")).where("key IS NOT NULL")
    counts = once.groupBy(F.col("key.a").alias("key_a"), F.col("key.b").alias("key_b")).agg(F.count(F.lit(1)).alias("documents"))
    return counts.where(F.col("documents") >= min_documents)


def dropped_places(hashes: DataFrame, often: DataFrame) -> DataFrame:
    """`a, b, gone`: the sorted places of the lines that go, for each different text that loses any."""
    lines = hashes.select("a", "b", F.posexplode("keys").alias("place", "key")).where("key IS NOT NULL")
    met = lines.join(often, (F.col("key.a") == F.col("key_a")) & (F.col("key.b") == F.col("key_b")))
    # copies of a text repeat its places; sets combine on the map side
    return met.groupBy("a", "b").agg(F.sort_array(F.collect_set("place")).alias("gone"))


def without(lines: Column, gone: Column) -> Column:
    """The lines but those at the sorted places, as runs between one place and the next: linear in the lines."""

    def run(both: Column, k: Column) -> Column:
        start = F.when(k == 0, 0).otherwise(F.get(both["gone"], k - 1) + 1)
        end = F.coalesce(F.get(both["gone"], k), F.size(both["lines"]))
        return F.slice(both["lines"], start + 1, end - start)

    # bound once as a lambda variable, the text is not split again for every run
    once = F.array(F.struct(lines.alias("lines"), gone.alias("gone")))
    runs = F.transform(once, lambda both: F.transform(F.sequence(F.lit(0), F.size(both["gone"])), lambda k: run(both, k)))
    return F.flatten(F.flatten(runs))


def drop_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents without the lines that at least `min_documents` of them share, and the columns n_lines and n_dropped.

    The names of the two get underscores where `docs` has them already."""
    hashes = stored(line_hashes(docs, min_chars), "lines")
    # stored, the keys are a plain side of the join, so that adaptive joins may split the lines of a hot one
    often = stored(frequent(hashes, min_documents), "frequent")
    gone = stored(dropped_places(hashes, often), "dropped")
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), hash128(F.coalesce(docs["text"], F.lit(""))).alias("t"))
    met = whole.join(gone, (F.col("t.a") == F.col("a")) & (F.col("t.b") == F.col("b")), "left")
    n_lines, n_dropped = fresh(docs, "n_lines"), fresh(docs, "n_dropped")
    lines = text_lines(F.col("doc.text"))
    places = F.coalesce("gone", F.array().cast("array<int>"))
    kept = F.when(F.col("gone").isNull(), F.coalesce(F.col("doc.text"), F.lit(""))).otherwise(
        F.array_join(without(lines, F.col("gone")), "\n")
    )
    return met.select(
        *[(kept if c == "text" else F.col("doc").getField(c)).alias(c) for c in docs.columns],
        F.size(lines).cast("long").alias(n_lines),
        F.size(places).cast("long").alias(n_dropped),
    )


def line_dedup(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS) -> DataFrame:
    """`doc_id, n_lines, n_dropped, kept_sha256` of every document."""
    return drop_lines(docs.select("doc_id", "text"), min_documents, min_chars).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


# the same rows in DuckDB, without hashes of keys
LINE_SQL = rf"""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
keyed AS (
  SELECT *, list_transform(ls, lambda l: translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ks FROM numbered),
often AS (
  SELECT k FROM (SELECT unnest(list_distinct(ks)) AS k FROM keyed)
  WHERE length(k) >= {MIN_CHARS} GROUP BY k HAVING count(*) >= {MIN_DOCUMENTS}),
lines AS (SELECT r, doc_id, unnest(ls) AS l, unnest(ks) AS k, generate_subscripts(ks, 1) AS place FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(o.k) AS n_dropped,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY place) FILTER (o.k IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN often o ON lines.k = o.k GROUP BY r, doc_id"""
