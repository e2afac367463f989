"""The seven text tables of a snapshot, derived from the given relational tables.

Orders and customers become titles (a customer is the series of its orders), line items become
credits and crew, parts and suppliers become people, events become alternate titles. Every column
is text and carries the null marker where a snapshot would.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstrata.functions.values import NULL_TEXT
from reelstrata.plans.intermediate import intermediate
from reelstrata.plans.marts import mart
from reelstrata.plans.staging import stage
from reelstrata.sources.registry import SOURCES
from reelstrata.sources.tsv import with_load_id

LOAD = "load-1"
BASE_URL = "https://files.example.org"


@cache
def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _key(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _marked(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(NULL_TEXT))


def _title_basics(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("o_totalprice")
    priority = F.col("o_orderpriority")
    status = F.col("o_orderstatus")
    genres = F.concat_ws(
        ",", priority, F.concat(F.lit("status "), status), F.when(price > 250000, "large")
    )
    orders = table(spark, folder, "orders").select(
        _key("tto", "o_orderkey").alias("tconst"),
        F.when(status == "F", "tvEpisode").when(status == "O", "movie").otherwise("short").alias(
            "titleType"
        ),
        F.concat(priority, F.lit(" #"), F.col("o_orderkey").cast("string")).alias("primaryTitle"),
        F.when(priority == "4-NOT SPECIFIED", "").otherwise(priority).alias("originalTitle"),
        _marked(F.when(status != "P", F.when(price > 400000, "1").otherwise("0"))).alias("isAdult"),
        _marked(F.when(priority != "5-LOW", F.year("o_orderdate"))).alias("startYear"),
        F.lit(NULL_TEXT).alias("endYear"),
        F.floor(price / 1000).cast("string").alias("runtimeMinutes"),
        _marked(F.when(price >= 50000, genres)).alias("genres"),
    )
    series = table(spark, folder, "customer").select(
        _key("ttc", "c_custkey").alias("tconst"),
        F.lit("tvSeries").alias("titleType"),
        F.col("c_name").alias("primaryTitle"),
        F.col("c_name").alias("originalTitle"),
        F.lit("0").alias("isAdult"),
        F.lit(NULL_TEXT).alias("startYear"),
        F.lit(NULL_TEXT).alias("endYear"),
        F.lit(NULL_TEXT).alias("runtimeMinutes"),
        F.col("c_mktsegment").alias("genres"),
    )
    return orders.unionByName(series)


def _title_episode(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        _key("tto", "o_orderkey").alias("tconst"),
        _key("ttc", "o_custkey").alias("parentTconst"),
        (F.year("o_orderdate") - 1994).cast("string").alias("seasonNumber"),
        _marked(F.when(F.col("o_orderpriority") != "5-LOW", F.month("o_orderdate"))).alias(
            "episodeNumber"
        ),
    )


def _title_principals(spark: SparkSession, folder: str) -> DataFrame:
    flag = F.col("l_returnflag")
    quantity = F.concat(F.lit("qty "), F.col("l_quantity").cast("int").cast("string"))
    characters = F.concat(F.lit('["'), flag, F.lit('","'), quantity, F.lit('"]'))
    return table(spark, folder, "lineitem").select(
        _key("tto", "l_orderkey").alias("tconst"),
        F.col("l_linenumber").cast("string").alias("ordering"),
        _key("nmp", "l_partkey").alias("nconst"),
        F.when(flag == "A", "actor").when(flag == "R", "self").otherwise("editor").alias("category"),
        _marked(F.when(F.col("l_linestatus") == "F", "finished")).alias("job"),
        _marked(F.when(flag != "N", characters)).alias("characters"),
    )


def _title_crew(spark: SparkSession, folder: str) -> DataFrame:
    supplier, part = _key("nms", "l_suppkey"), _key("nmp", "l_partkey")
    finished = F.col("l_linestatus") == "F"
    return table(spark, folder, "lineitem").select(
        _key("tto", "l_orderkey").alias("tconst"),
        _marked(F.when(finished, F.concat_ws(",", supplier, part))).alias("directors"),
        _marked(F.when(~finished, supplier)).alias("writers"),
    )


def _title_ratings(spark: SparkSession, folder: str) -> DataFrame:
    returned = table(spark, folder, "lineitem").where(F.col("l_returnflag") == "R")
    totals = returned.groupBy("l_orderkey").agg(
        F.sum(F.col("l_quantity").cast("long")).alias("votes"), F.count("*").alias("lines")
    )
    tenths = F.expr("(votes * 21) div (lines * 10)")
    rating = F.concat_ws(".", F.expr("tenths div 10"), F.expr("tenths % 10"))
    return totals.withColumn("tenths", tenths).select(
        _key("tto", "l_orderkey").alias("tconst"),
        rating.alias("averageRating"),
        F.col("votes").cast("string").alias("numVotes"),
    )


def _name_basics(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size")
    parts = table(spark, folder, "part").select(
        _key("nmp", "p_partkey").alias("nconst"),
        _marked(F.when(size <= 45, F.col("p_name"))).alias("primaryName"),
        (size * 50).cast("string").alias("birthYear"),
        _marked(F.when(size < 30, size * 50 + 40)).alias("deathYear"),
        F.concat_ws(",", "p_brand", "p_type").alias("primaryProfession"),
        _marked(F.when(size >= 10, _key("ttc", "p_size"))).alias("knownForTitles"),
    )
    suppliers = table(spark, folder, "supplier").where(F.col("s_acctbal") > 0).select(
        _key("nms", "s_suppkey").alias("nconst"),
        F.col("s_name").alias("primaryName"),
        F.lit(NULL_TEXT).alias("birthYear"),
        F.lit(NULL_TEXT).alias("deathYear"),
        F.lit("supplier").alias("primaryProfession"),
        F.lit(NULL_TEXT).alias("knownForTitles"),
    )
    return parts.unionByName(suppliers)


def _title_akas(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    hour, minute = F.hour("ts"), F.minute("ts")
    return table(spark, folder, "events").select(
        _key("ttc", "user_id").alias("titleId"),
        (hour * 60 + minute).cast("string").alias("ordering"),
        F.concat(F.lit('"'), F.col("props")).alias("title"),
        _marked(F.when(kind != "error", F.concat(F.lit("R"), hour.cast("string")))).alias("region"),
        _marked(F.when(F.col("value") >= 10, F.lit("pt"))).alias("language"),
        _marked(F.when(kind != "click", F.concat(F.lit("alternative,,"), kind))).alias("types"),
        _marked(F.when(kind == "view", kind)).alias("attributes"),
        _marked(
            F.when(kind == "signup", "1").when(kind != "error", "0")
        ).alias("isOriginalTitle"),
    )


SHAPES = {
    "title_akas": _title_akas,
    "title_basics": _title_basics,
    "title_crew": _title_crew,
    "title_episode": _title_episode,
    "title_principals": _title_principals,
    "title_ratings": _title_ratings,
    "name_basics": _name_basics,
}


def text_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return SHAPES[name](spark, folder).select(*SOURCES[name].headers)


def raw_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    if name == "ingestion_files":
        return with_load_id(entries(spark, folder), LOAD)
    return with_load_id(text_table(spark, folder, name), LOAD)


class OnDemand(dict):
    """Tables by name, each defined when first asked for; definitions, not rows, are kept."""

    def __init__(self, derive: Callable[[str], DataFrame]):
        super().__init__()
        self._derive = derive

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._derive(name)
        return self[name]


@cache
def raw_tables(spark: SparkSession, folder: str) -> OnDemand:
    return OnDemand(lambda name: raw_table(spark, folder, name))


@cache
def staged_tables(spark: SparkSession, folder: str) -> OnDemand:
    raw = raw_tables(spark, folder)
    return OnDemand(lambda name: stage(name, raw[name]))


@cache
def models(spark: SparkSession, folder: str) -> OnDemand:
    staged = staged_tables(spark, folder)
    return OnDemand(lambda name: intermediate(name, staged))


@cache
def mart_tables(spark: SparkSession, folder: str) -> OnDemand:
    tables = models(spark, folder)
    return OnDemand(lambda name: mart(name, tables))


def entries(spark: SparkSession, folder: str) -> DataFrame:
    """A manifest entry per text table, measured on its rows."""
    listed = None
    for name, source in SOURCES.items():
        text = text_table(spark, folder, name)
        measured = text.agg(
            F.coalesce(F.sum(F.length(source.headers[0])), F.lit(0)).alias("size_bytes"),
            F.count("*").alias("row_count"),
        )
        counted = F.col("row_count").cast("string")
        entry = measured.select(
            F.lit(source.dataset).alias("dataset"),
            F.lit(source.file_name).alias("file_name"),
            F.lit(name).alias("table_name"),
            F.lit(source.url(BASE_URL)).alias("url"),
            "size_bytes",
            "row_count",
            F.sha2(F.concat_ws(":", F.lit(name), counted), 256).alias("sha256"),
            F.lit("2026-08-15T00:00:00+00:00").alias("downloaded_at"),
            F.concat(F.lit("batch-"), counted).alias("batch_id"),
            F.lit(None).cast("string").alias("etag"),
            F.lit(None).cast("string").alias("last_modified"),
            F.lit("application/gzip").alias("content_type"),
        )
        listed = entry if listed is None else listed.unionByName(entry)
    return listed


def write_text(rows: DataFrame, path: str) -> str:
    """Tab-separated gzip files with a header each, values exactly as they are."""
    rows.write.csv(
        path,
        sep="\t",
        header=True,
        compression="gzip",
        quote="",
        escape="",
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return path
