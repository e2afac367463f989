"""A training corpus from raw documents: language, quality, near copies, mixture, pieces.

Every stage takes the Spark session, the documents its predecessor kept, and the folder of the given tables; all but
the last return documents with their columns as they came. Between stages the documents are written as Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelstrata.llm import langid, mixing, ngram_join, pieces, quality
from reelstrata.llm.common import documents, ship, stored

#: Words of a shingle and percent of likeness from which documents are near copies.
SHINGLE, PERCENT = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language stays unclear, go."""
    ship(spark)
    return langid.keep_known(docs, langid.fit(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or have too few words in content lines, go."""
    ship(spark)
    return quality.keep_good(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays."""
    ship(spark)
    return ngram_join.keep_one(docs, SHINGLE, PERCENT)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents appear as often as the mixture has them."""
    return mixing.mix_documents(docs)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece ids, their number, and whether they decode to the text."""
    ship(spark)
    return pieces.encode(docs, pieces.vocabulary(spark))


STAGES = [
    ("language ID", language_id),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", source_mixture),
    ("SentencePiece encoding and decoding", piece_encoding),
]

#: The network, the random field and the vocabulary are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"stage{number}")
    return docs
