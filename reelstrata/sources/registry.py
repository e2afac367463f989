"""The seven source files, their tables and their exact headers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LOAD_ID = "_load_id"


@dataclass(frozen=True)
class Source:
    table_name: str
    dataset: str
    file_name: str
    headers: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, T.StringType()) for name in self.headers])

    @property
    def header_line(self) -> str:
        return "\t".join(self.headers)

    def url(self, base_url: str) -> str:
        return f"{base_url.rstrip('/')}/{self.file_name}"


# Table, source name, file name and headers in file order.
_FIXED = (
    (
        "title_akas",
        "alternate titles",
        "title.akas.tsv.gz",
        "titleId ordering title region language types attributes isOriginalTitle",
    ),
    (
        "title_basics",
        "title basics",
        "title.basics.tsv.gz",
        "tconst titleType primaryTitle originalTitle isAdult startYear endYear runtimeMinutes genres",
    ),
    ("title_crew", "title crew", "title.crew.tsv.gz", "tconst directors writers"),
    (
        "title_episode",
        "episodes",
        "title.episode.tsv.gz",
        "tconst parentTconst seasonNumber episodeNumber",
    ),
    (
        "title_principals",
        "principal credits",
        "title.principals.tsv.gz",
        "tconst ordering nconst category job characters",
    ),
    ("title_ratings", "title ratings", "title.ratings.tsv.gz", "tconst averageRating numVotes"),
    (
        "name_basics",
        "people",
        "name.basics.tsv.gz",
        "nconst primaryName birthYear deathYear primaryProfession knownForTitles",
    ),
)

SOURCES = {
    table: Source(table, dataset, file_name, tuple(headers.split()))
    for table, dataset, file_name, headers in _FIXED
}

# Columns of the file lineage table, in order; True marks those that may be NULL.
FILE_COLUMNS = {
    "dataset": ("string", False),
    "file_name": ("string", False),
    "table_name": ("string", False),
    "url": ("string", False),
    "size_bytes": ("long", False),
    "row_count": ("long", True),
    "sha256": ("string", False),
    "downloaded_at": ("string", False),
    "batch_id": ("string", False),
    "etag": ("string", True),
    "last_modified": ("string", True),
    "content_type": ("string", True),
}

FILE_SCHEMA = T.StructType(
    [
        T.StructField(name, T.LongType() if kind == "long" else T.StringType(), nullable)
        for name, (kind, nullable) in FILE_COLUMNS.items()
    ]
)


def registry_frame(spark: SparkSession, base_url: str) -> DataFrame:
    """One row per registered source, the side every manifest is compared with."""
    return spark.createDataFrame(
        [(s.table_name, s.dataset, s.file_name, s.url(base_url)) for s in SOURCES.values()],
        "table_name string, dataset string, file_name string, url string",
    )
