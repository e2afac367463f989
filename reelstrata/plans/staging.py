"""Typed staging models, all derived from one column map."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstrata.functions import values
from reelstrata.sources.registry import FILE_COLUMNS, LOAD_ID

# Raw column, staging column, kind. `key` text is taken as is; every other kind
# reads the null marker as NULL first.
COLUMNS: dict[str, tuple[tuple[str, str, str], ...]] = {
    "title_akas": (
        ("titleId", "title_id", "key"),
        ("ordering", "ordering", "int"),
        ("title", "title", "string"),
        ("region", "region", "string"),
        ("language", "language", "string"),
        ("isOriginalTitle", "is_original_title", "boolean"),
        ("types", "types", "list"),
        ("attributes", "attributes", "list"),
    ),
    "title_basics": (
        ("tconst", "tconst", "key"),
        ("titleType", "title_type", "string"),
        ("primaryTitle", "primary_title", "string"),
        ("originalTitle", "original_title", "string"),
        ("isAdult", "is_adult", "boolean"),
        ("startYear", "start_year", "smallint"),
        ("endYear", "end_year", "smallint"),
        ("runtimeMinutes", "runtime_minutes", "int"),
        ("genres", "genres", "list"),
    ),
    "title_crew": (
        ("tconst", "tconst", "key"),
        ("directors", "directors", "list"),
        ("writers", "writers", "list"),
    ),
    "title_episode": (
        ("tconst", "tconst", "key"),
        ("parentTconst", "parent_tconst", "key"),
        ("seasonNumber", "season_number", "int"),
        ("episodeNumber", "episode_number", "int"),
    ),
    "title_principals": (
        ("tconst", "tconst", "key"),
        ("ordering", "ordering", "int"),
        ("nconst", "nconst", "key"),
        ("category", "category", "string"),
        ("job", "job", "string"),
        ("characters", "characters", "json"),
    ),
    "title_ratings": (
        ("tconst", "tconst", "key"),
        ("averageRating", "average_rating", "double"),
        ("numVotes", "num_votes", "bigint"),
    ),
    "name_basics": (
        ("nconst", "nconst", "key"),
        ("primaryName", "primary_name", "string"),
        ("birthYear", "birth_year", "smallint"),
        ("deathYear", "death_year", "smallint"),
        ("primaryProfession", "primary_professions", "list"),
        ("knownForTitles", "known_for_titles", "list"),
    ),
    # The counted rows of a file stay in the raw table only.
    "ingestion_files": tuple(
        (name, name, "bigint" if kind == "long" else "key")
        for name, (kind, _) in FILE_COLUMNS.items()
        if name != "row_count"
    ),
}


def _staged(raw: str, name: str, kind: str) -> Column:
    column = F.col(raw)
    if kind == "key":
        staged = column.cast("string")
    elif kind == "list":
        staged = values.split_list(column)
    elif kind == "json":
        staged = values.json_strings(column)
    else:
        staged = values.typed(column, kind)
    return staged.alias(name)


def stage(table: str, raw: DataFrame) -> DataFrame:
    """The typed rows of one raw table with its load lineage."""
    if table == "ingestion_files":
        columns = [F.col(n).cast(k if k != "key" else "string") for _, n, k in COLUMNS[table]]
    else:
        columns = [_staged(*column) for column in COLUMNS[table]]
    return raw.select(*columns, F.col(LOAD_ID).cast("string").alias(LOAD_ID))


def stage_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {table: stage(table, rows) for table, rows in raw.items()}
