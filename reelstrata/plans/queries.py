"""Consumer queries over the marts.

Every ordering ends in the grain of its mart, so ties cannot change a result between runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstrata.operators import trigrams


def search_titles(title_search: DataFrame, pattern: str, limit: int = 25) -> DataFrame:
    """Most voted titles whose primary title matches an ILIKE pattern such as `%river%`."""
    return (
        title_search.where(F.col("primary_title").ilike(pattern))
        .orderBy(F.desc_nulls_last("num_votes"), F.asc("tconst"))
        .limit(limit)
        .select(
            "tconst", "primary_title", "start_year", "average_rating", "num_votes", "genres"
        )
    )


#: Candidates that are looked up by key; more of them are joined.
LOOKED_UP = 1_000


def search_titles_by_index(title_search: DataFrame, index: DataFrame, pattern: str, limit: int = 25) -> DataFrame:
    """What `search_titles` finds, reading only titles that have all trigrams of the pattern.

    Few candidates become a filter on the key that reaches the scan, where bloom filters leave out nearly every row group; many are
    joined. A pattern without three literal characters in a row is scanned for.
    """
    wanted = trigrams.needed(title_search.sparkSession, pattern)
    if not wanted:
        return search_titles(title_search, pattern, limit)
    near = trigrams.candidates(index, "tconst", wanted)
    keys = [row["tconst"] for row in near.limit(LOOKED_UP + 1).collect()]
    if len(keys) <= LOOKED_UP:
        return search_titles(title_search.where(F.col("tconst").isin(keys)), pattern, limit)
    return search_titles(title_search.join(near, "tconst", "left_semi"), pattern, limit)


def genre_over_time(summary: DataFrame, genre: str, first: int, last: int) -> DataFrame:
    """Yearly figures of one genre within an inclusive range of years."""
    return (
        summary.where((F.col("genre") == genre) & F.col("start_year").between(first, last))
        .orderBy(F.asc_nulls_last("start_year"), F.asc_nulls_last("title_type"))
        .select(
            "start_year", "title_count", "rated_title_count", "average_rating", "total_votes"
        )
    )


def filmography_of(filmography: DataFrame, nconst: str) -> DataFrame:
    """Credits of one person, latest first."""
    return (
        filmography.where(F.col("nconst") == nconst)
        .orderBy(F.desc_nulls_last("start_year"), F.asc_nulls_last("ordering"), F.asc("tconst"))
        .select("primary_name", "primary_title", "start_year", "category", "average_rating")
    )


def episodes_of(series_episodes: DataFrame, series_tconst: str) -> DataFrame:
    """Episodes of one series in season and episode order."""
    return (
        series_episodes.where(F.col("series_tconst") == series_tconst)
        .orderBy(
            F.asc_nulls_last("season_number"),
            F.asc_nulls_last("episode_number"),
            F.asc("episode_tconst"),
        )
        .select(
            "series_title", "season_number", "episode_number", "episode_title", "average_rating"
        )
    )


def top_titles(title_search: DataFrame, limit: int = 10) -> DataFrame:
    return (
        title_search.where(F.col("primary_title").isNotNull())
        .orderBy(F.desc_nulls_last("num_votes"), F.asc("tconst"))
        .limit(limit)
        .select("tconst", "primary_title", "average_rating", "genres")
    )


def top_genre_cells(summary: DataFrame, limit: int = 10) -> DataFrame:
    return (
        summary.where(F.col("genre").isNotNull())
        .orderBy(
            F.desc_nulls_last("total_votes"),
            F.asc("genre"),
            F.asc_nulls_last("start_year"),
            F.asc_nulls_last("title_type"),
        )
        .limit(limit)
        .select("genre", "start_year", "title_count", "average_rating")
    )


def top_credits(filmography: DataFrame, limit: int = 10) -> DataFrame:
    return (
        filmography.where(F.col("primary_name").isNotNull())
        .orderBy(
            F.desc_nulls_last("num_votes"), F.asc("nconst"), F.asc("tconst"), F.asc("ordering")
        )
        .limit(limit)
        .select("nconst", "primary_name", "tconst", "category")
    )


def top_episodes(series_episodes: DataFrame, limit: int = 10) -> DataFrame:
    return (
        series_episodes.orderBy(F.desc_nulls_last("num_votes"), F.asc("episode_tconst"))
        .limit(limit)
        .select("series_tconst", "episode_tconst", "season_number", "episode_number")
    )


# The columns a consumer needs to be able to read from each mart.
PROBES = {
    "mart_title_search": (
        "tconst", "primary_title", "average_rating", "genres", "directors", "principal_cast"
    ),
    "mart_genre_year_summary": (
        "genre", "start_year", "title_count", "rated_title_count", "total_votes"
    ),
    "mart_person_filmography": ("nconst", "tconst", "category", "characters"),
    "mart_series_episodes": ("series_tconst", "episode_tconst", "season_number", "episode_number"),
}


def probe(mart: str, rows: DataFrame) -> DataFrame:
    """Any one row of a mart, to prove that it can be read."""
    return rows.select(*PROBES[mart]).limit(1)
