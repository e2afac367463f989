"""The four marts and their contracts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstrata.functions.values import wide_total
from reelstrata.sources.registry import LOAD_ID

# Mart columns with their types, in order.
CONTRACTS = {
    "mart_title_search": (
        "tconst string, title_type string, primary_title string, original_title string, "
        "is_adult boolean, start_year smallint, end_year smallint, runtime_minutes int, "
        "average_rating double, num_votes bigint, genres array<string>, "
        f"directors array<string>, principal_cast array<string>, {LOAD_ID} string"
    ),
    "mart_genre_year_summary": (
        "start_year smallint, title_type string, genre string, title_count bigint, "
        "rated_title_count bigint, average_rating double, total_votes decimal(38,0)"
    ),
    "mart_person_filmography": (
        "nconst string, primary_name string, tconst string, primary_title string, "
        "title_type string, start_year smallint, ordering int, category string, job string, "
        "characters array<string>, average_rating double, num_votes bigint, "
        f"{LOAD_ID} string"
    ),
    "mart_series_episodes": (
        "series_tconst string, series_title string, episode_tconst string, "
        "episode_title string, season_number int, episode_number int, "
        "episode_start_year smallint, average_rating double, num_votes bigint, "
        f"{LOAD_ID} string"
    ),
}


class ContractError(ValueError):
    """A mart's columns differ from its contract in name, order or type."""


def contract(name: str) -> T.StructType:
    return T.StructType.fromDDL(CONTRACTS[name])


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(field.name, field.dataType.simpleString()) for field in schema]


def enforced(name: str, rows: DataFrame) -> DataFrame:
    """`rows` itself if it matches the contract exactly; nothing is cast, added or dropped."""
    if _shape(rows.schema) != _shape(contract(name)):
        raise ContractError(f"{name}: {rows.schema.simpleString()} breaks {CONTRACTS[name]}")
    return rows


def _measures(ratings: DataFrame) -> DataFrame:
    return ratings.select("tconst", "average_rating", "num_votes")


def title_search(
    titles: DataFrame,
    ratings: DataFrame,
    genre_lists: DataFrame,
    director_lists: DataFrame,
    cast_lists: DataFrame,
) -> DataFrame:
    """One row per title. All five inputs meet on one hash of the title key."""
    wide = titles.drop("genres").join(_measures(ratings), "tconst", "left")
    for lists in (genre_lists, director_lists, cast_lists):
        wide = wide.join(lists, "tconst", "left")
    return enforced("mart_title_search", wide.select(*contract("mart_title_search").names))


def genre_year_summary(genres: DataFrame, titles: DataFrame, ratings: DataFrame) -> DataFrame:
    described = titles.select("tconst", "start_year", "title_type")
    rated = (
        genres.select("tconst", "genre")
        .join(described, "tconst")
        .join(_measures(ratings), "tconst", "left")
    )
    summary = rated.groupBy("start_year", "title_type", "genre").agg(
        F.count("*").alias("title_count"),
        F.count("average_rating").alias("rated_title_count"),
        F.avg("average_rating").alias("average_rating"),
        wide_total(F.col("num_votes")).alias("total_votes"),
    )
    return enforced("mart_genre_year_summary", summary)


def person_filmography(
    credits: DataFrame, people: DataFrame, titles: DataFrame, ratings: DataFrame
) -> DataFrame:
    """Credits whose person and title are both known."""
    named = credits.join(people.select("nconst", "primary_name"), "nconst")
    described = titles.select("tconst", "primary_title", "title_type", "start_year")
    films = named.join(described, "tconst").join(_measures(ratings), "tconst", "left")
    name = "mart_person_filmography"
    return enforced(name, films.select(*contract(name).names))


def series_episodes(episodes: DataFrame, titles: DataFrame, ratings: DataFrame) -> DataFrame:
    """Episodes whose series and episode title are both known; titles join once per role."""
    series = titles.select(
        F.col("tconst").alias("series_tconst"), F.col("primary_title").alias("series_title")
    )
    episode = titles.select(
        F.col("tconst").alias("episode_tconst"),
        F.col("primary_title").alias("episode_title"),
        F.col("start_year").alias("episode_start_year"),
    )
    rated = _measures(ratings).withColumnRenamed("tconst", "episode_tconst")
    listed = (
        episodes.withColumnsRenamed({"tconst": "episode_tconst", "parent_tconst": "series_tconst"})
        .join(series, "series_tconst")
        .join(episode, "episode_tconst")
        .join(rated, "episode_tconst", "left")
    )
    name = "mart_series_episodes"
    return enforced(name, listed.select(*contract(name).names))


# Each mart with the intermediate models it reads.
MARTS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "mart_title_search": (
        title_search,
        (
            "dim_titles",
            "fct_title_ratings",
            "int_title_genre_lists",
            "int_title_director_lists",
            "int_title_principal_cast_lists",
        ),
    ),
    "mart_genre_year_summary": (
        genre_year_summary,
        ("bridge_title_genres", "dim_titles", "fct_title_ratings"),
    ),
    "mart_person_filmography": (
        person_filmography,
        ("bridge_title_credits", "dim_people", "dim_titles", "fct_title_ratings"),
    ),
    "mart_series_episodes": (
        series_episodes,
        ("fct_episodes", "dim_titles", "fct_title_ratings"),
    ),
}


def mart(name: str, models: Mapping[str, DataFrame]) -> DataFrame:
    """One mart over the intermediate models it needs."""
    build, inputs = MARTS[name]
    return build(*[models[i] for i in inputs])


def marts_all(models: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All four marts over the intermediate models."""
    return {name: mart(name, models) for name in MARTS}
