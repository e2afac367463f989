"""Dimensions, facts, bridges and the per-title list rollups."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstrata.operators.bridges import exploded, named, tagged_union
from reelstrata.operators.lists import distinct_list
from reelstrata.sources.registry import LOAD_ID

# Fixed value: credit categories that count as principal cast.
CAST_CATEGORIES = ("actor", "actress", "self")

ROLLUPS = ("int_title_genre_lists", "int_title_director_lists", "int_title_principal_cast_lists")


def dim_titles(title_basics: DataFrame) -> DataFrame:
    return title_basics.select(
        "tconst",
        "title_type",
        "primary_title",
        "original_title",
        "is_adult",
        "start_year",
        "end_year",
        "runtime_minutes",
        "genres",
        LOAD_ID,
    )


def dim_people(name_basics: DataFrame) -> DataFrame:
    return name_basics.select(
        "nconst",
        "primary_name",
        "birth_year",
        "death_year",
        "primary_professions",
        "known_for_titles",
        LOAD_ID,
    )


def fct_title_ratings(title_ratings: DataFrame) -> DataFrame:
    return title_ratings.select("tconst", "average_rating", "num_votes", LOAD_ID)


def fct_episodes(title_episode: DataFrame) -> DataFrame:
    return title_episode.select(
        "tconst", "parent_tconst", "season_number", "episode_number", LOAD_ID
    )


def bridge_title_genres(title_basics: DataFrame) -> DataFrame:
    return exploded(title_basics.select("tconst", LOAD_ID, "genres"), "genres", "genre")


def bridge_title_credits(title_principals: DataFrame) -> DataFrame:
    return title_principals.select(
        "tconst", "ordering", "nconst", "category", "job", "characters", LOAD_ID
    )


def bridge_title_crew(title_crew: DataFrame) -> DataFrame:
    crew = tagged_union(
        title_crew,
        "crew_role",
        {"director": "directors", "writer": "writers"},
        "nconst",
        ["tconst", LOAD_ID],
    )
    return crew.select("tconst", "crew_role", "nconst", LOAD_ID)


def bridge_title_akas(title_akas: DataFrame) -> DataFrame:
    return title_akas.withColumnRenamed("title_id", "tconst").select(
        "tconst",
        "ordering",
        "title",
        "region",
        "language",
        "types",
        "attributes",
        "is_original_title",
        LOAD_ID,
    )


def title_genre_lists(title_basics: DataFrame) -> DataFrame:
    """The array of a title in order; staging has proven that a title has one row, so nothing is shuffled."""
    listed = title_basics.where(F.size("genres") > 0)
    return listed.select("tconst", F.array_sort("genres").alias("genres"))


def title_director_lists(crew: DataFrame, people: DataFrame) -> DataFrame:
    directors = crew.where(crew["crew_role"] == "director").select("tconst", "nconst")
    shown = named(directors, people, "nconst", "primary_name", "shown_name")
    return distinct_list(shown, "tconst", "shown_name", "directors")


def title_principal_cast_lists(credits: DataFrame, people: DataFrame) -> DataFrame:
    cast = credits.where(credits["category"].isin(*CAST_CATEGORIES)).select("tconst", "nconst")
    shown = named(cast, people, "nconst", "primary_name", "shown_name")
    return distinct_list(shown, "tconst", "shown_name", "principal_cast")


# Each model with the staging tables or models it reads.
MODELS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "dim_titles": (dim_titles, ("title_basics",)),
    "dim_people": (dim_people, ("name_basics",)),
    "fct_title_ratings": (fct_title_ratings, ("title_ratings",)),
    "fct_episodes": (fct_episodes, ("title_episode",)),
    "bridge_title_genres": (bridge_title_genres, ("title_basics",)),
    "bridge_title_credits": (bridge_title_credits, ("title_principals",)),
    "bridge_title_crew": (bridge_title_crew, ("title_crew",)),
    "bridge_title_akas": (bridge_title_akas, ("title_akas",)),
    "int_title_genre_lists": (title_genre_lists, ("title_basics",)),
    "int_title_director_lists": (title_director_lists, ("bridge_title_crew", "dim_people")),
    "int_title_principal_cast_lists": (
        title_principal_cast_lists,
        ("bridge_title_credits", "dim_people"),
    ),
}


def intermediate(name: str, staged: Mapping[str, DataFrame]) -> DataFrame:
    """One intermediate model over the staging tables it needs."""
    build, inputs = MODELS[name]
    return build(*[intermediate(i, staged) if i in MODELS else staged[i] for i in inputs])


def intermediate_all(staged: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All eleven intermediate models over the staging models."""
    return {name: intermediate(name, staged) for name in MODELS}
