"""The declared checks of every layer, and the gate that stops a bad build."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstrata.operators import checks
from reelstrata.operators.profile import Domain, key_profile, repeated_grains
from reelstrata.plans.intermediate import ROLLUPS
from reelstrata.plans.marts import CONTRACTS, contract
from reelstrata.plans.staging import COLUMNS
from reelstrata.sources.registry import LOAD_ID, SOURCES

Relations = Mapping[str, Mapping[str, DataFrame]]

# Columns that must not be NULL, per layer and relation.
NOT_NULL = {
    "staging": {
        "title_akas": ("title_id", "ordering", LOAD_ID),
        "title_basics": ("tconst", LOAD_ID),
        "title_crew": ("tconst", LOAD_ID),
        "title_episode": ("tconst", "parent_tconst", LOAD_ID),
        "title_principals": ("tconst", "ordering", "nconst", LOAD_ID),
        "title_ratings": ("tconst", "average_rating", "num_votes", LOAD_ID),
        "name_basics": ("nconst", LOAD_ID),
        "ingestion_files": (
            "table_name", "file_name", "size_bytes", "sha256", "batch_id", LOAD_ID
        ),
    },
    "intermediate": {
        "dim_titles": ("tconst", LOAD_ID),
        "dim_people": ("nconst", LOAD_ID),
        "fct_title_ratings": ("tconst", LOAD_ID),
        "fct_episodes": ("tconst", "parent_tconst", LOAD_ID),
        "bridge_title_genres": ("tconst", "genre", LOAD_ID),
        "bridge_title_credits": (LOAD_ID,),
        "bridge_title_crew": (LOAD_ID,),
        "bridge_title_akas": (LOAD_ID,),
        "int_title_genre_lists": ("tconst", "genres"),
        "int_title_director_lists": ("tconst", "directors"),
        "int_title_principal_cast_lists": ("tconst", "principal_cast"),
    },
    "marts": {
        "mart_title_search": ("tconst", LOAD_ID),
        "mart_genre_year_summary": (
            "genre", "title_count", "rated_title_count", "total_votes"
        ),
        "mart_person_filmography": ("nconst", "tconst", "ordering", LOAD_ID),
        "mart_series_episodes": ("series_tconst", "episode_tconst", LOAD_ID),
    },
}

# Single-column keys, per layer and relation.
UNIQUE = {
    "staging": {
        "title_basics": "tconst",
        "title_crew": "tconst",
        "title_episode": "tconst",
        "title_ratings": "tconst",
        "name_basics": "nconst",
        "ingestion_files": "table_name",
    },
    "intermediate": {
        "dim_titles": "tconst",
        "dim_people": "nconst",
        "fct_title_ratings": "tconst",
        "fct_episodes": "tconst",
        "int_title_genre_lists": "tconst",
        "int_title_director_lists": "tconst",
        "int_title_principal_cast_lists": "tconst",
    },
    "marts": {"mart_title_search": "tconst", "mart_series_episodes": "episode_tconst"},
}

# Parent with its key, and the child columns that refer to it.
RELATIONSHIPS = {
    ("dim_titles", "tconst"): (
        ("fct_title_ratings", "tconst"),
        ("fct_episodes", "tconst"),
        ("fct_episodes", "parent_tconst"),
        ("bridge_title_genres", "tconst"),
        ("bridge_title_credits", "tconst"),
        ("bridge_title_crew", "tconst"),
        ("bridge_title_akas", "tconst"),
        ("int_title_genre_lists", "tconst"),
        ("int_title_director_lists", "tconst"),
        ("int_title_principal_cast_lists", "tconst"),
    ),
    ("dim_people", "nconst"): (
        ("bridge_title_credits", "nconst"),
        ("bridge_title_crew", "nconst"),
    ),
}

# A parent key and all columns that refer to it are profiled together.
DOMAINS = tuple(
    Domain(parent, ((parent, field), *children)) for (parent, field), children in RELATIONSHIPS.items()
)
LINKS = [f"{child}.{column}" for children in RELATIONSHIPS.values() for child, column in children]

# Composite keys of the bridges and grains of the marts.
BRIDGE_KEYS = {
    "bridge_title_akas": ("tconst", "ordering"),
    "bridge_title_credits": ("tconst", "ordering"),
    "bridge_title_genres": ("tconst", "genre"),
    "bridge_title_crew": ("tconst", "crew_role", "nconst"),
}
MART_GRAINS = {
    "mart_title_search": ("tconst",),
    "mart_genre_year_summary": ("start_year", "title_type", "genre"),
    "mart_person_filmography": ("nconst", "tconst", "ordering"),
    "mart_series_episodes": ("episode_tconst",),
}

# Which staging table each dimension and fact must equal in row count.
RECONCILED = {
    "dim_titles": "title_basics",
    "dim_people": "name_basics",
    "fct_title_ratings": "title_ratings",
    "fct_episodes": "title_episode",
}

# Accepted texts of the raw adult flag.
ADULT_FLAGS = ("0", "1", "\\N")

REQUIRED = {
    "raw": tuple(sorted([*SOURCES, "ingestion_files"])),
    "staging": tuple(sorted(COLUMNS)),
    "intermediate": tuple(
        sorted([*RECONCILED, *BRIDGE_KEYS, *ROLLUPS]),
    ),
    "marts": tuple(sorted(CONTRACTS)),
}


class AuditError(RuntimeError):
    """At least one check of a layer found violations."""


def null_findings(layer: str, tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    return [
        checks.not_null(tables[name], name, columns)
        for name, columns in NOT_NULL[layer].items()
    ]


def unique_findings(layer: str, tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    return [
        checks.unique(tables[name], name, column) for name, column in UNIQUE[layer].items()
    ]


def links(profile: DataFrame) -> DataFrame:
    """The rows of a profile that are declared relationships."""
    link = F.concat_ws(".", "relation", "column_name")
    return profile.withColumn("link", link).where(F.col("domain").isNotNull() & F.col("link").isin(LINKS))


def relationship_metrics(models: Mapping[str, DataFrame]) -> DataFrame:
    """Child rows, orphans and their share for each declared relationship, from one profile of the keys."""
    return links(key_profile(models, DOMAINS)).select(
        "link",
        "child_rows",
        "orphan_rows",
        (F.col("orphan_rows").cast("double") / F.nullif("child_rows", F.lit(0))).alias("orphan_ratio"),
        F.lit(float(checks.MAX_ORPHAN_RATIO)).alias("maximum_orphan_ratio"),
    )


def relationship_findings(models: Mapping[str, DataFrame]) -> DataFrame:
    found = checks.too_many_orphans(links(key_profile(models, DOMAINS)))
    detail = F.concat_ws(" of ", F.col("orphan_rows"), F.col("child_rows"))
    return found.select(*checks.violation("orphan_ratio", F.col("link"), F.col("parent_key"), detail))


def bridge_findings(models: Mapping[str, DataFrame]) -> DataFrame:
    """Repeated composite keys of the four bridges, labelled by what completes the title key."""
    crew = F.concat(F.col("crew_role"), F.lit(":"), F.col("nconst"))
    parts = []
    for name, keys in BRIDGE_KEYS.items():
        rest = crew if name == "bridge_title_crew" else F.col(keys[1]).cast("string")
        label = F.concat_ws("|", F.col("tconst"), rest)
        parts.append(checks.duplicate_keys(models[name], name, keys, label=label))
    return checks.union_all(parts)


def grain_findings(marts: Mapping[str, DataFrame]) -> DataFrame:
    return checks.union_all(
        [checks.duplicate_keys(marts[name], name, keys) for name, keys in MART_GRAINS.items()]
    )


def ranges() -> dict[str, tuple[str, str, Column]]:
    """Key, label and condition of the rows of a staging table that are outside its fixed limits."""
    titles = (
        checks.outside("start_year", 1870, 2200)
        | checks.outside("end_year", 1870, 2200)
        | (F.col("runtime_minutes") < 0)
    )
    ratings = checks.outside("average_rating", 0, 10) | (F.col("num_votes") < 0)
    people = checks.outside("birth_year", 1, 2200) | checks.outside("death_year", 1, 2200)
    return {
        "title_basics": ("tconst", "title year or runtime", titles),
        "title_ratings": ("tconst", "rating or votes", ratings),
        "name_basics": ("nconst", "person year", people),
    }


def range_findings(staged: Mapping[str, DataFrame]) -> DataFrame:
    """Years, runtimes, ratings and votes outside their fixed limits."""
    return checks.union_all(
        [
            checks.out_of_range(staged[table], table, key, label, condition)
            for table, (key, label, condition) in ranges().items()
        ]
    )


def raw_schema_findings(spark: SparkSession, raw: Mapping[str, DataFrame]) -> DataFrame:
    """Raw tables whose columns are not exactly the registered headers, all text, and the load."""
    return checks.union_all(
        [
            checks.schema_violations(
                spark, name, raw[name].schema, source.schema.add(LOAD_ID, "string")
            )
            for name, source in SOURCES.items()
        ]
    )


def contract_findings(spark: SparkSession, marts: Mapping[str, DataFrame]) -> DataFrame:
    """Marts, as they are stored, that differ from their contract."""
    return checks.union_all(
        [
            checks.schema_violations(spark, name, marts[name].schema, contract(name))
            for name in CONTRACTS
        ]
    )


def lineage_findings(raw: Mapping[str, DataFrame]) -> DataFrame:
    return checks.union_all(
        [
            checks.without_lineage(raw[name], name, raw["ingestion_files"], name, LOAD_ID)
            for name in SOURCES
        ]
    )


def staging_findings(relations: Relations) -> DataFrame:
    raw, staged = relations["raw"], relations["staging"]
    flags = checks.not_accepted(
        raw["title_basics"], "title_basics", "tconst", "isAdult", ADULT_FLAGS
    )
    counted = checks.count_mismatch(
        {name: (raw[name], staged[name]) for name in COLUMNS}, "raw", "staging"
    )
    return checks.union_all(
        [
            flags,
            counted,
            range_findings(staged),
            lineage_findings(raw),
            *null_findings("staging", staged),
            *unique_findings("staging", staged),
        ]
    )


def intermediate_findings(relations: Relations) -> DataFrame:
    staged, models = relations["staging"], relations["intermediate"]
    counted = checks.count_mismatch(
        {name: (models[name], staged[table]) for name, table in RECONCILED.items()},
        "model",
        "staging",
    )
    return checks.union_all(
        [
            counted,
            bridge_findings(models),
            relationship_findings(models),
            *null_findings("intermediate", models),
            *unique_findings("intermediate", models),
        ]
    )


def mart_findings(relations: Relations) -> DataFrame:
    marts = relations["marts"]
    return checks.union_all(
        [
            grain_findings(marts),
            *null_findings("marts", marts),
            *unique_findings("marts", marts),
        ]
    )


def null_measures(columns: Sequence[str]) -> list[tuple[str, Column, Column]]:
    return [("not_null", F.lit(c), F.count_if(F.col(c).isNull())) for c in columns]


def staging_totals(relations: Relations) -> DataFrame:
    """What the staging checks find in total, from one aggregate of each raw and staged table and one
    grouping of each key. The counts of a raw table read its load column only."""
    raw, staged = relations["raw"], relations["staging"]
    files = raw["ingestion_files"].where(F.col(LOAD_ID).isNotNull())
    parts = [
        files.select(
            F.col("table_name").alias("relation"),
            F.lit("lineage").alias("check"),
            F.col(LOAD_ID).alias("item"),
            F.lit(None).cast("long").alias("value"),
        )
    ]
    for name in COLUMNS:
        landed = [("rows_raw_staging", None, F.count("*"))]
        if name in SOURCES:
            landed.append(("lineage", F.col(LOAD_ID), F.count("*")))
        if name == "title_basics":
            flagged = F.count_if(~F.col("isAdult").isin(*ADULT_FLAGS))
            landed.append(("accepted_values", None, flagged))
        typed = [("rows_raw_staging", None, -F.count("*")), *null_measures(NOT_NULL["staging"][name])]
        if name in ranges():
            _, label, condition = ranges()[name]
            typed.append(("value_range", F.lit(label), F.count_if(condition)))
        parts += [checks.tally(raw[name], name, landed, [LOAD_ID]), checks.tally(staged[name], name, typed)]
    for name, column in UNIQUE["staging"].items():
        parts.append(checks.key_tally(staged[name], name, [column], ["unique"]))
    return checks.fired(checks.union_all(parts))


def profile_tallies(profile: DataFrame) -> DataFrame:
    """What a profile of the models says about missing and repeated keys, rows and orphans, as `tally` rows."""
    layer = "intermediate"
    column = F.concat_ws(".", "relation", "column_name")
    required = [f"{name}.{c}" for name, columns in NOT_NULL[layer].items() for c in columns]
    single = [f"{name}.{c}" for name, c in UNIQUE[layer].items()]
    counted = [f"{name}.{UNIQUE[layer][name]}" for name in RECONCILED]

    def entry(check: str, asked: Column, value: Column, relation: Column, item: Column) -> Column:
        fields = [F.lit(check).alias("check"), item.cast("string").alias("item"), value.cast("long").alias("value")]
        return F.when(asked, F.struct(relation.alias("relation"), *fields))

    none, relation = F.lit(None), F.col("relation")
    keyed = F.col("domain").isNotNull()
    lost = keyed & column.isin(LINKS) & checks.above_limit()
    return profile.select(
        F.inline(
            F.array(
                entry("not_null", column.isin(required), F.col("null_rows"), relation, F.col("column_name")),
                entry("unique", keyed & column.isin(single), F.col("repeated_keys"), relation, none),
                entry("rows_model_staging", keyed & column.isin(counted), F.col("row_count"), relation, none),
                entry("orphan_ratio", lost, F.lit(1), column, none),
            )
        )
    ).where("relation IS NOT NULL")


def intermediate_totals(relations: Relations) -> DataFrame:
    """What the intermediate checks find in total: every model is read once for the profile of its keys, the bridges
    once more for their grains."""
    staged, models = relations["staging"], relations["intermediate"]
    found = key_profile(models, DOMAINS, NOT_NULL["intermediate"])
    parts = [profile_tallies(found)]
    for name, table in RECONCILED.items():
        parts.append(checks.tally(staged[table], name, [("rows_model_staging", None, -F.count("*"))]))
    grains = repeated_grains(models, BRIDGE_KEYS).select(F.lit("grain").alias("check"), "relation", "findings")
    return checks.union_all([checks.fired(checks.union_all(parts)), grains])


def mart_totals(relations: Relations) -> DataFrame:
    """What the mart checks find in total; a grain that is also a unique key is grouped once."""
    marts = relations["marts"]
    parts = []
    for name, keys in MART_GRAINS.items():
        names = ["grain", "unique"] if (UNIQUE["marts"].get(name),) == keys else ["grain"]
        parts.append(checks.key_tally(marts[name], name, keys, names))
        parts.append(checks.tally(marts[name], name, null_measures(NOT_NULL["marts"][name])))
    return checks.fired(checks.union_all(parts))


TOTALS = {
    "staging": staging_totals,
    "intermediate": intermediate_totals,
    "marts": mart_totals,
}


def totals(findings: DataFrame) -> DataFrame:
    """`check, relation, findings`: one row per check that fired."""
    return findings.groupBy("check", "relation").agg(F.count("*").alias("findings"))


def gate(layer: str, found: DataFrame) -> None:
    """Raise if any check fired, naming checks and counts (one small row per check)."""
    fired = found.collect()
    if fired:
        rows = sorted((r["check"], r["relation"], r["findings"]) for r in fired)
        listed = "; ".join(f"{check} on {relation}: {n}" for check, relation, n in rows)
        raise AuditError(f"{layer}: {listed}")


def audit(layer: str, relations: Relations) -> None:
    gate(layer, TOTALS[layer](relations))


def required_relations(spark: SparkSession) -> DataFrame:
    rows = [(schema, name) for schema, names in REQUIRED.items() for name in names]
    return spark.createDataFrame(rows, "schema string, name string")


def found_relations(spark: SparkSession) -> DataFrame:
    """Relations registered as `<schema>__<name>` views."""
    tables = spark.sql("SHOW VIEWS").select(F.split("viewName", "__", 2).alias("part"))
    return tables.where(F.size("part") == 2).select(
        F.col("part")[0].alias("schema"), F.col("part")[1].alias("name")
    )


def register(relations: Relations) -> None:
    """Expose relations as temporary views `<schema>__<name>`; views that an earlier build left go."""
    for schema, names in REQUIRED.items():
        for rows in relations.get(schema, {}).values():
            for name in names:
                rows.sparkSession.catalog.dropTempView(f"{schema}__{name}")
            break
    for schema, tables in relations.items():
        for name, rows in tables.items():
            rows.createOrReplaceTempView(f"{schema}__{name}")
