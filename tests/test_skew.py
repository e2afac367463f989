"""A third of all rows under one key: joins split it, group steps combine it before they shuffle."""

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from reelstrata.operators.lists import distinct_list, ordered_list
from reelstrata.plans import intermediate, marts

ROWS = 60_000
SMALL = {
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skew")
    before = {key: spark.conf.get(key, None) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)

    def hot(prefix, spread):
        rest = F.concat(F.lit(prefix), (F.col("id") % spread).cast("string"))
        return F.when(F.col("id") % 3 == 0, F.lit(f"{prefix}0")).otherwise(rest)

    frames = {
        "credits": spark.range(0, ROWS, 1, 8).select(
            hot("t", 5000).alias("tconst"),
            F.col("id").cast("int").alias("ordering"),
            hot("n", 3000).alias("nconst"),
            F.lit("actor").alias("category"),
            F.sha2(F.col("id").cast("string"), 256).alias("job"),
            F.array(F.lit("x")).alias("characters"),
            F.lit("load").alias("_load_id"),
        ),
        "titles": spark.range(5000).select(
            F.concat(F.lit("t"), "id").alias("tconst"),
            F.lit("movie").alias("title_type"),
            F.concat(F.lit("T"), "id").alias("primary_title"),
            F.lit(2000).cast("smallint").alias("start_year"),
        ),
        "ratings": spark.range(0, 5000, 2).select(
            F.concat(F.lit("t"), "id").alias("tconst"),
            F.lit(5.0).alias("average_rating"),
            F.col("id").alias("num_votes"),
        ),
        "people": spark.range(3000).select(
            F.concat(F.lit("n"), "id").alias("nconst"),
            F.concat(F.lit("N"), (F.col("id") % 40).cast("string")).alias("primary_name"),
        ),
    }
    stored = {}
    for name, rows in frames.items():
        rows.write.parquet(str(folder / name))
        stored[name] = spark.read.parquet(str(folder / name))
    yield stored
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def final_plan(rows):
    rows.collect()
    return rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_person_and_title_are_split_in_every_join(tables):
    films = marts.person_filmography(
        tables["credits"], tables["people"], tables["titles"], tables["ratings"]
    )
    assert final_plan(films).count("SortMergeJoin(skew=true)") == 3
    assert films.count() == ROWS
    hot = films.where("tconst = 't0' and nconst = 'n0'")
    assert hot.count() == tables["credits"].where("tconst = 't0' and nconst = 'n0'").count()


def test_hot_series_is_split(tables):
    episodes = tables["credits"].select(
        "tconst",
        F.concat(F.lit("t"), F.substring("nconst", 2, 9)).alias("parent_tconst"),
        F.lit(1).alias("season_number"),
        F.col("ordering").alias("episode_number"),
        F.col("job").alias("_load_id"),
    )
    listed = marts.series_episodes(episodes, tables["titles"], tables["ratings"])
    assert "SortMergeJoin(skew=true)" in final_plan(listed)
    assert listed.count() == ROWS


def test_rollups_of_a_hot_title_equal_brute_force(tables):
    got = dict(rows_of(intermediate.title_principal_cast_lists(tables["credits"], tables["people"])))
    names = dict(rows_of(tables["people"].select("nconst", "primary_name")))
    wanted = {}
    for tconst, nconst in rows_of(tables["credits"].select("tconst", "nconst")):
        wanted.setdefault(tconst, set()).add(names.get(nconst, nconst))
    assert got == {key: sorted(values) for key, values in wanted.items()}


def test_repeats_of_a_hot_key_are_combined_before_the_list_is_built(tables):
    rows = tables["credits"].select("tconst", "category")
    lists = ordered_list(rows, "tconst", "category", "all")
    plan = final_plan(lists)
    assert "partial_count" in plan
    sizes = dict(rows_of(lists.select("tconst", F.size("all"))))
    assert sizes == dict(rows_of(rows.groupBy("tconst").count()))
    one = distinct_list(rows, "tconst", "category", "all")
    assert {tuple(r["all"]) for r in one.collect()} == {("actor",)}
