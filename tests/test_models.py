import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows_of
from reelstrata.operators.bridges import exploded, named, tagged_union
from reelstrata.operators.lists import distinct_list, ordered_list
from reelstrata.plans import intermediate, marts, queries
from reelstrata.plans.staging import COLUMNS, stage
from reelstrata.sources.registry import LOAD_ID, SOURCES

KINDS = {
    "title_akas": "string int string string string boolean array<string> array<string>",
    "title_basics": "string string string string boolean smallint smallint int array<string>",
    "title_crew": "string array<string> array<string>",
    "title_episode": "string string int int",
    "title_principals": "string int string string string array<string>",
    "title_ratings": "string double bigint",
    "name_basics": "string string smallint smallint array<string> array<string>",
}


def raw(spark, name, *rows):
    headers = [*SOURCES[name].headers, LOAD_ID]
    return spark.createDataFrame(
        [(*row, "load") for row in rows], ", ".join(f"`{h}` string" for h in headers)
    )


def staged(spark, name, *rows):
    return stage(name, raw(spark, name, *rows))


@pytest.mark.parametrize("name", SOURCES)
def test_staging_types(spark, name):
    got = [kind for _, kind in staged(spark, name).dtypes]
    assert got == [*KINDS[name].split(), "string"]
    assert [c for _, c, _ in COLUMNS[name]] == staged(spark, name).columns[:-1]


def test_marker_and_empty_text(spark):
    rows = staged(spark, "title_basics", ("\\N", "\\N", "", "\\N", "1", "2020", "\\N", "\\N", ""))
    assert rows_of(rows) == [("\\N", None, "", None, True, 2020, None, None, [""], "load")]


def test_list_pieces_are_kept(spark):
    rows = staged(spark, "title_crew", ("t", "a,,b,", "\\N"))
    assert rows_of(rows) == [("t", ["a", "", "b", ""], None, "load")]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("\\N", None),
        ('["Pit boss"]', ["Pit boss"]),
        ("[]", []),
        ('["a",1,null,true,[1,"2"]]', ["a", "1", None, "true", '[1,"2"]']),
        ('[1.0, -0.0, 1.10]', ["1.0", "-0.0", "1.1"]),
        ('["a, 5", "[3]"]', ["a, 5", "[3]"]),
        ('[{"z": 1, "a" : [2.0]}]', ['{"z":1,"a":[2.0]}']),
        ("7.0", None),
        ('{"a":1}', None),
        ('"s"', None),
    ],
)
def test_json_arrays(spark, text, expected):
    rows = staged(spark, "title_principals", ("t", "1", "n", "\\N", "\\N", text))
    assert rows_of(rows.select("characters")) == [(expected,)]


@pytest.mark.parametrize(
    ("name", "row"),
    [
        ("title_principals", ("t", "1", "n", "c", "j", "[bad")),
        ("title_principals", ("t", "1", "n", "c", "j", "[1.0")),
        ("title_principals", ("t", "1", "n", "c", "j", "['a', 1]")),
        ("title_principals", ("t", "1", "n", "c", "j", "[01]")),
        ("title_principals", ("t", "1", "n", "c", "j", "[NaN, 1]")),
        ("title_basics", ("t", "a", "b", "c", "0", "32767.5", "1", "1", "g")),
        ("title_basics", ("t", "a", "b", "c", "0", "1e", "1", "1", "g")),
        ("title_principals", ("t", "x", "n", "c", "j", "[]")),
        ("title_episode", ("t", "p", "", "1")),
        ("title_basics", ("t", "a", "b", "c", "2", "1", "1", "1", "g")),
        ("title_basics", ("t", "a", "b", "c", "0", "70000", "1", "1", "g")),
        ("title_ratings", ("t", "high", "1")),
    ],
    ids=[
        "json", "json number", "json quotes", "json zero", "json nan", "rounded range", "exponent",
        "int", "empty int", "flag", "smallint range", "double",
    ],
)
def test_bad_text_fails(spark, name, row):
    with pytest.raises((PySparkException, Py4JJavaError)):
        staged(spark, name, row).collect()


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("1.5", 2), ("2.5", 3), ("-1.5", -2), ("0.5", 1), ("-0.5", -1), ("1e2", 100), ("12e-1", 1), ("1.4999", 1), (" 7 ", 7),
        ("+7", 7), ("1.", 1), (".5", 1), ("2.45E1", 25), ("32767.4", 32767), ("00012", 12), ("\\N", None),
    ],
)
def test_integers_are_rounded(spark, text, expected):
    rows = staged(spark, "title_basics", ("t", "a", "b", "c", "0", text, "\\N", text, "g"))
    assert rows_of(rows.select("start_year", "runtime_minutes")) == [(expected, expected)]


def test_wide_integers_stay_exact(spark):
    rows = staged(spark, "title_ratings", ("t", "1", str(2**63 - 1)), ("u", "1", f"{2**63 - 1}.4"))
    assert [r["num_votes"] for r in rows.collect()] == [2**63 - 1] * 2


def test_ordered_list_keeps_repeats_and_puts_null_last(spark):
    rows = spark.createDataFrame(
        [("a", "y"), ("a", "x"), ("a", "y"), ("a", None), ("b", "Z"), ("b", "a"), (None, "q")],
        "k string, v string",
    )
    got = dict(rows_of(ordered_list(rows, "k", "v", "vs")))
    assert got == {"a": ["x", "y", "y", None], "b": ["Z", "a"], None: ["q"]}


def test_distinct_list_orders_by_bytes(spark):
    rows = spark.createDataFrame(
        [("a", "é"), ("a", "z"), ("a", "Z"), ("a", "z"), ("a", None)], "k string, v string"
    )
    assert rows_of(distinct_list(rows, "k", "v", "vs")) == [("a", ["Z", "z", "é", None])]


def test_explode_drops_null_and_empty(spark):
    rows = spark.createDataFrame(
        [(1, ["a", ""]), (2, []), (3, None)], "k int, vs array<string>"
    )
    assert rows_of(exploded(rows, "vs", "v")) == [(1, "a"), (1, "")]


def test_tagged_union(spark):
    rows = spark.createDataFrame(
        [(1, ["a"], None), (2, None, ["b", "c"])], "k int, x array<string>, y array<string>"
    )
    stacked = tagged_union(rows, "tag", {"X": "x", "Y": "y"}, "v", ["k"])
    assert sorted(rows_of(stacked.select("k", "tag", "v"))) == [
        (1, "X", "a"), (2, "Y", "b"), (2, "Y", "c")
    ]


def test_name_falls_back_to_key(spark):
    rows = spark.createDataFrame([("n1",), ("n2",), ("n3",)], "nconst string")
    people = spark.createDataFrame([("n1", "One"), ("n2", None)], "nconst string, name string")
    shown = named(rows, people, "nconst", "name", "shown")
    assert sorted(rows_of(shown.select("shown"))) == [("One",), ("n2",), ("n3",)]


@pytest.fixture(scope="module")
def models(spark):
    tables = {
        "title_basics": staged(
            spark,
            "title_basics",
            ("t1", "movie", "One", "One", "0", "2000", "\\N", "90", "War,Drama"),
            ("t2", "movie", "Two", "Two", "0", "2000", "\\N", "90", "Drama"),
            ("t3", "short", "Three", "Three", "0", "\\N", "\\N", "90", "Drama"),
            ("s1", "tvSeries", "Series", "Series", "0", "\\N", "\\N", "\\N", "\\N"),
        ),
        "title_ratings": staged(
            spark,
            "title_ratings",
            ("t1", "6.0", str(2**63 - 1)),
            ("t2", "8.0", str(2**63 - 1)),
        ),
        "title_crew": staged(
            spark, "title_crew", ("t1", "n1,n2,n9", "n1"), ("t2", "\\N", "n1")
        ),
        "title_principals": staged(
            spark,
            "title_principals",
            ("t1", "1", "n1", "actor", "\\N", '["A"]'),
            ("t1", "2", "n9", "self", "\\N", "\\N"),
            ("t1", "3", "n2", "editor", "cut", "\\N"),
            ("t9", "1", "n1", "actress", "\\N", "\\N"),
        ),
        "title_episode": staged(
            spark,
            "title_episode",
            ("t1", "s1", "2", "1"),
            ("t2", "s1", "1", "2"),
            ("t3", "s1", "\\N", "\\N"),
            ("t9", "s1", "1", "1"),
            ("t1", "s9", "1", "1"),
        ),
        "name_basics": staged(
            spark,
            "name_basics",
            ("n1", "Ann", "\\N", "\\N", "\\N", "\\N"),
            ("n2", "Ann", "\\N", "\\N", "\\N", "\\N"),
        ),
        "title_akas": staged(
            spark, "title_akas", ("t1", "1", "Uno", "ES", "es", "\\N", "\\N", "0")
        ),
    }
    return intermediate.intermediate_all(tables)


def test_rollups(models):
    genres = dict(rows_of(models["int_title_genre_lists"]))
    assert genres == {"t1": ["Drama", "War"], "t2": ["Drama"], "t3": ["Drama"]}
    assert rows_of(models["int_title_director_lists"]) == [("t1", ["Ann", "n9"])]
    cast = dict(rows_of(models["int_title_principal_cast_lists"]))
    assert cast == {"t1": ["Ann", "n9"], "t9": ["Ann"]}


def test_renamed_aka_key(models):
    assert models["bridge_title_akas"].columns == [
        "tconst", "ordering", "title", "region", "language", "types", "attributes",
        "is_original_title", LOAD_ID,
    ]


def test_title_search_keeps_every_title(models):
    rows = marts.mart("mart_title_search", models)
    got = {r["tconst"]: (r["genres"], r["directors"], r["principal_cast"]) for r in rows.collect()}
    assert got == {
        "t1": (["Drama", "War"], ["Ann", "n9"], ["Ann", "n9"]),
        "t2": (["Drama"], None, None),
        "t3": (["Drama"], None, None),
        "s1": (None, None, None),
    }


def test_summary_counts_nulls_and_exact_votes(models):
    rows = marts.mart("mart_genre_year_summary", models)
    assert sorted(rows_of(rows), key=str) == sorted(
        [
            (2000, "movie", "Drama", 2, 2, 7.0, 2 * (2**63 - 1)),
            (2000, "movie", "War", 1, 1, 6.0, 2**63 - 1),
            (None, "short", "Drama", 1, 0, None, 0),
        ],
        key=str,
    )


def test_filmography_needs_person_and_title(models):
    rows = marts.mart("mart_person_filmography", models)
    assert sorted(rows_of(rows.select("nconst", "tconst", "ordering", "characters"))) == [
        ("n1", "t1", 1, ["A"]), ("n2", "t1", 3, None)
    ]


def test_series_joins_titles_in_two_roles(models):
    rows = marts.mart("mart_series_episodes", models)
    got = rows_of(rows.select("series_title", "episode_title", "season_number", "average_rating"))
    assert sorted(got, key=str) == sorted(
        [("Series", "One", 2, 6.0), ("Series", "Two", 1, 8.0), ("Series", "Three", None, None)],
        key=str,
    )


def test_consumer_queries(spark, models):
    search = marts.mart("mart_title_search", models)
    found = queries.search_titles(search, "%T%", limit=2)
    assert [r["tconst"] for r in found.collect()] == ["t2", "t3"]
    listed = queries.episodes_of(marts.mart("mart_series_episodes", models), "s1")
    assert [r["episode_title"] for r in listed.collect()] == ["Two", "One", "Three"]
    summary = marts.mart("mart_genre_year_summary", models)
    assert rows_of(queries.genre_over_time(summary, "Drama", 1999, 2000)) == [
        (2000, 2, 2, 7.0, 2 * (2**63 - 1))
    ]
    films = spark.createDataFrame(
        [
            ("n", "N", "a", "A", "movie", None, 2, "actor", None, None, None, None, "l"),
            ("n", "N", "b", "B", "movie", 1990, 1, "actor", None, None, None, 5, "l"),
            ("n", "N", "c", "C", "movie", 2001, 3, "actor", None, None, None, 9, "l"),
            ("n", None, "d", "D", "movie", 2001, 1, "actor", None, None, None, 99, "l"),
            ("m", "M", "e", "E", "movie", 2001, 1, "actor", None, None, None, 1, "l"),
        ],
        marts.contract("mart_person_filmography"),
    )
    titles = [r["primary_title"] for r in queries.filmography_of(films, "n").collect()]
    assert titles == ["D", "C", "B", "A"]
    assert [r["tconst"] for r in queries.top_credits(films, 3).collect()] == ["c", "b", "e"]
    assert [r["tconst"] for r in queries.top_titles(search, 3).collect()] == ["t1", "t2", "s1"]
    assert queries.top_genre_cells(summary, 1).first()["title_count"] == 2
    for name in marts.MARTS:
        assert len(queries.probe(name, marts.mart(name, models)).collect()) == 1


def test_contract_refuses_other_types_names_and_order(spark):
    name = "mart_genre_year_summary"
    good = spark.createDataFrame([], marts.contract(name))
    assert marts.enforced(name, good) is good
    for bad in (
        good.withColumn("title_count", F.col("title_count").cast("int")),
        good.withColumnRenamed("genre", "kind"),
        good.select(*reversed(good.columns)),
        good.drop("genre"),
    ):
        with pytest.raises(marts.ContractError):
            marts.enforced(name, bad)


def test_published_marts_read_titles_and_ratings_from_one_stored_copy(spark, tmp_path):
    from datetime import datetime
    from pathlib import Path

    from reelstrata.session import configure, size_shuffles
    from workload.cases import QUERIES, published_marts

    day, folder = datetime(1997, 5, 6), str(tmp_path)
    given = {
        "customer": ([(c, f"C{c}", "AUTO") for c in (1, 2)], "c_custkey long, c_name string, c_mktsegment string"),
        "orders": (
            [(o, 1 + o % 2, "FOP"[o % 3], 60_000.0 + o, day, "2-HIGH") for o in range(1, 9)],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        ),
        "lineitem": (
            [(o, 1 + n % 3, 1, n, 5.0, "RNA"[n % 3], "FO"[n % 2]) for o in range(1, 9) for n in (1, 2, 3)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string",
        ),
        "part": (
            [(p, f"part {p}", "Brand#1", "TIN", 20) for p in (1, 2, 3)],
            "p_partkey long, p_name string, p_brand string, p_type string, p_size int",
        ),
        "supplier": ([(1, "S1", 10.0)], "s_suppkey long, s_name string, s_acctbal double"),
    }
    for name, (rows, schema) in given.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    size_shuffles(configure(spark), 1000)
    build = published_marts(spark, folder)
    stored = Path(build.location("buckets", "").removeprefix("file:"))
    assert sorted(p.name for p in stored.iterdir()) == ["dim_titles", "fct_title_ratings"]
    counted = {name: build.scan(spark, "marts", name).count() for name in marts.MARTS}
    assert counted["mart_title_search"] == 10 and counted["mart_person_filmography"] == 24 and counted["mart_series_episodes"] == 8
    assert {r[0]: r[1] for r in QUERIES["published_mart_counts"](spark, folder).collect()} == counted
