"""Search through the trigram index against the scan."""

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from reelstrata.operators import trigrams
from reelstrata.plans import marts, queries

TITLES = [
    "The River", "the rivers", "Riv er", "RIVER 100%", "river 100 km", "under_score", "underXscore", "back\\slash", "ΟΔΟΣ", "Οδός",
    "İstanbul", "İSTANBUL gece", "straße", "STRASSE", "夜汽車の夜", "ab", "", None, "a%b%c", "aaaa", "river", "driver's river",
]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rows = [(f"t{i:03d}", "movie", title, title, False, 2000, None, 90, 5.0, i % 5, None, None, None, "l") for i, title in enumerate(TITLES)]
    mart = spark.createDataFrame(rows, marts.contract("mart_title_search"))
    return mart, trigrams.write_index(mart, "tconst", "primary_title", str(tmp_path_factory.mktemp("index") / "i"))


@pytest.mark.parametrize("most", [0, 1_000])
@pytest.mark.parametrize(
    "pattern",
    ["%river%", "river%", "%RIVER", "%riv_r%", "%100\\%", "%100\\%%", "%r\\_s%", "%der\\_sc%", "back\\\\slash", "%ΟΔΟΣ%", "%οδο%", "%İst%",
     "%istanbul%", "%stra%", "%ß%", "%夜汽車%", "%の夜", "ab", "%", "", "a\\%b\\%c", "%aaa%", "%river%river%", "%nothing%"],
)
def test_the_index_finds_what_the_scan_finds(stored, pattern, most, monkeypatch):
    monkeypatch.setattr(queries, "LOOKED_UP", most)
    mart, index = stored
    assert rows_of(queries.search_titles_by_index(mart, index, pattern)) == rows_of(queries.search_titles(mart, pattern))


def test_few_candidates_reach_the_scan_as_keys(spark, stored, tmp_path):
    from reelstrata.sources.tables import write_table

    mart, index = stored
    saved = write_table(mart, str(tmp_path / "m"), lookup="tconst")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = queries.search_titles_by_index(saved, index, "%夜汽車%")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(tconst,t014)" in plan or "In(tconst, [t014])" in plan


def test_pieces(spark):
    rows = spark.createDataFrame([("ABCab",), ("ab",), (None,), ("aaaa",)], "t string")
    assert [r[0] for r in rows.select(trigrams.pieces(F.col("t"))).collect()] == [["abc", "bca", "cab"], [], [], ["aaa"]]
    assert trigrams.literal_runs(r"%a\%b_c\\d%") == ["a%b", "c\\d"]
