"""The stages of the pipeline on NULLs, empty tables and columns with clashing names."""

import corpus_pipeline
from reelstrata.llm.common import documents, ship, stored

FOLDER = "/root/testdata/sf0.001"
EXTRA = "node long, h long, best string, `key` string, copies int, times int"


def test_stages_take_nulls_and_clashing_columns(spark):
    ship(spark)
    given = documents(spark, FOLDER).limit(60).collect()
    rows = [(*r, 1, 2, "b", "k", 3, 4) for r in given]
    rows += [(None, None, None, None, None, 1, 2, "b", "k", 3, 4), (None, given[0].text, "en", None, 5, 1, 2, "b", "k", 3, 4)]
    rows += [(7, "", "en", "a", 0, 1, 2, "b", "k", 3, 4), (8, given[1].text, None, "a", 0, None, None, None, None, None, None)]
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
    docs = stored(spark.createDataFrame(rows, schema), "edges")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        found = stage(spark, docs, FOLDER)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert found.columns == docs.columns, name
            docs = stored(found, "edges")
        else:
            assert found.count() == docs.count() and found.where("NOT round_trip").isEmpty()


def test_stages_take_empty_tables(spark):
    ship(spark)
    docs = documents(spark, FOLDER).where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).collect() == [], name
