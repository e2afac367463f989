"""The pipeline on the smallest tables: every stage keeps the columns and acts on what its predecessor kept."""

import corpus_pipeline
from reelstrata.llm import ngram_join
from reelstrata.llm.common import documents, stored

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = documents(spark, FOLDER)
    columns, counts = docs.columns, [docs.count()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(stage(spark, docs, FOLDER), f"test{number}")
        counts.append(docs.count())
        if number < 4:
            assert docs.columns == columns, name
        if number == 2:
            linked = ngram_join.join(docs).collect()
            assert all(r.doc_id == r.component_id for r in linked)
    assert counts[0] >= counts[1] > counts[2] > counts[3] > 0
    assert docs.where("not round_trip").count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
    assert [name for name, _ in corpus_pipeline.STAGES][2] == "n-gram Jaccard join"


def test_near_copies_of_four_fifths_go(spark):
    first = [f"w{k}" for k in range(104)]
    rows = [(1, " ".join(first)), (2, " ".join(first + [f"x{k}" for k in range(23)])), (3, " ".join(first + [f"y{k}" for k in range(28)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # 100 of 123 shingles of five words are shared with the second, 100 of 128 with the third
    assert sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, docs, FOLDER).collect()) == [1, 3]
    assert ngram_join.keep_one(docs).count() == 3
