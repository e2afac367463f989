from decimal import Decimal

from pyspark.sql import functions as F

from conftest import rows_of
from reelstrata.operators import checks
from reelstrata.operators.profile import Domain, key_profile, repeated_grains
from reelstrata.plans import audit, marts
from reelstrata.plans.staging import stage_all
from reelstrata.sources.registry import LOAD_ID, SOURCES


def keys_of(findings):
    return sorted((r["check"], r["relation"], r["key"]) for r in findings.collect())


def test_declared_checks_add_up():
    count = {
        "null": sum(len(c) for t in audit.NOT_NULL.values() for c in t.values()),
        "unique": sum(len(t) for t in audit.UNIQUE.values()),
        "links": sum(len(c) for c in audit.RELATIONSHIPS.values()),
        "relations": sum(len(n) for n in audit.REQUIRED.values()),
    }
    assert count == {"null": 60, "unique": 15, "links": 12, "relations": 31}
    layers = {n: sum(len(c) for c in t.values()) for n, t in audit.NOT_NULL.items()}
    assert layers == {"staging": 26, "intermediate": 21, "marts": 13}


def test_not_null(spark):
    rows = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    assert sorted(rows_of(checks.null_counts(rows, "r", ["a", "b"]))) == [
        ("r", "a", 1), ("r", "b", 2)
    ]
    assert keys_of(checks.not_null(rows, "r", ["a", "b"])) == [
        ("not_null", "r", "a"), ("not_null", "r", "b")
    ]
    assert checks.not_null(rows.where("b = 'x'"), "r", ["a", "b"]).isEmpty()


def test_unique_ignores_null_but_grain_counts_it(spark):
    rows = spark.createDataFrame(
        [("a", 1), ("a", 1), ("b", 2), (None, 3), (None, 3)], "k string, n int"
    )
    assert keys_of(checks.unique(rows, "r", "k")) == [("unique", "r", "a")]
    assert keys_of(checks.duplicate_keys(rows, "r", ["k", "n"])) == [
        ("grain", "r", "3"), ("grain", "r", "a|1")
    ]


def test_orphan_limit_is_strict(spark):
    parent = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    def child(orphans):
        known = spark.range(10_000 - orphans).select(F.col("id").cast("string").alias("c"))
        return known.unionByName(spark.range(orphans).select(F.lit("none").alias("c")))

    one, two = child(1), child(2)
    found = checks.orphan_ratio({"one": (one, "c"), "two": (two, "c")}, parent, "k")
    assert rows_of(found) == [("orphan_ratio", "two", "k", "2 of 10000")]
    metrics = checks.orphan_metrics({"one": (one, "c"), "two": (two, "c")}, parent, "k")
    assert sorted(rows_of(metrics)) == [
        ("one", 10_000, 1, 0.0001, 0.0001), ("two", 10_000, 2, 0.0002, 0.0001)
    ]
    loose = checks.orphan_ratio({"two": (two, "c")}, parent, "k", Decimal("0.5"))
    assert loose.isEmpty()


def test_orphan_counts_equal_those_of_the_plain_join(spark):
    child = spark.createDataFrame(
        [("a",)] * 5 + [("b",)] * 2 + [("x",)] * 3 + [(None,)] * 4, "c string"
    )
    parent = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    plain = child.where("c is not null").join(parent, child["c"] == parent["k"], "left")
    wanted = plain.agg(F.count("*"), F.count_if(F.col("k").isNull())).first()
    got = checks.orphan_metrics({"l": (child, "c")}, parent, "k").first()
    assert (got["child_rows"], got["orphan_rows"]) == tuple(wanted) == (15, 3)
    none = checks.orphan_metrics({"l": (child.limit(0), "c")}, parent, "k")
    assert rows_of(none) == [("l", 0, 0, None, 0.0001)]
    assert checks.too_many_orphans(none).isEmpty()


def test_row_counts_and_mismatch(spark):
    three, two = spark.range(3), spark.range(2)
    found = checks.count_mismatch({"same": (two, two), "other": (three, two)}, "raw", "staging")
    assert rows_of(found) == [("rows_raw_staging", "other", "row_count", "3 != 2")]
    empty = checks.paired_counts({"none": (two.limit(0), two)}, "a", "b")
    assert rows_of(empty) == [("none", 0, 2)]


def snapshot(spark, **rows):
    given = {
        "title_basics": [("t", "movie", "T", "T", "0", "1870", "2200", "0", "Drama")],
        "title_ratings": [("t", "10", "0")],
        "name_basics": [("n", "N", "1", "2200", "a", "t")],
        "title_akas": [("t", "1", "T", "r", "l", "\\N", "\\N", "0")],
        "title_crew": [("t", "n", "n")],
        "title_episode": [("t", "t", "1", "1")],
        "title_principals": [("t", "1", "n", "actor", "\\N", "[]")],
        **rows,
    }
    raw = {
        name: spark.createDataFrame(
            [(*row, "load") for row in given[name]],
            ", ".join(f"`{h}` string" for h in (*source.headers, LOAD_ID)),
        )
        for name, source in SOURCES.items()
    }
    raw["ingestion_files"] = spark.createDataFrame(
        [
            (s.dataset, s.file_name, n, "u", 1, 1, "d", "w", "b", None, None, None, "load")
            for n, s in SOURCES.items()
        ],
        "dataset string, file_name string, table_name string, url string, size_bytes long, "
        "row_count long, sha256 string, downloaded_at string, batch_id string, etag string, "
        f"last_modified string, content_type string, {LOAD_ID} string",
    )
    return {"raw": raw, "staging": stage_all(raw)}


def test_staging_audit_passes_at_the_limits(spark):
    assert audit.staging_findings(snapshot(spark)).isEmpty()


def test_ranges_fire(spark):
    bad = snapshot(
        spark,
        title_basics=[
            ("low", "m", "T", "T", "0", "1869", "\\N", "1", "g"),
            ("high", "m", "T", "T", "0", "\\N", "2201", "1", "g"),
            ("short", "m", "T", "T", "0", "\\N", "\\N", "-1", "g"),
            ("fine", "m", "T", "T", "\\N", "\\N", "\\N", "\\N", "g"),
        ],
        title_ratings=[("r", "10.1", "1"), ("v", "1", "-1"), ("fine", "0", "0")],
        name_basics=[("b", "N", "0", "\\N", "a", "t"), ("d", "N", "1", "2201", "a", "t")],
    )
    found = audit.range_findings(bad["staging"])
    assert sorted(r["key"] for r in found.collect()) == ["b", "d", "high", "low", "r", "short", "v"]


def test_raw_flag_values(spark):
    rows = spark.createDataFrame(
        [("a", "0"), ("b", "1"), ("c", "\\N"), ("d", "2"), ("e", None)], "k string, f string"
    )
    found = checks.not_accepted(rows, "r", "k", "f", audit.ADULT_FLAGS)
    assert rows_of(found) == [("accepted_values", "r", "d", "2")]


def test_lineage(spark):
    tables = snapshot(spark)["raw"]
    assert audit.lineage_findings(tables).isEmpty()
    lost = {**tables, "title_crew": tables["title_crew"].withColumn(LOAD_ID, F.lit("other"))}
    assert rows_of(audit.lineage_findings(lost)) == [("lineage", "title_crew", "other", "1 rows")]
    untabled = {**tables, "ingestion_files": tables["ingestion_files"].where("table_name <> 'title_akas'")}
    assert keys_of(audit.lineage_findings(untabled)) == [("lineage", "title_akas", "load")]
    unmarked = tables["title_crew"].withColumn(LOAD_ID, F.lit(None).cast("string"))
    assert len(audit.lineage_findings({**tables, "title_crew": unmarked}).collect()) == 1


def test_staging_keys_fire(spark):
    twice = snapshot(spark, title_crew=[("t", "n", "n"), ("t", "n", "n")])
    found = audit.staging_findings(twice)
    assert keys_of(found) == [("unique", "title_crew", "t")]


def test_schema_violations(spark):
    want = marts.contract("mart_genre_year_summary")
    assert checks.schema_violations(spark, "m", want, want).isEmpty()
    frame = spark.createDataFrame([], want).drop("total_votes")
    other = frame.withColumn("title_count", F.col("title_count").cast("int"))
    found = checks.schema_violations(spark, "m", other.schema, want)
    assert sorted(r["key"] for r in found.collect()) == ["title_count", "total_votes"]


def test_missing_relations(spark):
    required = audit.required_relations(spark)
    found = required.where("name <> 'dim_people'")
    lost = checks.missing_relations(required, found, ["schema", "name"])
    assert rows_of(lost) == [("intermediate", "dim_people")]


def test_raw_schema(spark):
    raw = snapshot(spark)["raw"]
    assert audit.raw_schema_findings(spark, raw).isEmpty()
    typed = {**raw, "title_ratings": raw["title_ratings"].withColumn("numVotes", F.lit(1))}
    renamed = {**raw, "title_crew": raw["title_crew"].withColumnRenamed("writers", "Writers")}
    assert keys_of(audit.raw_schema_findings(spark, typed)) == [
        ("contract", "title_ratings", "numVotes")
    ]
    assert keys_of(audit.raw_schema_findings(spark, renamed)) == [
        ("contract", "title_crew", "writers")
    ]


def test_key_profile_counts_each_column_of_a_domain(spark):
    parent = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    child = spark.createDataFrame([("a", "n")] * 5 + [("b", None)] * 2 + [("x", "n")] * 3 + [(None, None)] * 4, "c string, note string")
    other = spark.createDataFrame([("b", 1), ("z", 2), ("z", 2)], "o string, p long")
    domains = [
        Domain("text", (("parent", "k"), ("child", "c"), ("other", "o"), ("none", "e"))),
        Domain("number", (("other", "p"),)),
    ]
    tables = {"parent": parent, "child": child, "other": other, "none": other.limit(0).withColumnRenamed("o", "e")}
    found = key_profile(tables, domains, {"child": ["c", "note"], "other": ["p"]})
    rows = {(r["domain"], r["relation"], r["column_name"]): tuple(r)[4:] for r in found.collect()}
    assert rows.pop((None, "child", "note"))[1] == 6
    assert rows == {
        ("text", "parent", "k"): (4, 1, 2, 1, 5, 0),
        ("text", "child", "c"): (14, 4, 3, 3, 15, 3),
        ("text", "other", "o"): (3, 0, 2, 1, 3, 2),
        ("text", "none", "e"): (0, 0, 0, 0, 0, 0),
        ("number", "other", "p"): (3, 0, 2, 1, 5, 0),
    }


def test_key_profile_shuffles_keys_once(spark):
    rows = spark.range(1000).select((F.col("id") % 7).cast("string").alias("k"))
    domains = [Domain("d", (("a", "k"), ("b", "k"))), Domain("e", (("c", "k"),))]
    found = key_profile({"a": rows, "b": rows, "c": rows}, domains)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # the keys, their counts per column, and the names of the columns
    assert plan.count("Exchange hashpartitioning(domain") <= 2 and plan.count("hashpartitioning(domain#") >= 1


def test_repeated_grains_of_several_relations(spark):
    one = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1)], "k string, n int")
    two = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 1, "x")], "k string, n int, t string")
    found = repeated_grains({"one": one, "two": two, "none": one.limit(0)}, {"one": ("k", "n"), "two": ("k", "n", "t"), "none": ("k",)})
    assert sorted(rows_of(found)) == [("one", 2), ("two", 1)]
