import shutil
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import BASE_URL, catalogue, manifest_frame, rows_of, write_snapshot
from reelstrata.plans import audit, queries
from reelstrata.plans import build as builds
from reelstrata.plans.audit import AuditError
from reelstrata.plans.marts import CONTRACTS, mart
from reelstrata.plans.intermediate import title_genre_lists
from reelstrata.sources import buckets, catalog, freeze, tables
from reelstrata.sources.registry import SOURCES
from reelstrata.sources.tables import Build, PublishConflict, current_build, current_version, publish, published_builds


def run(spark, tmp_path, name, entries, **options):
    return builds.build_snapshot(
        spark,
        raw_dir=str(tmp_path / "raw"),
        entries=manifest_frame(spark, entries),
        base_url=BASE_URL,
        build=Build(str(tmp_path / "lake"), name),
        load_id=f"load-{name}",
        **options,
    )


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("lake")
    entries = write_snapshot(folder / "raw")
    return folder, entries, run(spark, folder, "b1", entries)


def test_published_snapshot(spark, lake):
    folder, _, result = lake
    assert result.relation_count == 31
    assert result.mart_row_counts == {
        "mart_title_search": 9,  # 2 serials, 5 chapters, 2 films
        "mart_genre_year_summary": 7,  # 3 years of 2 genres, and one film's
        "mart_person_filmography": 10,
        "mart_series_episodes": 5,
    }
    build = current_build(spark, str(folder / "lake"))
    relations = builds.open_build(spark, build)
    marts = relations["marts"]
    shown = marts["mart_title_search"].select("tconst", "average_rating", "genres", "directors", "principal_cast")
    assert rows_of(shown.where("tconst IN ('ttq10c1', 'ttq10c2', 'ttq31')").orderBy("tconst")) == [
        ("ttq10c1", 6.5, ["Mystery", "Talk"], ["Ott Lind", "nmq3"], ["Ida Moor"]),
        ("ttq10c2", 7.0, ["Mystery", "Talk"], None, ["Ida Moor"]),
        ("ttq31", None, None, None, None),
    ]
    cells = marts["mart_genre_year_summary"].select("start_year", "genre", "title_count", "rated_title_count", "total_votes")
    assert rows_of(cells.where("genre <> 'Mystery'").orderBy("start_year")) == [
        (1951, "Talk", 2, 2, 80), (1952, "Talk", 2, 2, 160), (1953, "Talk", 1, 1, 120), (1962, "Noir", 1, 0, 0)
    ]
    credits = marts["mart_person_filmography"].where("tconst = 'ttq20c2'").orderBy("ordering")
    assert rows_of(credits.select("nconst", "category", "job", "characters")) == [
        ("nmq1", "self", None, ["Host", "Guide"]), ("nmq2", "composer", "score", None)
    ]
    listed = marts["mart_series_episodes"].where("series_tconst = 'ttq10'").orderBy("episode_tconst")
    assert rows_of(listed.select("series_title", "episode_title", "season_number", "episode_number")) == [
        ("Serial 10", "Chapter 1", 1, 1), ("Serial 10", "Chapter 2", 1, 2), ("Serial 10", "Chapter 3", None, None)
    ]
    films = relations["staging"]["title_basics"].where("title_type = 'movie'").orderBy("tconst")
    assert rows_of(films.select("original_title", "is_adult", "start_year", "end_year", "genres", "_load_id")) == [
        ("", True, 1962, 1964, ["Noir"], "load-b1"), (None, None, 1963, None, None, "load-b1")
    ]
    files = relations["raw"]["ingestion_files"]
    assert dict(rows_of(files.select("table_name", "row_count"))) == {name: len(rows) for name, rows in catalogue().items()}
    assert "row_count" not in relations["staging"]["ingestion_files"].columns
    assert len(spark.catalog.listTables(pattern="marts__*")) == 4


def scan_of(rows):
    plan = rows._jdf.queryExecution().executedPlan().toString()
    return next(line for line in plan.splitlines() if "FileScan" in line)


def test_point_queries_reach_the_scan(spark, lake):
    _, _, result = lake
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    marts = {name: result.build.scan(spark, "marts", name) for name in CONTRACTS}
    scan = scan_of(queries.filmography_of(marts["mart_person_filmography"], "nmq1"))
    assert "EqualTo(nconst,nmq1)" in scan
    assert "characters" not in scan and "num_votes" not in scan
    scan = scan_of(queries.episodes_of(marts["mart_series_episodes"], "ttq10"))
    assert "EqualTo(series_tconst,ttq10)" in scan
    scan = scan_of(queries.genre_over_time(marts["mart_genre_year_summary"], "Talk", 1951, 1952))
    assert "EqualTo(genre,Talk)" in scan and "GreaterThanOrEqual(start_year,1951)" in scan
    top = queries.top_titles(marts["mart_title_search"])
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert "directors" not in scan_of(top)


def test_failure_keeps_the_published_build(spark, lake):
    folder, entries, _ = lake
    root = str(folder / "lake")
    reached = []

    def fail_last(stage):
        reached.append(stage)
        if stage == "publish":
            raise RuntimeError(stage)

    with pytest.raises(RuntimeError, match="publish"):
        run(spark, folder, "bad", entries, on_stage=fail_last)
    assert reached == [
        "verify", "ingest", "staging", "intermediate", "marts", "validate", "publish"
    ]
    assert current_build(spark, root).build_id == "b1"
    for stage in reached[:3]:

        def fail(reached, stage=stage):
            if reached == stage:
                raise RuntimeError(stage)

        with pytest.raises(RuntimeError, match=stage):
            run(spark, folder, f"bad-{stage}", entries, on_stage=fail)
    assert [r[0] for r in rows_of(published_builds(spark, root))] == ["b1"]
    publish(spark, Build(root, "bad"), current_version(spark, root))
    assert [r[0] for r in rows_of(published_builds(spark, root))] == ["bad", "b1"]


def test_audit_stops_a_bad_layer(spark, tmp_path):
    bad = catalogue()
    bad["title_basics"].append(bad["title_basics"][1])
    entries = write_snapshot(tmp_path / "raw", bad)
    with pytest.raises(AuditError, match="unique on title_basics: 1"):
        run(spark, tmp_path, "bad", entries)
    assert current_build(spark, str(tmp_path / "lake")) is None


def test_changed_file_is_refused(spark, tmp_path):
    entries = write_snapshot(tmp_path / "raw")
    write_snapshot(tmp_path / "raw", catalogue(films=["ttq39"]))
    with pytest.raises(builds.SnapshotError, match="title.basics.tsv.gz: checksum differs"):
        run(spark, tmp_path, "bad", entries)


def test_incomplete_snapshot_is_refused(spark, tmp_path):
    entries = write_snapshot(tmp_path / "raw")
    with pytest.raises(builds.SnapshotError, match="name_basics table_name: missing"):
        run(spark, tmp_path, "bad", entries[:-1])


def test_a_load_replaces_what_was_landed(spark, tmp_path):
    build, raw_dir = Build(str(tmp_path / "lake"), "b"), tmp_path / "raw"

    def titles(load, rows, **counted):
        entries = manifest_frame(spark, write_snapshot(raw_dir, rows))
        for count in counted.values():
            entries = entries.withColumn("row_count", F.lit(count).cast("long")).where("table_name = 'title_basics'")
        return builds.load_raw(spark, entries, str(raw_dir), build, load)["title_basics"]

    landed = {r["tconst"]: r for r in titles("one", catalogue(films=["ttq38"])).collect()}
    assert len(landed) == 8 and {r["_load_id"] for r in landed.values()} == {"one"}
    assert landed["ttq38"]["primaryTitle"] == "Nachtzug 夜汽車 0"
    assert (landed["ttq38"]["originalTitle"], landed["ttq38"]["runtimeMinutes"]) == ("", "\\N")
    with pytest.raises(builds.SnapshotError, match="9 rows from 10 lines"):
        titles("one", catalogue(), counted=10)
    again = titles("two", catalogue(chapters={"ttq10": 1}))
    assert set(rows_of(again.select("tconst", "_load_id"))) == {(t, "two") for t in ("ttq10", "ttq10c1", "ttq30", "ttq31")}


def test_checkpoint_publishes_a_compacted_copy(spark, lake):
    _, _, result = lake
    root = result.build.root
    publish(spark, result.build, current_version(spark, root))
    packed = builds.checkpoint_current(spark, root, "packed")
    assert current_build(spark, root) == packed == Build(root, "packed")
    relations = builds.open_build(spark, packed)
    assert builds.mart_row_counts(relations["marts"]) == result.mart_row_counts
    with pytest.raises(builds.SnapshotError, match="nothing is published"):
        builds.checkpoint_current(spark, f"{root}/other", "x")


def test_totals_equal_the_listed_findings(spark, lake):
    _, _, result = lake
    relations = builds.open_build(spark, result.build)
    staged, models, marts = (relations[layer] for layer in ("staging", "intermediate", "marts"))
    twice = staged["title_basics"].unionByName(staged["title_basics"]).withColumn("start_year", F.lit(9).cast("short"))
    akas = models["bridge_title_akas"]
    wrong = {
        "raw": {
            **relations["raw"],
            "title_crew": relations["raw"]["title_crew"].withColumn("_load_id", F.lit("lost")),
            "title_basics": relations["raw"]["title_basics"].withColumn("isAdult", F.lit("7")),
        },
        "staging": {**staged, "title_basics": twice, "name_basics": staged["name_basics"].withColumn("nconst", F.lit(None).cast("string"))},
        "intermediate": {**models, "dim_titles": models["dim_titles"].limit(1), "bridge_title_akas": akas.unionByName(akas)},
        "marts": {**marts, "mart_title_search": marts["mart_title_search"].unionByName(marts["mart_title_search"])},
    }
    for layers in (relations, wrong):
        for layer in audit.TOTALS:
            listed = getattr(audit, {"staging": "staging_findings", "intermediate": "intermediate_findings", "marts": "mart_findings"}[layer])
            assert sorted(rows_of(audit.TOTALS[layer](layers))) == sorted(rows_of(audit.totals(listed(layers))))
    fired = {r[:2] for r in rows_of(audit.staging_totals(wrong))}
    assert fired >= {
        ("unique", "title_basics"), ("value_range", "title_basics"), ("rows_raw_staging", "title_basics"),
        ("accepted_values", "title_basics"), ("lineage", "title_crew"), ("not_null", "name_basics"),
    }
    assert {r[:2] for r in rows_of(audit.mart_totals(wrong))} == {("grain", "mart_title_search"), ("unique", "mart_title_search")}


def test_each_stored_table_is_scanned_once_for_counts_and_once_per_key(spark, lake):
    _, _, result = lake
    relations = builds.open_build(spark, result.build)
    plan = audit.staging_totals(relations)._jdf.queryExecution().executedPlan().toString()
    # 8 raw and 8 staged aggregates, 6 keys, and the file rows of the lineage
    assert plan.count("FileScan") <= 23
    plan = relations["staging"]["title_basics"]
    lists = title_genre_lists(plan)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in lists


def test_stored_relations_are_gated(spark, tmp_path):
    root, raw_dir = str(tmp_path / "lake"), tmp_path / "raw"
    entries = write_snapshot(raw_dir)
    first = run(spark, tmp_path, "g1", entries).build
    spark.range(1).createOrReplaceTempView("marts__mart_title_search")

    def copy(name):
        target = Build(root, name)
        shutil.copytree(f"{root}/builds/g1", f"{root}/builds/{name}")
        for listing in (catalog.FILES, catalog.COLUMNS):  # they name the files of g1
            shutil.rmtree(target.location(*listing))
        return target

    def rewrite(build, schema, name, change):
        rows = change(first.scan(spark, schema, name))
        tables.write_table(rows, build.location(schema, name))
        return build

    assert builds.validate(spark, copy("same"))[1]["mart_title_search"] == 9
    lost = copy("lost")
    shutil.rmtree(lost.location("marts", "mart_title_search"))
    with pytest.raises(AuditError, match="missing: .*marts.mart_title_search"):
        builds.validate(spark, lost)
    assert builds.absent_relations({"marts": {}})[-1].startswith("marts.")
    other = rewrite(copy("contract"), "marts", "mart_title_search", lambda r: r.withColumn("num_votes", F.col("num_votes").cast("int")))
    with pytest.raises(AuditError, match="contract on mart_title_search: 1"):
        builds.validate(spark, other)
    other = rewrite(copy("raw"), "raw", "title_crew", lambda r: r.withColumnRenamed("writers", "authors"))
    with pytest.raises(AuditError, match="contract on title_crew: 1"):
        builds.validate(spark, other)
    raw = {name: first.scan(spark, "raw", name) for name in SOURCES}
    empty = rewrite(copy("empty"), "marts", "mart_series_episodes", lambda r: r.limit(0))
    assert builds.validate(spark, empty)[1]["mart_series_episodes"] == 0
    with pytest.raises(AuditError, match="empty: .*mart_series_episodes"):
        builds.validate(spark, empty, marts_not_empty=True)
    audit.register({"raw": raw, "marts": {}})
    audit.register({"marts": {"mart_genre_year_summary": spark.range(1)}})
    assert [t.name for t in spark.catalog.listTables(pattern="marts__*")] == ["marts__mart_genre_year_summary"]


def test_compaction_keeps_order_and_filters(spark, lake, tmp_path):
    _, _, result = lake
    root, name = str(tmp_path / "lake"), "mart_title_search"
    scattered = Build(root, "scattered")
    shutil.copytree(f"{result.build.root}/builds/{result.build.build_id}", f"{root}/builds/scattered")
    lookup, sort = builds.LOOKUPS[name]
    rows = result.build.scan(spark, "marts", name)
    tables.write_table(rows.repartition(5), scattered.location("marts", name), lookup=lookup, sort=sort)
    for listing in (catalog.FILES, catalog.COLUMNS):
        shutil.rmtree(scattered.location(*listing))
    builds.write_catalog(spark, scattered, builds.open_build(spark, scattered))
    packed = builds.compact_build(spark, scattered, Build(root, "packed"))
    (file,) = Path(f"{root}/builds/packed/marts/{name}").glob("*.parquet")
    stored = pq.read_table(file).column(lookup).to_pylist()
    assert stored == sorted(stored) and len(stored) == 9
    assert sorted(rows_of(packed["marts"][name]), key=str) == sorted(rows_of(rows), key=str)
    # with its filters written, the same table takes more bytes
    plain = f"{root}/plain"
    tables.write_table(spark.read.parquet(str(file)), plain)
    assert tables.stored_bytes(spark, str(file)) > tables.stored_bytes(spark, plain) + 1000
    # tables of one file stay where they are
    assert not (tmp_path / "lake/builds/packed/marts/mart_series_episodes").exists()
    assert all("/builds/scattered/" in path for path in packed["marts"]["mart_series_episodes"].inputFiles())
    assert builds.validate(spark, Build(root, "packed"))[1] == result.mart_row_counts


def test_full_files_are_neither_read_nor_copied(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    rows = spark.range(20_000).select("id", F.md5(F.col("id").cast("string")).alias("text"))
    rows.coalesce(1).write.parquet(source)
    size = tables.stored_bytes(spark, source)
    spark.range(20_000, 20_100).select("id", F.lit("small").alias("text")).repartition(12).write.mode("append").parquet(source)
    packed = tables.compact(spark, source, target, file_bytes=size)
    assert sorted(rows_of(packed)) == sorted(rows_of(spark.read.parquet(source)))
    assert len(packed.inputFiles()) == 2 and len(list((tmp_path / "target").glob("*.parquet"))) == 1
    assert tables.stored_bytes(spark, target) < size / 10
    # nothing to merge, nothing written
    again = tables.compact(spark, packed.inputFiles(), str(tmp_path / "again"), file_bytes=size)
    assert again.count() == 20_100 and not (tmp_path / "again").exists()


def test_the_catalog_answers_without_a_scan(spark, lake):
    _, _, result = lake
    fresh = spark.newSession()
    build = current_build(fresh, result.build.root) or result.build
    relations = catalog.relations_of(fresh, build)
    assert audit.required_relations(fresh).join(relations, ["schema", "name"], "left_anti").isEmpty()
    assert relations.count() == 31
    columns = catalog.columns_of(fresh, build).where("schema = 'marts' AND relation = 'mart_title_search'").orderBy("position")
    assert [r["column_name"] for r in columns.collect()] == result.build.scan(spark, "marts", "mart_title_search").columns
    assert dict(rows_of(catalog.counted_rows(fresh, build, "marts"))) == result.mart_row_counts
    assert dict(rows_of(catalog.counted_rows(fresh, build, "raw")))["title_basics"] == 9
    rows = catalog.scan_key(fresh, build, "marts", "mart_person_filmography", "nconst", "nmq2")
    assert rows.count() == 5 and rows.inputFiles()
    none = catalog.scan_key(fresh, build, "marts", "mart_person_filmography", "nconst", "zz")
    assert none.count() == 0


def test_unsound_manifest_document_is_refused(spark, tmp_path):
    path = tmp_path / "manifest.json"
    path.write_text('{"version": 2, "entries": []}')
    with pytest.raises(builds.SnapshotError, match="unsupported version"):
        builds.load_manifest(spark, str(path))
    path.write_text('{"version": 1, "entries": []}')
    assert builds.load_manifest(spark, str(path)).isEmpty()


def test_the_second_of_two_publishers_fails(spark, lake, tmp_path):
    _, entries, result = lake
    root = str(tmp_path / "lake")

    def meanwhile(stage):
        if stage == "validate":
            publish(spark, Build(root, "other"), 0)

    with pytest.raises(PublishConflict, match="mine"):
        builds.build_snapshot(
            spark, raw_dir=str(Path(result.build.root).parent / "raw"), entries=manifest_frame(spark, entries),
            base_url=BASE_URL, build=Build(root, "mine"), load_id="l", on_stage=meanwhile,
        )
    assert current_build(spark, root) == Build(root, "other")


def test_changed_columns_stop_a_load_before_a_row_lands(spark, lake, tmp_path):
    folder, entries, result = lake
    root = str(tmp_path / "lake")
    stored = freeze.stored_schemas(spark, result.build)
    assert stored.where("schema_version <> 1").isEmpty() and stored.select("table_name").distinct().count() == 8
    earlier = Build(root, "earlier")
    kept = stored.where("NOT (table_name = 'title_crew' AND column_name = 'writers')")
    freeze.store_schemas(kept, earlier)
    publish(spark, earlier, 0)

    def load(name, **options):
        build = Build(root, name)
        builds.build_snapshot(
            spark, raw_dir=str(folder / "raw"), entries=manifest_frame(spark, entries), base_url=BASE_URL, build=build,
            load_id="l", **options,
        )
        return build

    reached = []
    with pytest.raises(AuditError, match="schema_frozen on title_crew: 1"):
        load("refused", on_stage=reached.append)
    assert reached == ["verify"] and not (tmp_path / "lake/builds/refused").exists()
    allowed = load("allowed", may_change=["title_crew"])
    versions = freeze.stored_schemas(spark, allowed).select("table_name", "schema_version").distinct()
    assert dict(rows_of(versions)) == {**dict.fromkeys(freeze.registered_schemas(), 1), "title_crew": 2}
    packed = builds.checkpoint_current(spark, root, "packed")
    assert sorted(rows_of(freeze.stored_schemas(spark, packed))) == sorted(rows_of(freeze.stored_schemas(spark, allowed)))
    # a build from before schemas were kept is compared by its tables
    shutil.rmtree(packed.location(*freeze.STORED))
    assert freeze.stored_schemas(spark, packed).where("schema_version = 1").count() == stored.count()


def test_schemas_of_a_build_are_found_where_compaction_left_its_files(spark, lake, tmp_path):
    _, _, result = lake
    source = result.build
    for name in ("once", "twice"):  # of a table in one file the second has no folder
        target = Build(str(tmp_path / "lake"), name)
        builds.compact_build(spark, source, target)
        source = target
    assert not Path(source.location("raw", "title_crew")).exists()
    shutil.rmtree(source.location(*freeze.STORED))
    wanted = freeze.stored_schemas(spark, result.build)
    assert sorted(rows_of(freeze.stored_schemas(spark, source))) == sorted(rows_of(wanted))


def test_bucketed_models_meet_without_an_exchange(spark, lake, tmp_path):
    _, _, result = lake
    models = builds.open_build(spark, result.build)["intermediate"]
    build = Build(str(tmp_path / "lake"), "b")
    stored = builds.bucketed_models(models, build, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for tables_ in (stored, {n: buckets.scan_bucketed(spark.newSession(), build.location("buckets", n), "tconst", 4) for n in builds.BY_TITLE}):
            rows = mart("mart_title_search", tables_)
            rows.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            plan = rows._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
            wanted = result.build.scan(spark, "marts", "mart_title_search")
            assert sorted(rows_of(rows), key=str) == sorted(rows_of(wanted), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
