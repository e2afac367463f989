import gzip
import hashlib
import json
import random
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import BASE_URL, catalogue, manifest_frame, rows_of, write_gz, write_snapshot
from reelstrata.session import as_bytes, configure, scratch_path, size_shuffles
from reelstrata.sources import freeze, manifest, tables
from reelstrata.sources.inventory import file_digests, inventory, line_counts, line_digests
from reelstrata.sources.registry import FILE_COLUMNS, SOURCES, registry_frame

ENTRY = {
    "dataset": "d", "file_name": "f", "table_name": "t", "url": "u", "size_bytes": 42,
    "row_count": None, "sha256": "s", "downloaded_at": "w", "batch_id": "b", "etag": None,
    "last_modified": None, "content_type": None,
}


def documents(spark, tmp_path, value):
    path = tmp_path / "manifest.json"
    path.write_text(value if isinstance(value, str) else json.dumps(value, indent=2))
    return manifest.read_documents(spark, str(path))


def problems(docs):
    found = manifest.document_violations(docs).unionByName(
        manifest.entry_violations(manifest.entries_of(docs))
    )
    found = found.unionByName(manifest.duplicate_entries(manifest.entries_of(docs)))
    return sorted((r["check"], r["key"], r["detail"]) for r in found.collect())


def test_good_manifest(spark, tmp_path):
    docs = documents(spark, tmp_path, {"version": 1, "entries": [ENTRY]})
    assert problems(docs) == []
    assert manifest.entries_of(docs).first().asDict() == ENTRY


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ([], ("manifest_document", "document", "not a JSON object")),
        ({"version": 999, "entries": []}, ("manifest_document", "document", "unsupported version")),
        ({"entries": []}, ("manifest_document", "document", "unsupported version")),
        ({"version": 1}, ("manifest_document", "document", "no entries array")),
        ({"version": 1, "entries": {}}, ("manifest_document", "document", "no entries array")),
    ],
)
def test_bad_documents(spark, tmp_path, value, expected):
    assert problems(documents(spark, tmp_path, value)) == [expected]


@pytest.mark.parametrize(
    ("change", "keys"),
    [
        ({"sha256": ""}, {"sha256"}),
        ({"url": None}, {"url"}),
        ({"url": 5}, {"url"}),
        ({"size_bytes": -1}, {"size_bytes"}),
        ({"size_bytes": True}, {"size_bytes"}),
        ({"size_bytes": "42"}, {"size_bytes"}),
        ({"size_bytes": 1.5}, {"size_bytes"}),
        ({"row_count": -1}, {"row_count"}),
        ({"row_count": "1"}, {"row_count"}),
        ({"etag": 7}, {"etag"}),
    ],
)
def test_bad_fields(spark, tmp_path, change, keys):
    docs = documents(spark, tmp_path, {"version": 1, "entries": [{**ENTRY, **change}]})
    assert {key for _, key, _ in problems(docs)} == keys


def test_incomplete_entry_and_duplicates(spark, tmp_path):
    docs = documents(spark, tmp_path, {"version": 1, "entries": [{"dataset": "d"}, 5]})
    assert len(problems(docs)) == 2 * 8 - 1
    docs = documents(spark, tmp_path, {"version": 1, "entries": [ENTRY, ENTRY]})
    assert problems(docs) == [("manifest_duplicate", "t", "2 rows")]


def test_malformed_and_absent_manifest(spark, tmp_path):
    with pytest.raises(Exception, match="MALFORMED"):
        problems(documents(spark, tmp_path, "{bad"))
    assert manifest.read_manifest(spark, str(tmp_path / "none.json")).isEmpty()


def test_upsert_backfill_and_round_trip(spark, tmp_path):
    def rows(*changes):
        entries = [{**ENTRY, **change} for change in changes]
        return manifest_frame(spark, [tuple(e[c] for c in FILE_COLUMNS) for e in entries])

    old = rows({"table_name": "b", "file_name": "fb"}, {"table_name": "c", "file_name": "fc"})
    new = rows({"table_name": "b", "file_name": "fb", "size_bytes": 1}, {"table_name": "a"})
    merged = manifest.upsert(old, new)
    assert rows_of(merged.select("table_name", "size_bytes")) == [("a", 42), ("b", 1), ("c", 42)]
    counts = spark.createDataFrame([("fb", 9)], "file_name string, row_count long")
    filled = manifest.backfill_row_counts(merged, counts)
    assert dict(rows_of(filled.select("table_name", "row_count"))) == {"a": None, "b": 9, "c": None}
    path = str(tmp_path / "stored")
    manifest.write_manifest(filled, path)
    assert problems(manifest.read_documents(spark, path)) == []
    assert rows_of(manifest.read_manifest(spark, path)) == rows_of(filled.orderBy("table_name"))


def test_snapshot_rules(spark, tmp_path):
    registry = registry_frame(spark, BASE_URL)
    entries = manifest_frame(spark, write_snapshot(tmp_path))
    assert manifest.snapshot_violations(entries, registry).isEmpty()
    assert manifest.snapshot_violations(entries.limit(0), registry).count() == 7
    other = entries.withColumn(
        "table_name", F.when(F.col("table_name") == "title_crew", "extra").otherwise(F.col("table_name"))
    )
    found = manifest.completeness_violations(other, registry)
    assert sorted(rows_of(found.select("relation", "detail"))) == [
        ("extra", "unexpected"), ("title_crew", "missing")
    ]
    moved = entries.withColumn("url", F.lit("elsewhere"))
    assert manifest.metadata_violations(moved, registry).count() == 7


def test_inventory_and_reuse(spark, tmp_path):
    rows = write_snapshot(tmp_path)
    crew = SOURCES["title_crew"]
    digests = file_digests(spark, str(tmp_path), "*.tsv.gz").drop("path")
    assert {tuple(r) for r in digests.collect()} == {
        (f.name, f.stat().st_size, hashlib.sha256(f.read_bytes()).hexdigest()) for f in tmp_path.glob("*.tsv.gz")
    }
    registry = registry_frame(spark, BASE_URL)

    def statuses(entries):
        found = inventory(spark, str(tmp_path), "*.tsv.gz")
        judged = manifest.reuse_status(registry, manifest_frame(spark, entries), found)
        return {r["table_name"]: (r["status"], r["row_count"]) for r in judged.collect()}

    assert statuses(rows) == {name: ("reuse", len(lines)) for name, lines in catalogue().items()}
    assert statuses(rows[:-1])["name_basics"] == ("no entry", None)
    changed = [(*r[:3], "elsewhere", *r[4:]) if r[2] == "title_crew" else r for r in rows]
    assert statuses(changed)["title_crew"] == ("metadata differs", None)
    changed = [(*r[:6], "0" * 64, *r[7:]) if r[2] == "title_crew" else r for r in rows]
    assert statuses(changed)["title_crew"] == ("checksum differs", None)
    path = write_gz(tmp_path / crew.file_name, "TCONST\tdirectors\twriters\n" + crew.header_line)
    data = path.read_bytes()
    digest = hashlib.sha256(data).hexdigest()
    changed = [
        (*r[:4], len(data), None, digest, *r[7:]) if r[2] == "title_crew" else r for r in rows
    ]
    assert statuses(changed)["title_crew"] == ("header differs", None)
    path.unlink()
    assert statuses(rows)["title_crew"] == ("file missing", None)


def test_digests_are_those_of_the_stored_bytes(spark, tmp_path):
    dice = random.Random(11)
    mark = b"\xef\xbb\xbf"
    contents = [
        b"", b"\n", b"a", b"a\r\nb", b"\n\n\n", mark, mark + b"a\n", mark + mark + b"\n", mark[:2], dice.randbytes(3 << 20),
        gzip.compress(b"packed " * 10_000), b"x" * (5 << 20), b"0123456789abcdef\n" * (4 << 20),
    ]
    for place, content in enumerate(contents):
        (tmp_path / f"file {place} %20=\u00e9.gz").write_bytes(content)
    (tmp_path / "other.txt").write_bytes(b"not listed")
    # the last file is larger than what one task reads of a file in pieces
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        found = {r["file_name"]: (r["size_bytes"], r["sha256"]) for r in file_digests(spark, str(tmp_path), "*.gz").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {
        f"file {place} %20=\u00e9.gz": (len(content), hashlib.sha256(content).hexdigest())
        for place, content in enumerate(contents)
        if content
    }
    with pytest.raises(ValueError, match="plain extension"):
        file_digests(spark, str(tmp_path), "*")


def test_a_large_file_is_hashed_like_a_small_one(spark, tmp_path):
    path, digest = tmp_path / "large.bin", hashlib.sha256()
    dice = random.Random(5)
    block = dice.randbytes(1 << 20)
    with path.open("wb") as out:
        for place in range(96):
            piece = place.to_bytes(4, "big") + block
            out.write(piece)
            digest.update(piece)
    assert rows_of(file_digests(spark, str(tmp_path), "*.bin").select("size_bytes", "sha256")) == [
        (path.stat().st_size, digest.hexdigest())
    ]


def test_line_counts(spark, tmp_path):
    head = SOURCES["title_crew"].header_line
    for name, text in {
        "a": f"{head}\nx\n\ny\n", "b": f"{head}\r\nx\r\ny", "c": head, "d": f"x\n{head}\n", "e": ""
    }.items():
        write_gz(tmp_path / f"{name}.gz", text)
    write_gz(tmp_path / "f.gz", f"{head}\nx\n{head}\n")
    counted = line_counts(spark, str(tmp_path), header=head)
    assert sorted(rows_of(counted)) == [
        ("a.gz", 3, True, 1), ("b.gz", 2, True, 1), ("c.gz", 0, True, 1), ("d.gz", 1, False, 1), ("f.gz", 2, True, 2)
    ]


def test_plain_text_blocks_have_one_header(spark, tmp_path):
    head = SOURCES["title_crew"].header_line
    (tmp_path / "plain.tsv").write_text(head + "\n" + "a\tb\tc\n" * 5000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert rows_of(line_counts(spark, str(tmp_path), header=head)) == [
            ("plain.tsv", 5000, True, 1)
        ]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_compaction_keeps_rows_in_fewer_files(spark, tmp_path):
    source, target = str(tmp_path / "small"), str(tmp_path / "packed")
    spark.createDataFrame([(1, "a")], "v int, s string").write.parquet(source)
    spark.createDataFrame([(2, None)], "v int, s string").write.mode("append").parquet(source)
    spark.range(50).select(F.col("id").cast("int").alias("v"), F.lit("z").alias("s")).repartition(
        20
    ).write.mode("append").parquet(source)
    packed = tables.compact(spark, source, target)
    assert sorted(rows_of(packed), key=str) == sorted(rows_of(spark.read.parquet(source)), key=str)
    assert len(list((tmp_path / "packed").glob("*.parquet"))) == 1
    with pytest.raises(ValueError, match="new path"):
        tables.compact(spark, source, source)


def test_lookup_tables_carry_bloom_filters_and_sorted_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    rows = spark.range(1000).select(
        F.concat(F.lit("n"), F.xxhash64("id").cast("string")).alias("nconst"), "id"
    )
    tables.write_table(rows.coalesce(1), str(tmp_path / "t"), lookup="nconst", sort=("id",))
    (file,) = (tmp_path / "t").glob("*.parquet")
    stored = pq.read_table(file).column("nconst").to_pylist()
    assert stored == sorted(stored) and len(stored) == 1000


def test_build_ids_and_publications(spark, tmp_path):
    moment = datetime(1999, 3, 4, 5, 6, tzinfo=timezone.utc)
    assert tables.new_build_id(moment, "abc123") == "19990304T050600Z-abc123"
    root = str(tmp_path / "lake")
    assert tables.current_build(spark, root) is None and tables.current_version(spark, root) == 0
    # the clock of the second publisher is behind
    for version, (name, minute) in enumerate([("one", 9), ("two", 3), ("one", 1)]):
        assert tables.publish(spark, tables.Build(root, name), version, moment.replace(minute=minute)) == version + 1
        assert tables.current_build(spark, root) == tables.Build(root, name)
    assert [r["build_id"] for r in tables.published_builds(spark, root).collect()] == ["one", "two", "one"]


def test_only_one_publication_follows_a_version(spark, tmp_path):
    root = str(tmp_path / "lake")
    mine, other = tables.Build(root, "mine"), tables.Build(root, "other")
    assert tables.publish(spark, mine, 0) == 1
    with pytest.raises(tables.PublishConflict, match="no longer current"):
        tables.publish(spark, other, 0)
    # the number was free when it was looked up, and taken when it was written
    with pytest.raises(tables.PublishConflict, match="by another build"):
        tables._create(spark, f"{root}/published/{1:012d}.json", "{}")
    # a publisher that stopped half way leaves a number without a build
    (tmp_path / "lake/published/000000000002.json").write_text('{"build_id": "ha')
    assert tables.current_version(spark, root) == 1
    assert tables.publish(spark, other, 1) == 3
    # an entry that names a version which is no longer in force never counts
    late = {"build_id": "late", "published_at": "x", "version": 4, "based_on": 1}
    (tmp_path / "lake/published/000000000004.json").write_text(json.dumps(late))
    assert tables.current_build(spark, root) == other
    assert tables.publish(spark, mine, 3) == 5


def test_schema_changes(spark):
    stored = spark.createDataFrame(
        [("t", 1, "a", "string", 3), ("t", 2, "b", "string", 3), ("t", 3, "c", "int", 3), ("u", 1, "a", "string", 1)],
        freeze.VERSIONED_ROW,
    )
    incoming = spark.createDataFrame(
        [("t", 2, "a", "string"), ("t", 1, "c", "long"), ("t", 3, "d", "int"), ("u", 1, "a", "string"), ("new", 1, "z", "int")],
        freeze.SCHEMA_ROW,
    )
    assert sorted(rows_of(freeze.schema_changes(stored, incoming))) == [
        ("schema_frozen", "t", "a", "moved 1 to 2"), ("schema_frozen", "t", "b", "removed"),
        ("schema_frozen", "t", "c", "type int to long"), ("schema_frozen", "t", "d", "added"),
    ]
    assert freeze.frozen_changes(stored, incoming, ["t"]).isEmpty()
    versions = freeze.next_schemas(stored, incoming).select("table_name", "schema_version").distinct()
    assert dict(rows_of(versions)) == {"t": 4, "u": 1, "new": 1}


def test_sizes_follow_the_input(spark):
    before = {
        key: spark.conf.get(key)
        for key in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    }
    try:
        assert size_shuffles(spark, 1000) == int(before["spark.sql.shuffle.partitions"])
        assert size_shuffles(spark, 100 * 1024**4) == 204_800
        assert int(spark.conf.get("spark.sql.files.maxPartitionBytes")) > 512 * 1024**2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_scratch_is_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(f"{shared}/x-") and first != second


def test_packed_files_have_the_digests_of_their_lines(spark, tmp_path):
    lines = [[f"{n} line", "", "é" * n] * 40 for n in range(1, 4)]
    for n, content in enumerate(lines):
        write_gz(tmp_path / f"f{n}.txt.gz", "\n".join(content) + ("\n" if n else ""))
    write_gz(tmp_path / "empty.txt.gz", "")
    whole = ["".join(f"{line}\n" for line in content).encode() for content in lines]
    found = {r["file_name"]: (r["size_bytes"], r["sha256"]) for r in line_digests(spark, str(tmp_path), "*.txt.gz").collect()}
    assert found == {f"f{n}.txt.gz": (len(w), hashlib.sha256(w).hexdigest()) for n, w in enumerate(whole)}
    (tmp_path / "plain.txt").write_bytes(b"a line of a file\n" * 50_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        with pytest.raises(Exception, match="is read in pieces"):
            line_digests(spark, str(tmp_path), "*.txt").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_the_file_inventory_stores_no_long_lines(spark, tmp_path):
    from workload.cases import QUERIES

    orders = [(n, "F" if n % 2 else "O", f"{n % 5}-HIGH") for n in range(3000)]
    frame = spark.createDataFrame(orders, "o_orderkey long, o_orderstatus string, o_orderpriority string")
    frame.write.parquet(str(tmp_path / "orders.parquet"))
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.glob("lines-*"))
    found = {r["part"]: (r["size_bytes"], r["sha256"]) for r in QUERIES["file_inventory"](spark, str(tmp_path)).collect()}
    wanted = {}
    for status in "FO":
        text = [f"{key} {priority}" for key, kind, priority in orders if kind == status]
        whole = "".join(f"{t} " * 600 + "\n" if status == "F" else f"{t}\n" for t in text).encode()
        wanted[f"status={status}"] = (len(whole), hashlib.sha256(whole).hexdigest())
    assert found == wanted
    stored = [f for folder in set(shared.glob("lines-*")) - before for f in folder.rglob("*.txt*")]
    assert stored and sum(f.stat().st_size for f in stored) < sum(size for size, _ in wanted.values()) / 20


def test_a_large_manifest_is_written_as_several_documents(spark, tmp_path, monkeypatch):
    rows = [{**ENTRY, "table_name": f"t{n:04d}", "file_name": f"f{n}", "size_bytes": n} for n in range(600)]
    entries = manifest_frame(spark, [tuple(e[c] for c in FILE_COLUMNS) for e in rows])
    monkeypatch.setattr(manifest, "DOCUMENT_BYTES", 20_000)
    path = tmp_path / "many"
    manifest.write_manifest(entries, str(path))
    sizes = [f.stat().st_size for f in path.glob("*.json")]
    assert len(sizes) > 4 and max(sizes) < 40_000
    documents = manifest.read_documents(spark, str(path))
    assert documents.count() == len(sizes) and problems(documents) == []
    assert sorted(rows_of(manifest.read_manifest(spark, str(path)))) == sorted(rows_of(entries))
    manifest.write_manifest(entries.limit(0), str(path))
    assert manifest.read_documents(spark, str(path)).count() == 1 and manifest.read_manifest(spark, str(path)).isEmpty()


def test_tasks_stay_small_as_the_input_grows(spark):
    try:
        assert size_shuffles(configure(spark), 6 * 1024**3) == 768
        assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "768"
        assert as_bytes(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) == 16 * 1024**2
        assert as_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")) == 32 * 1024**2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
