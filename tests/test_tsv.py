import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from conftest import rows_of, write_gz
from reelstrata.sources.registry import LOAD_ID, SOURCES, Source
from reelstrata.sources.tsv import land, read_tsv

PAIR = Source("pairs", "pairs", "pairs.tsv.gz", ("id", "v"))


def scan(spark, tmp_path, text, name="pairs.tsv.gz"):
    return rows_of(read_tsv(spark, str(write_gz(tmp_path / name, text)), PAIR))


def test_every_character_survives(spark, tmp_path):
    fields = ["\\N", "", '"open', 'a"b', "  pad  ", "back\\slash\\", "é東京", "#c", "NULL", "'"]
    text = "id\tv\n" + "".join(f"{i}\t{v}\n" for i, v in enumerate(fields))
    assert scan(spark, tmp_path, text) == [(str(i), v) for i, v in enumerate(fields)]


def test_random_text_survives(spark, tmp_path):
    dice = random.Random(7)
    letters = [c for c in map(chr, range(1, 0x250)) if c not in "\t\n\r"] + list("東京\U0001f3ac\\\"'")
    rows = [
        (str(i), "".join(dice.choices(letters, k=dice.randrange(12)))) for i in range(3000)
    ]
    text = "id\tv\n" + "".join(f"{i}\t{v}\n" for i, v in rows)
    assert scan(spark, tmp_path, text) == rows


def test_empty_key_and_missing_last_newline(spark, tmp_path):
    assert scan(spark, tmp_path, "id\tv\n\tx\n2\ty") == [("", "x"), ("2", "y")]


def test_blank_fields_and_control_characters_survive(spark, tmp_path):
    rows = [("", ""), (" ", "  "), ("\0a\0", "\0"), ("\r", "x\ry"), ("\x0b", "\x1c"), ("", " ")]
    text = "id\tv\n" + "".join(f"{a}\t{b}\n" for a, b in rows)
    assert scan(spark, tmp_path, text) == rows


def test_wrong_lines_fail_a_count_too(spark, tmp_path):
    path = write_gz(tmp_path / "pairs.tsv.gz", "id\tv\n1\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_tsv(spark, str(path), PAIR).count()


def test_carriage_returns_end_lines(spark, tmp_path):
    assert scan(spark, tmp_path, "id\tv\r\n1\t2\r\n") == [("1", "2")]


@pytest.mark.parametrize(
    "text",
    [
        "id\tv\n1\n", "id\tv\n1\t2\t3\n", "v\tid\n1\t2\n", "id\tw\n1\t2\n", "id\tv\textra\n1\t2\t3\n",
        "id\tv\n1\t2\nid\tv\n", "id\tv\n1\t2\n\n", "\nid\tv\n1\t2\n",
    ],
    ids=[
        "short line", "long line", "order", "name", "extra column", "header again", "empty line",
        "late header",
    ],
)
def test_malformed_text_fails(spark, tmp_path, text):
    with pytest.raises((PySparkException, Py4JJavaError, ValueError)):
        scan(spark, tmp_path, text)


def test_header_case_is_exact_when_landing(spark, tmp_path):
    path = str(write_gz(tmp_path / "in" / "pairs.tsv.gz", "ID\tv\n1\t2\n"))
    with pytest.raises((PySparkException, Py4JJavaError), match="as its first line"):
        land(spark, path, PAIR, "load", str(tmp_path / "out"))


def test_folder_of_files_lands_as_one_table(spark, tmp_path):
    for part in range(3):
        write_gz(tmp_path / "in" / f"part-{part}.tsv.gz", f"id\tv\n{part}\t\n{part}\t\\N\n")
    target = str(tmp_path / "out")
    landing = land(spark, str(tmp_path / "in"), PAIR, "load", target)
    rows = landing.rows
    assert landing.row_count == 6
    assert sorted(rows_of(rows)) == [
        (str(p), v, "load") for p in range(3) for v in ("", "\\N")
    ]
    assert rows.dtypes == [("id", "string"), ("v", "string"), (LOAD_ID, "string")]


def test_lines_like_the_header_are_rows_when_landing(spark, tmp_path):
    for part in range(5):
        write_gz(tmp_path / "in" / f"part-{part}.tsv.gz", f"id\tv\n{part}\tx\nid\tv\nid\tv\n")
    landing = land(spark, str(tmp_path / "in"), PAIR, "load", str(tmp_path / "out"))
    assert landing.row_count == 15
    assert sorted(rows_of(landing.rows.groupBy("id").count())) == [*((str(p), 1) for p in range(5)), ("id", 10)]


@pytest.mark.parametrize(
    "text", ["v\tid\n1\t2\n", "1\t2\nid\tv\n", "id\tv\n1\n", "id\tv\n\n", "\nid\tv\n1\t2\n", ""],
    ids=["order", "late header", "short line", "empty line", "empty first line", "no line"],
)
def test_malformed_files_do_not_land(spark, tmp_path, text):
    write_gz(tmp_path / "in" / "a.tsv.gz", "id\tv\n1\t2\n")
    write_gz(tmp_path / "in" / "b.tsv.gz", text)
    with pytest.raises((PySparkException, Py4JJavaError, ValueError)):
        land(spark, str(tmp_path / "in"), PAIR, "load", str(tmp_path / "out"))


def test_plain_text_lands_in_pieces(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in "ab":
        (tmp_path / "in" / f"{name}.tsv").write_text("id\tv\n" + "".join(f"{name}{i}\tid\n" for i in range(4_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        landing = land(spark, str(tmp_path / "in"), PAIR, "load", str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert landing.row_count == landing.rows.distinct().count() == 8_000


def test_landing_reads_the_text_once(spark, tmp_path):
    write_gz(tmp_path / "in" / "a.tsv.gz", "id\tv\n" + "1\t2\n" * 50)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("landing", "landing")
    try:
        landing = land(spark, str(tmp_path / "in"), PAIR, "load", str(tmp_path / "out"))
        jobs = tracker.getJobIdsForGroup("landing")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # the listing, and the write with or without its own shuffle
    assert landing.row_count == 50 and len(jobs) <= 4


def test_plain_text_is_read_like_gzip(spark, tmp_path):
    path = tmp_path / "pairs.tsv"
    path.write_text('id\tv\n1\t"x\n', encoding="utf-8")
    assert rows_of(read_tsv(spark, str(path), PAIR)) == [("1", '"x')]


def test_registry_is_consistent():
    assert len(SOURCES) == 7
    assert len({s.file_name for s in SOURCES.values()}) == 7
    assert len({s.dataset for s in SOURCES.values()}) == 7
    for source in SOURCES.values():
        assert len(set(source.headers)) == len(source.headers)
        assert source.url("https://x/") == f"https://x/{source.file_name}"
