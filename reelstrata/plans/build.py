"""Write, audit, publish: one snapshot becomes one isolated build, exposed only if all checks pass."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstrata.operators.checks import row_counts
from reelstrata.plans import audit, queries
from reelstrata.plans.intermediate import ROLLUPS, intermediate_all
from reelstrata.plans.marts import CONTRACTS, marts_all
from reelstrata.plans.staging import stage_all
from reelstrata.session import configure, size_shuffles
from reelstrata.sources import buckets, catalog, freeze, tables
from reelstrata.sources import manifest as manifests
from reelstrata.sources.inventory import inventory
from reelstrata.sources.registry import SOURCES, registry_frame
from reelstrata.sources.tables import Build, current_build, current_version, publish, write_table
from reelstrata.sources.tsv import Landing, land

# Text is several times its gzip size once decompressed.
GZIP_EXPANSION = 6

# Point queries filter the marts on these columns.
LOOKUPS = {
    "mart_person_filmography": ("nconst", ("tconst", "ordering")),
    "mart_series_episodes": ("series_tconst", ("season_number", "episode_number")),
    "mart_title_search": ("tconst", ()),
    "mart_genre_year_summary": ("genre", ("start_year", "title_type")),
}

Relations = dict[str, dict[str, DataFrame]]
Step = Callable[[str], None]
T = TypeVar("T")


class SnapshotError(RuntimeError):
    """The raw files and their manifest do not make up one complete verified snapshot."""


@dataclass(frozen=True)
class BuildResult:
    build: Build
    load_id: str
    relation_count: int
    mart_row_counts: dict[str, int]


def _nothing(_: str) -> None:
    return None


def _each(names: Iterable[str], job: Callable[[str], T]) -> dict[str, T]:
    """Run one independent Spark job per name at the same time, so that jobs of a single long task
    (a gzip file) or with a thin last stage do not leave the cluster idle."""
    names = list(names)
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        return dict(zip(names, pool.map(job, names), strict=True))


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Entries of the manifest at `path`, refused as a whole if the document is unsound."""
    documents = manifests.read_documents(spark, path)
    problems = manifests.document_violations(documents).collect()
    if problems:
        raise SnapshotError("; ".join(f"{p['key']}: {p['detail']}" for p in problems))
    return manifests.entries_of(documents)


def verify_snapshot(
    spark: SparkSession, entries: DataFrame, raw_dir: str, base_url: str
) -> DataFrame:
    """Entries with counted rows, once the manifest is sound and every file matches it."""
    registry = registry_frame(spark, base_url)
    problems = manifests.snapshot_violations(entries, registry).collect()
    if problems:
        listed = "; ".join(f"{p['relation']} {p['key']}: {p['detail']}" for p in problems)
        raise SnapshotError(f"manifest: {listed}")
    statuses = manifests.reuse_status(
        registry, entries, inventory(spark, raw_dir, "*.tsv.gz")
    ).collect()
    refused = [f"{s['file_name']}: {s['status']}" for s in statuses if s["status"] != "reuse"]
    if refused:
        raise SnapshotError("; ".join(sorted(refused)))
    counts = spark.createDataFrame(
        [(s["file_name"], s["row_count"]) for s in statuses], "file_name string, row_count long"
    )
    return manifests.backfill_row_counts(entries, counts)


def load_raw(
    spark: SparkSession, entries: DataFrame, raw_dir: str, build: Build, load_id: str
) -> dict[str, DataFrame]:
    """Land the seven verified files and their lineage table, replacing whatever the build held.

    Every table must hold as many rows as its entry says were counted in its file.
    """

    def landed(name: str) -> Landing:
        path = f"{raw_dir.rstrip('/')}/{SOURCES[name].file_name}"
        target = build.location("raw", name)
        return land(spark, path, SOURCES[name], load_id, target)

    landings = _each(SOURCES, landed)
    known = entries.where(F.col("table_name").isin(*SOURCES)).select("table_name", "row_count")
    counted = {r["table_name"]: r["row_count"] for r in known.collect()}
    for name, landing in landings.items():
        if counted.get(name) not in (None, landing.row_count):
            raise SnapshotError(f"{name}: {landing.row_count} rows from {counted[name]} lines")
    raw = {name: landing.rows for name, landing in landings.items()}
    raw["ingestion_files"] = write_table(
        manifests.file_lineage(entries, load_id).coalesce(1),
        build.location("raw", "ingestion_files"),
    )
    return raw


def model(raw: dict[str, DataFrame]) -> Relations:
    """Every relation of a build as lazy frames over its raw tables."""
    staged = stage_all(raw)
    models = intermediate_all(staged)
    return {"raw": raw, "staging": staged, "intermediate": models, "marts": marts_all(models)}


def open_build(spark: SparkSession, build: Build) -> Relations:
    """All relations of a finished build: stored tables scanned, the others as lazy frames."""
    scan = catalog.Scanner(spark, build)
    raw = {name: scan("raw", name) for name in audit.REQUIRED["raw"]}
    staged = stage_all(raw)
    models = intermediate_all(staged)
    for name in ROLLUPS:
        models[name] = scan("intermediate", name)
    marts = {name: scan("marts", name) for name in CONTRACTS}
    return {"raw": raw, "staging": staged, "intermediate": models, "marts": marts}


# Models with one row per title, which four joins of the search mart and two of each other mart read.
BY_TITLE = ("dim_titles", "fct_title_ratings", *ROLLUPS)


def bucketed_models(
    models: Mapping[str, DataFrame], build: Build, count: int, names: Iterable[str] = BY_TITLE
) -> dict[str, DataFrame]:
    """The models of one row per title, stored in buckets of the title key: marts join them without an exchange."""

    def bucketed(name: str) -> DataFrame:
        return buckets.write_bucketed(models[name], build.location("buckets", name), "tconst", count)

    return {**models, **_each(names, bucketed)}


def mart_row_counts(marts: dict[str, DataFrame]) -> dict[str, int]:
    return {r["relation_name"]: r["row_count"] for r in row_counts(marts).collect()}


def relation_tables() -> dict[str, str]:
    """Every relation that a build stores, with its schema; the other relations are derived from them."""
    layers = {"raw": audit.REQUIRED["raw"], "intermediate": ROLLUPS, "marts": CONTRACTS}
    return {name: schema for schema, names in layers.items() for name in names}


def stored_tables() -> dict[str, str]:
    """Every table that a build stores: its relations, and the schemas of its raw tables."""
    return {**relation_tables(), freeze.STORED[1]: freeze.STORED[0]}


def missing_tables(spark: SparkSession, build: Build) -> list[str]:
    """Stored tables that cannot be read back."""
    lost, scan = [], catalog.Scanner(spark, build)
    for name, schema in stored_tables().items():
        try:
            scan(schema, name)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            lost.append(f"{schema}.{name}")
    return sorted(lost)


def absent_relations(relations: Relations) -> list[str]:
    return [
        f"{schema}.{name}"
        for schema, names in audit.REQUIRED.items()
        for name in names
        if name not in relations.get(schema, {})
    ]


def validate(
    spark: SparkSession, build: Build, *, marts_not_empty: bool = False
) -> tuple[Relations, dict[str, int]]:
    """The relations of a build as they are read back, and the rows of its marts.

    All required relations must be there, raw tables have the registered headers, marts match their contracts and can be read; with `marts_not_empty` each must also hold a row.
    """
    lost = missing_tables(spark, build)
    if lost:
        raise audit.AuditError(f"missing: {lost}")
    scan = catalog.Scanner(spark, build)
    raw = {name: scan("raw", name) for name in SOURCES}
    audit.gate("raw", audit.totals(audit.raw_schema_findings(spark, raw)))
    relations = open_build(spark, build)
    lost = absent_relations(relations)
    if lost:
        raise audit.AuditError(f"missing: {lost}")
    audit.gate("marts", audit.totals(audit.contract_findings(spark, relations["marts"])))
    for name, rows in relations["marts"].items():
        queries.probe(name, rows).collect()
    counts = mart_row_counts(relations["marts"])
    empty = sorted(name for name, rows in counts.items() if not rows)
    if marts_not_empty and empty:
        raise audit.AuditError(f"empty: {empty}")
    return relations, counts


def frozen_schemas(spark: SparkSession, build: Build, may_change: Collection[str] = ()) -> DataFrame:
    """The schemas that a load into `build` will land, with their versions; refused if they differ from the published ones."""
    stored = freeze.stored_schemas(spark, current_build(spark, build.root))
    incoming = freeze.schema_rows(spark, freeze.registered_schemas())
    audit.gate("raw", audit.totals(freeze.frozen_changes(stored, incoming, may_change)))
    return freeze.next_schemas(stored, incoming)


def build_snapshot(
    spark: SparkSession,
    *,
    raw_dir: str,
    entries: DataFrame,
    base_url: str,
    build: Build,
    load_id: str,
    marts_not_empty: bool = False,
    may_change: Collection[str] = (),
    title_buckets: int = 0,
    on_stage: Step = _nothing,
) -> BuildResult:
    """Run the whole flow for one snapshot. A failure anywhere leaves the current build as it is.

    Columns of raw tables must be those of the published build, but for tables that `may_change`; that is known before
    a row is landed. With `title_buckets` the marts are computed from models stored in so many buckets. If another build is published meanwhile, this one is not. With `marts_not_empty`, as for a full snapshot, a mart without rows fails the build.
    Each layer is audited before the next one is computed from it, and every stored layer is read
    back from the shared build folder, so a lost executor recomputes one layer at most.
    """
    configure(spark)
    on_stage("verify")
    based_on = current_version(spark, build.root)
    schemas = frozen_schemas(spark, build, may_change)
    verified = verify_snapshot(spark, entries, raw_dir, base_url)
    packed = verified.agg(F.sum("size_bytes")).first()[0]
    size_shuffles(spark, packed * GZIP_EXPANSION)

    on_stage("ingest")
    freeze.store_schemas(schemas, build)
    raw = load_raw(spark, verified, raw_dir, build, load_id)
    relations: Relations = {"raw": raw, "staging": stage_all(raw)}

    on_stage("staging")
    audit.audit("staging", relations)

    on_stage("intermediate")
    models = intermediate_all(relations["staging"])
    models |= _each(
        ROLLUPS, lambda name: write_table(models[name], build.location("intermediate", name))
    )
    relations["intermediate"] = models
    audit.audit("intermediate", relations)

    on_stage("marts")
    marts = marts_all(bucketed_models(models, build, title_buckets) if title_buckets else models)

    def stored(name: str) -> DataFrame:
        lookup, sort = LOOKUPS[name]
        path = build.location("marts", name)
        return write_table(marts[name], path, lookup=lookup, sort=sort)

    relations["marts"] = _each(marts, stored)
    audit.audit("marts", relations)

    on_stage("validate")
    relations, rows = validate(spark, build, marts_not_empty=marts_not_empty)

    on_stage("publish")
    write_catalog(spark, build, relations)
    publish(spark, build, based_on)
    audit.register(relations)
    return BuildResult(build, load_id, sum(map(len, audit.REQUIRED.values())), rows)


def write_catalog(spark: SparkSession, build: Build, relations: Relations) -> None:
    """Store what the build consists of, with the range of the lookup key in each file of a mart."""
    keys = {name: lookup for name, (lookup, _) in LOOKUPS.items()}
    catalog.write_catalog(spark, build, relations, relation_tables(), keys)


def compact_build(
    spark: SparkSession, source: Build, target: Build, file_bytes: int = tables.FILE_BYTES
) -> Relations:
    """The relations of a build in fewer files under a new build id; files that are full already stay where they are."""
    scan, stored = catalog.Scanner(spark, source), stored_tables()

    def packed(name: str) -> DataFrame:
        lookup, sort = LOOKUPS.get(name, (None, ()))
        if (stored[name], name) in scan.columns:
            return scan(stored[name], name)
        new = target.location(stored[name], name)
        return tables.compact(spark, scan.source(stored[name], name), new, lookup=lookup, sort=sort, file_bytes=file_bytes)

    relations = open_build(spark, source)
    for name, frame in _each(relation_tables(), packed).items():
        relations[stored[name]][name] = frame
    freeze.store_schemas(freeze.stored_schemas(spark, source), target)
    write_catalog(spark, target, relations)
    return open_build(spark, target)


def checkpoint_current(spark: SparkSession, root: str, build_id: str) -> Build:
    """Compact the current build into a new one and publish that; readers never see half of it."""
    based_on, current = current_version(spark, root), current_build(spark, root)
    if current is None:
        raise SnapshotError(f"nothing is published under {root}")
    packed = Build(root, build_id)
    compact_build(spark, current, packed)
    relations, _ = validate(spark, packed)
    publish(spark, packed, based_on)
    audit.register(relations)
    return packed
