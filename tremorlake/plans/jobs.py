"""Batch jobs: compositions of sources, operators and sinks a user submits.

Each layer is written by one action, which counts what it writes. A job takes the staged documents as a frame
with one text column `value` (see `read_staged`).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tremorlake.operators import canonical, nullable
from tremorlake.operators.audit import (
    NO_DATA,
    NO_FRAME,
    AuditTrail,
    ensure_audit_table,
    observe_count,
)
from tremorlake.operators.shape import conform_schema
from tremorlake.schemas import AUDITED, NULLABLE
from tremorlake.sources import layers as L
from tremorlake.sources import tables as T

NO_DOCUMENT = "no document staged"
NO_SILVER = "this run has saved no silver"
TRUNCATE = "truncate"
APPEND = "append"


@dataclass(frozen=True)
class LoadResult:
    """Where a load left its data. `landed` is False if there was no document.

    The quarantine of a canonical load has the documents and features that its
    error rule drops, as many as the counts say.
    """

    landed: bool
    bronze: str
    silver: str | None
    table: str
    quarantine: str | None = None
    lost_documents: int = 0
    lost_features: int = 0


def _load_gold(silver: DataFrame, table: str, schema: StructType, disposition: str, load_id: str | None = None) -> None:
    T.ensure_namespace_of(silver.sparkSession, table)
    if disposition == TRUNCATE:
        T.truncate_and_load(silver, table, schema)
    elif disposition == APPEND:
        T.append_by_name(silver, table, schema, load_id)
    else:
        raise ValueError(f"unknown write disposition {disposition!r}")


def nullable_load(
    documents: DataFrame,
    root: str,
    feed: str,
    run_date: dt.date,
    table: str,
    disposition: str = TRUNCATE,
    as_of: dt.datetime | None = None,
    spread: int | None = None,
    load_id: str | None = None,
) -> LoadResult:
    """Land, flatten, transform, write silver and load gold under nullable rules.

    Without a new document the load goes on with the bronze of that date, if
    there is one. `spread` deals the rows of large documents over that many tasks.
    An append under a `load_id` may be run again, see `append_by_name`.
    """
    spark = documents.sparkSession
    paths = L.Layers(root, "nullable", feed, run_date)
    landed = L.land_bronze(documents, paths.bronze)
    flat = nullable.flatten(L.read_bronze_json(spark, paths.bronze))
    flat = flat.repartition(spread) if spread else flat
    L.write_silver(nullable.transform_columns(flat, as_of), paths.silver)
    _load_gold(L.read_silver(spark, paths.silver, NULLABLE), table, NULLABLE, disposition, load_id)
    return LoadResult(landed, paths.bronze, paths.silver, table)


def historical_load(documents: DataFrame, root: str, run_date: dt.date, table: str, **options) -> LoadResult:
    """The nullable load of the historical feed; replaces the table."""
    return nullable_load(documents, root, "historical", run_date, table, **options)


def daily_load(documents: DataFrame, root: str, run_date: dt.date, table: str, **options) -> LoadResult:
    """The nullable load of the daily feed; replaces the table."""
    return nullable_load(documents, root, "daily", run_date, table, **options)


def append_load(
    documents: DataFrame, root: str, feed: str, run_date: dt.date, table: str, **options
) -> LoadResult:
    """The nullable load, adding to the table; `load_id` makes it repeatable."""
    return nullable_load(documents, root, feed, run_date, table, disposition=APPEND, **options)


def canonical_load(
    documents: DataFrame,
    root: str,
    feed: str,
    run_date: dt.date,
    table: str,
    include_place: bool = True,
    on_error: str = "truncate",
    n_files: int | None = None,
    as_of: dt.datetime | None = None,
    spread: int | None = None,
    load_id: str | None = None,
    by_feature: bool = False,
) -> LoadResult:
    """Land, project, write silver and append gold under canonical rules.

    Without `place` the rows still go into a table that has the column. A line is looked at
    once: one action writes the rows to silver and what the error rule drops to the
    quarantine, and counts both. `spread` deals the rows of large documents over that many
    tasks. A load under a `load_id` may be run again, see `append_by_name`.

    `by_feature` is for documents too large for one task: features are landed one a row, and
    the truncate rule and all that follows run over rows, wherever their document is.
    """
    if by_feature and (on_error != "truncate" or spread):
        raise ValueError("a load by feature truncates and is spread already")
    spark = documents.sparkSession
    paths = L.Layers(root, "canonical", feed, run_date)
    landed = L.land_bronze(documents, paths.bronze)

    lines = L.read_bronze_text(spark, paths.bronze)
    schema = canonical.silver_schema(include_place)
    if by_feature:
        landed_features = canonical.land_features(lines, paths.features)
        tagged = canonical.tagged_over_tasks(landed_features, paths.cuts, include_place)
    else:
        tagged = canonical.tagged_project(lines, on_error, include_place, spread)
    counts = L.write_tagged(tagged, schema, paths.silver, paths.quarantine, n_files)

    silver = L.read_silver(spark, paths.silver, schema)
    gold = canonical.gold_project(silver, as_of, include_place)
    _load_gold(gold, table, canonical.gold_schema(), APPEND, load_id)
    return LoadResult(
        landed,
        paths.bronze,
        paths.silver,
        table,
        paths.quarantine,
        counts[L.DOCUMENT_KIND],
        counts[L.FEATURE_KIND],
    )


def audited_load(
    documents: DataFrame | str,
    root: str,
    feed: str,
    run_date: dt.date,
    table: str,
    audit_table: str,
    job_id: object,
    spark: SparkSession | None = None,
    as_of: dt.datetime | None = None,
    stop_on_failure: bool = False,
    **trail_options,
) -> LoadResult:
    """The nullable load with one audit row per stage.

    `documents` may be the path of the staged files; if it cannot be read, that
    is a failed fetch. By default the job goes on after a failure, so each
    later stage fails and leaves its own row.
    """
    spark = spark or (documents.sparkSession if isinstance(documents, DataFrame) else SparkSession.active())
    paths = L.Layers(root, "audited", feed, run_date)
    T.ensure_namespace_of(spark, audit_table)
    ensure_audit_table(spark, audit_table)
    trail = AuditTrail(spark, audit_table, job_id, **trail_options)

    landed = _audited_landing(trail, spark, documents, paths)
    saved = None
    if landed or not stop_on_failure:
        saved = _audited_silver(trail, spark, paths, as_of)
    if saved or not stop_on_failure:
        _audited_gold(trail, spark, saved, table)
    return LoadResult(landed, paths.bronze, saved, table)


def _audited_landing(
    trail: AuditTrail, spark: SparkSession, documents: DataFrame | str, paths: L.Layers
) -> bool:
    """Fetch and land. Both count documents, observed while they are written.

    The input is looked at once, by that write: if it has no document then, there was
    nothing to fetch and nothing to land.
    """
    counted = Observation()
    staged, landed = None, False
    with trail.stage("fetch") as fetch:
        staged = L.read_staged(spark, documents) if isinstance(documents, str) else documents
        fetch.records = counted
    with trail.stage("land") as stage:
        if staged is None:
            raise ValueError(NO_DATA)
        try:
            landed = L.land_bronze(staged, paths.bronze, counted)
        except Exception as error:
            trail.fail_pending(str(error))
            raise
        if not landed:
            fetch.fail(NO_DOCUMENT)
            raise ValueError(NO_DATA)
        stage.records = counted
    trail.flush()
    return landed


def _audited_silver(
    trail: AuditTrail, spark: SparkSession, paths: L.Layers, as_of: dt.datetime | None
) -> str | None:
    """Read, flatten, transform and save: four audit rows, one action."""
    documents = flat = transformed = saved = None
    seen = {name: Observation() for name in ("read", "flatten", "save")}
    with trail.stage("read") as stage:
        frame = L.read_bronze_json(spark, paths.bronze)
        documents, stage.records = observe_count(frame, seen["read"]), seen["read"]
    with trail.stage("flatten") as stage:
        if documents is None:
            raise ValueError("no documents to flatten")
        frame = nullable.flatten_audited(documents, as_of)
        flat, stage.records = observe_count(frame, seen["flatten"]), seen["flatten"]
    with trail.stage("transform") as stage:
        if flat is None:
            raise ValueError("no rows to transform")
        frame = nullable.transform_columns(flat, as_of)
        transformed, stage.records = observe_count(frame, seen["save"]), seen["save"]
    with trail.stage("save") as stage:
        if transformed is None:
            raise ValueError(NO_FRAME)
        stage.records = seen["save"]
        try:
            saved = L.write_silver(transformed, paths.silver)
        except Exception as error:
            trail.fail_pending(str(error))
            raise
    trail.flush()
    return saved


def _audited_gold(trail: AuditTrail, spark: SparkSession, saved: str | None, table: str) -> None:
    """Load the silver this run has saved and count the rows as they are loaded.

    Silver of this flavour has other columns than the nullable table: the table
    gets a null geometry type, and the feature id and read clock are left out.
    """
    loaded = Observation()
    with trail.stage("load") as stage:
        if saved is None:
            raise ValueError(NO_SILVER)
        silver = L.read_silver(spark, saved, AUDITED)
        rows = observe_count(conform_schema(silver, NULLABLE), loaded)
        _load_gold(rows, table, NULLABLE, TRUNCATE)
        stage.records = loaded
    trail.flush()
