"""One registered query per operator. Each takes (spark, sf_dir).

Analytics read the flat rows of `events`; operators on documents read the
landed feed; sinks write to a fresh path and return what they stored. Clock
columns are left out of results, dates and timestamps are given as text.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, StructField, StructType, TimestampType

from tremorlake.functions import scalars as S
from tremorlake.operators import analytics as A
from tremorlake.operators import audit as U
from tremorlake.operators import canonical as C
from tremorlake.operators import nullable as N
from tremorlake.operators.shape import cast_columns, conform_schema
from tremorlake.plans import jobs
from tremorlake.plans import report as R
from tremorlake.schemas import AUDITED, CANONICAL_GOLD, CANONICAL_SILVER, NULLABLE, columns
from tremorlake.sources import layers as L
from tremorlake.sources import tables as T
from workload import feed
from workload.store import AS_OF, RUN_DATE, Store, store

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

CLOCKS = ("insert_dt", "ingestion_timestamp")
AUDIT_FACTS = ("job_id", "pipeline_name", "function_name", "status", "error_msg", "process_record")
JOB_ID = 101
RUN_INSTANT = dt.datetime(2024, 1, 30, 12, tzinfo=dt.timezone.utc)


def as_text(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, and no clock columns."""
    formats = {DateType: "yyyy-MM-dd", TimestampType: "yyyy-MM-dd HH:mm:ss.SSS"}

    def shown(field: StructField) -> str:
        if type(field.dataType) not in formats:
            return f"`{field.name}`"
        return f"date_format(`{field.name}`, '{formats[type(field.dataType)]}') AS `{field.name}`"

    return df.selectExpr(*(shown(field) for field in df.schema.fields if field.name not in CLOCKS))


def query(key: str) -> Callable[[Callable[[Store], DataFrame]], Callable[[Store], DataFrame]]:
    """Register a function of the store under a key."""

    def register(function: Callable[[Store], DataFrame]) -> Callable[[Store], DataFrame]:
        QUERIES[key] = lambda spark, sf_dir: as_text(function(store(spark, sf_dir)))
        return function

    return register


def flat(s: Store) -> DataFrame:
    return feed.flat_features(s.events)


def gold_rows(s: Store) -> DataFrame:
    """Flat rows of `events` in the shape of the nullable gold table."""
    return N.transform_columns(flat(s))


def nullable_rows(s: Store) -> DataFrame:
    return N.transform_columns(N.flatten(s.documents()))


def canonical_rows(s: Store, **options) -> DataFrame:
    return C.canonical_project(s.lines(), **options)


def mixed_rows(s: Store) -> DataFrame:
    """Every event, with leaves of mixed types."""
    return C.canonical_project(s.lines(rough=True, faults=False))


def rough_rows(s: Store, **options) -> DataFrame:
    return C.canonical_project(s.lines(rough=True), **options)


# --- sources and sinks -------------------------------------------------------


@query("bronze_land")
def _(s: Store) -> DataFrame:
    """The line of each staged file, and whether landing without a file stores something."""
    path = s.fresh("landed")
    staged = L.read_staged(s.spark, s.staged_files())
    L.land_bronze(staged, path)
    without_data = L.land_bronze(staged.filter("length(value) < 0"), s.fresh("not_landed"))
    return L.read_bronze_text(s.spark, path).select(
        F.sha2(F.rtrim("value"), 256).alias("line_sha256"), F.lit(without_data).alias("landed_without_data")
    )


@query("bronze_read_text")
def _(s: Store) -> DataFrame:
    declared = F.regexp_extract("value", r'"count":(\d+)', 1).cast("bigint")
    return s.lines().select(
        F.regexp_extract("value", r'"generated":(\d+)', 1).cast("bigint").alias("generated"),
        declared.alias("declared"),
    )


@query("bronze_read_json")
def _(s: Store) -> DataFrame:
    return s.documents().select(
        F.col("type").alias("document_type"),
        "metadata.generated",
        "metadata.title",
        "metadata.status",
        F.col("metadata.count").alias("declared"),
        F.array_size("features").alias("features"),
    )


@query("silver_write")
def _(s: Store) -> DataFrame:
    path = L.write_silver(nullable_rows(s), s.fresh("silver"))
    return L.read_silver(s.spark, path, NULLABLE)


@query("silver_write_single")
def _(s: Store) -> DataFrame:
    path = L.write_silver_typed(canonical_rows(s), s.fresh("silver"), CANONICAL_SILVER)
    return L.read_silver(s.spark, path, CANONICAL_SILVER)


@query("silver_read")
def _(s: Store) -> DataFrame:
    silver = L.read_silver(s.spark, f"{s.silver()}/*.parquet", NULLABLE)
    return silver.select("code", "mag", "sig", "nst", "felt", "time", "area")


@query("gold_append")
def _(s: Store) -> DataFrame:
    table = s.fresh_table("appended")
    gold = C.gold_project(canonical_rows(s))
    for _run in range(2):
        T.append_by_name(gold, table, CANONICAL_GOLD)
    return T.scan_table(s.spark, table)


@query("gold_append_repeatable")
def _(s: Store) -> DataFrame:
    """Two loads, one of them run twice under its id."""
    table = s.fresh_table("repeatable")
    gold = C.gold_project(canonical_rows(s))
    for load_id in ("20240129", "20240130", "20240130"):
        T.append_by_name(gold, table, CANONICAL_GOLD, load_id=load_id)
    return T.scan_table(s.spark, table)


@query("gold_new_columns")
def _(s: Store) -> DataFrame:
    """A table that is loaded with other columns than it had."""
    table = s.fresh_table("renewed")
    silver = L.read_silver(s.spark, s.silver(), NULLABLE)
    fewer = StructType([field for field in NULLABLE.fields if field.name != "place"])
    for schema in (fewer, NULLABLE):
        T.truncate_and_load(silver, table, schema)
    return T.scan_table(s.spark, table)


@query("gold_truncate_load")
def _(s: Store) -> DataFrame:
    table = s.fresh_table("replaced")
    silver = L.read_silver(s.spark, s.silver(), NULLABLE)
    for _run in range(2):
        T.truncate_and_load(silver, table, NULLABLE)
    return T.scan_table(s.spark, table)


@query("ensure_namespace")
def _(s: Store) -> DataFrame:
    table = s.fresh_table("in_namespace")
    namespace = table.split(".")[0]
    T.ensure_namespace(s.spark, namespace)
    T.append_by_name(gold_rows(s), table, NULLABLE)
    exists = s.spark.catalog.databaseExists(namespace)
    return T.scan_table(s.spark, table).agg(
        F.lit(exists).alias("namespace_exists"), F.count(F.lit(1)).alias("stored")
    )


@query("ensure_table")
def _(s: Store) -> DataFrame:
    table = s.fresh_table("ensured")
    for _run in range(2):
        U.ensure_audit_table(s.spark, table)
    U.append_audit(s.spark, table, [counted_row(s, "count")])
    return T.scan_table(s.spark, table).select(*AUDIT_FACTS)


@query("table_scan")
def _(s: Store) -> DataFrame:
    return T.scan_table(s.spark, s.gold()).select("code", "area", "mag", "updated")


@query("dated_path")
def _(s: Store) -> DataFrame:
    root = s.fresh("lake")
    path = L.Layers(root, "nullable", "daily", RUN_DATE).bronze
    L.land_bronze(s.staged(), path)
    below = F.regexp_extract("_metadata.file_path", r"(bronze/.*)/[^/]+$", 1)
    lines = L.read_bronze_text(s.spark, path).select(below.alias("path"))
    return lines.groupBy("path").agg(F.count(F.lit(1)).alias("documents"))


def count_events(s: Store) -> int:
    """Rows of `events`, counted while a full pass over a gold column runs."""
    counted = Observation()
    rows = U.observe_count(gold_rows(s).select("area"), counted)
    rows.write.format("noop").mode("overwrite").save()
    return U.observed_count(counted)


def counted_row(s: Store, function_name: str) -> tuple:
    records = count_events(s)
    return U.audit_row(
        JOB_ID, U.DEFAULT_PIPELINE, function_name, RUN_INSTANT, RUN_INSTANT, U.SUCCESS, None, records
    )


@query("memory_source")
def _(s: Store) -> DataFrame:
    records = count_events(s)
    return L.memory_frame(s.spark, [("daily", records)], "feed string, records bigint")


@query("debug_sample")
def _(s: Store) -> DataFrame:
    rows = s.events.select("event_id", "event_type", "user_id")
    return L.debug_sample(rows, 20, order_by=["event_id"])


# --- projections, nesting, schema ------------------------------------------------


@query("explode_features")
def _(s: Store) -> DataFrame:
    return N.explode_features(s.documents()).select("feature.id", "feature.type")


@query("extract_properties")
def _(s: Store) -> DataFrame:
    return N.explode_features(s.documents()).select(*N.property_columns())


@query("split_coordinates")
def _(s: Store) -> DataFrame:
    located = N.explode_features(s.documents()).select("feature.id", "feature.geometry.coordinates")
    return N.split_coordinates(located)


@query("drop_columns")
def _(s: Store) -> DataFrame:
    features = N.explode_features(s.documents())
    located = features.select(
        "feature.id", F.col("feature.geometry.type").alias("geometry_type"), "feature.geometry.coordinates"
    )
    return located.drop("coordinates")


# A narrow bronze schema that leaves four properties as text.
TEXT_PROPERTIES = StructType().add(
    "features",
    ArrayType(StructType().add("properties", columns("code string, mag string, sig string, felt string"))),
)


@query("cast_columns")
def _(s: Store) -> DataFrame:
    documents = L.read_bronze_json(s.spark, s.bronze(), TEXT_PROPERTIES)
    texts = N.explode_features(documents).select("feature.properties.*")
    return cast_columns(texts, {"mag": "float", "sig": "int", "felt": "int"})


@query("with_columns")
def _(s: Store) -> DataFrame:
    return nullable_rows(s).select("code", "time", "updated", "area")


@query("canonical_project")
def _(s: Store) -> DataFrame:
    return canonical_rows(s)


@query("gold_project")
def _(s: Store) -> DataFrame:
    return C.gold_project(canonical_rows(s))


def audited_rows(s: Store) -> DataFrame:
    return N.transform_columns(N.flatten_audited(s.documents()))


@query("audited_project")
def _(s: Store) -> DataFrame:
    return audited_rows(s).select(*AUDITED.fieldNames())


@query("conform_schema")
def _(s: Store) -> DataFrame:
    return conform_schema(audited_rows(s), NULLABLE)


@query("append_missing_column")
def _(s: Store) -> DataFrame:
    table = s.fresh_table("mixed")
    for include_place in (True, False):
        silver = canonical_rows(s, include_place=include_place)
        gold = C.gold_project(silver, include_place=include_place)
        T.append_by_name(gold, table, CANONICAL_GOLD)
    return T.scan_table(s.spark, table).select("event_code", "place", "area")


@query("split_outputs")
def _(s: Store) -> DataFrame:
    outputs = C.split_outputs(canonical_rows(s))
    counts = [
        rows.agg(F.count(F.lit(1)).alias("records")).select(F.lit(tag).alias("tag"), "records")
        for tag, rows in outputs.items()
    ]
    return counts[0].unionAll(counts[1])


# --- scalar functions --------------------------------------------------------------


@query("safe_cast")
def _(s: Store) -> DataFrame:
    return mixed_rows(s).select("event_code", "station_count", "magnitude", "place")


@query("falsy_to_empty")
def _(s: Store) -> DataFrame:
    return mixed_rows(s).select("event_code", "alert_status", "description")


@query("epoch_ms_to_timestamp")
def _(s: Store) -> DataFrame:
    return flat(s).select("code", S.epoch_ms_to_timestamp("time").alias("time"))


@query("epoch_ms_to_iso")
def _(s: Store) -> DataFrame:
    return mixed_rows(s).select("event_code", "event_time", "last_update")


@query("area_regex")
def _(s: Store) -> DataFrame:
    return flat(s).select("code", S.area_regex("place").alias("area"))


@query("area_split")
def _(s: Store) -> DataFrame:
    return flat(s).select("code", S.area_split("place").alias("area"))


@query("to_date")
def _(s: Store) -> DataFrame:
    return A.with_event_date(gold_rows(s)).select("code", "date")


@query("load_clock")
def _(s: Store) -> DataFrame:
    return gold_rows(s).agg(
        F.count("insert_dt").alias("stamped"), (F.min("insert_dt") == F.max("insert_dt")).alias("constant")
    )


@query("record_clock_iso")
def _(s: Store) -> DataFrame:
    stamped = flat(s).select(S.record_clock_iso(RUN_INSTANT).alias("insert_dt"))
    return stamped.agg(
        F.count("insert_dt").alias("stamped"),
        F.min("insert_dt").alias("first_clock"),
        F.max("insert_dt").alias("last_clock"),
    )


@query("date_arith")
def _(s: Store) -> DataFrame:
    start = S.days_before(AS_OF, A.WEEK_DAYS)
    dated = A.with_event_date(gold_rows(s))
    counts = dated.agg(
        F.count_if(F.col("date") < start).alias("before"), F.count_if(F.col("date") >= start).alias("since")
    )
    return counts.select(start.alias("week_start"), "before", "since")


@query("json_parse")
def _(s: Store) -> DataFrame:
    is_json = F.try_parse_json("value").isNotNull()
    return s.lines(rough=True).groupBy(is_json.alias("is_json")).agg(F.count(F.lit(1)).alias("documents"))


@query("json_serialise")
def _(s: Store) -> DataFrame:
    return gold_rows(s).select(F.to_json(F.struct("code", "area", "sig")).alias("document"))


@query("field_default")
def _(s: Store) -> DataFrame:
    return mixed_rows(s).select("event_code", "area", "longitude", "depth")


# --- errors --------------------------------------------------------------------------


@query("skip_bad_documents")
def _(s: Store) -> DataFrame:
    parsed = C.parse_documents(s.lines(rough=True))
    accepted = F.col("features").isNotNull()
    return parsed.groupBy(accepted.alias("accepted")).agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum(F.coalesce(F.array_size("features"), F.lit(0))).alias("features"),
    )


@query("truncate_at_bad_feature")
def _(s: Store) -> DataFrame:
    return rough_rows(s)


@query("truncate_over_tasks")
def _(s: Store) -> DataFrame:
    """The same rows, with the features of a document on many tasks."""
    landed = C.land_features(s.lines(rough=True), s.fresh("features"))
    return C.project_features(C.cut_features(landed, s.fresh("cuts")))


@query("skip_bad_feature")
def _(s: Store) -> DataFrame:
    return rough_rows(s, on_error="skip").select("event_code", "event_time")


# --- predicates, aggregates, windows, top-k ------------------------------------------


@query("magnitude_above")
def _(s: Store) -> DataFrame:
    return A.magnitude_above(L.read_silver(s.spark, s.silver(), NULLABLE))


@query("last_week_filter")
def _(s: Store) -> DataFrame:
    return A.last_week(gold_rows(s), AS_OF).select("code", "date")


@query("count_by_area")
def _(s: Store) -> DataFrame:
    return A.count_by_area(gold_rows(s))


@query("avg_mag_by_area")
def _(s: Store) -> DataFrame:
    return A.avg_mag_by_area(gold_rows(s)).withColumn("avg_mag", F.round("avg_mag", 4))


@query("count_by_day")
def _(s: Store) -> DataFrame:
    return A.count_by_day(gold_rows(s))


@query("count_by_day_area")
def _(s: Store) -> DataFrame:
    return A.count_by_day_area(gold_rows(s))


@query("avg_daily_count")
def _(s: Store) -> DataFrame:
    name = "average_earthquakes_same_day"
    return A.avg_daily_count(gold_rows(s)).withColumn(name, F.round(name, 4))


@query("avg_count_day_area")
def _(s: Store) -> DataFrame:
    return A.avg_count_by_day_area(gold_rows(s))


@query("top_area_last_week")
def _(s: Store) -> DataFrame:
    return A.top_area_last_week(gold_rows(s), AS_OF)


@query("areas_above_5")
def _(s: Store) -> DataFrame:
    return A.magnitude_above(gold_rows(s))


@query("top5_frequency_intensity")
def _(s: Store) -> DataFrame:
    return A.top_frequency_intensity(gold_rows(s))


@query("row_count")
def _(s: Store) -> DataFrame:
    counted = Observation()
    L.write_silver(U.observe_count(nullable_rows(s), counted), s.fresh("counted"))
    return L.memory_frame(s.spark, [("silver", U.observed_count(counted))], "stage string, records bigint")


@query("window_avg_partition")
def _(s: Store) -> DataFrame:
    counts = A.count_by_day_area(gold_rows(s), date_col="time", count_name="earthquake_count")
    return A.window_avg(counts, "earthquake_count", ["date", "area"], "partition_avg")


@query("top_1")
def _(s: Store) -> DataFrame:
    strongest = A.max_mag_by_area(gold_rows(s), "highest_magnitude")
    return A.top_rows(strongest, ["highest_magnitude"], 1, "area")


@query("top_5_two_keys")
def _(s: Store) -> DataFrame:
    daily = A.with_event_date(gold_rows(s)).groupBy("date").agg(
        F.count(F.lit(1)).alias("frequency"), F.max("mag").alias("intensity")
    )
    return A.top_rows(daily, ["frequency", "intensity"], 5, "date")


# --- audit ---------------------------------------------------------------------------


@query("audit_frame")
def _(s: Store) -> DataFrame:
    return U.audit_frame(s.spark, [counted_row(s, "flatten")])


@query("audit_append")
def _(s: Store) -> DataFrame:
    table = s.fresh_table("audit")
    U.append_audit(s.spark, table, [counted_row(s, "read")])
    U.append_audit(s.spark, table, [counted_row(s, "flatten")])
    return T.scan_table(s.spark, table).select(*AUDIT_FACTS)


def trail(s: Store, **options) -> U.AuditTrail:
    table = s.fresh_table("audit")
    U.ensure_audit_table(s.spark, table)
    return U.AuditTrail(s.spark, table, JOB_ID, **options)


def run_two_stages(s: Store, log: U.AuditTrail) -> DataFrame:
    """A stage that counts the feed's rows and one that fails."""
    with log.stage("count") as stage:
        stage.records = Observation()
        rows = U.observe_count(N.flatten(s.documents()), stage.records)
        rows.write.format("noop").mode("overwrite").save()
    with log.stage("refuse"):
        raise ValueError("refused")
    log.flush()
    return T.scan_table(s.spark, log.table)


@query("audited_stage")
def _(s: Store) -> DataFrame:
    return run_two_stages(s, trail(s)).select(*AUDIT_FACTS)


def audited_run(s: Store, documents: DataFrame | str, audit_table: str) -> jobs.LoadResult:
    return jobs.audited_load(
        documents, s.fresh("lake"), "daily", RUN_DATE, s.fresh_table("gold"), audit_table, JOB_ID, spark=s.spark
    )


@query("stage_row_counts")
def _(s: Store) -> DataFrame:
    audit_table = s.fresh_table("audit")
    audited_run(s, s.staged(), audit_table)
    return T.scan_table(s.spark, audit_table).select("function_name", "status", "process_record")


@query("audit_write_retry")
def _(s: Store) -> DataFrame:
    calls = []

    def fails_once(spark: SparkSession, table: str, rows: list[tuple]) -> None:
        calls.append(table)
        if len(calls) == 1:
            raise OSError("sink busy")
        U.append_audit(spark, table, rows)

    return run_two_stages(s, trail(s, append=fails_once)).select(*AUDIT_FACTS)


@query("audit_failure_cascade")
def _(s: Store) -> DataFrame:
    audit_table = s.fresh_table("audit")
    audited_run(s, s.staged(), audit_table)
    audited_run(s, s.fresh("nothing_staged"), audit_table)
    rows = T.scan_table(s.spark, audit_table)
    return rows.groupBy("status", "function_name").agg(
        F.count(F.lit(1)).alias("stages"), F.sum("process_record").alias("records")
    )


@query("audit_types")
def _(s: Store) -> DataFrame:
    rows = run_two_stages(s, trail(s))
    return rows.select(
        F.typeof("job_id").alias("job_id_type"),
        "job_id",
        (F.date_trunc("second", "start_time") == F.col("start_time")).alias("whole_seconds"),
        (F.col("end_time") >= F.col("start_time")).alias("in_order"),
        "process_record",
    )


@query("audit_compaction")
def _(s: Store) -> DataFrame:
    """Many flushes, one audit row for each type of event, in one file a month."""
    table = s.fresh_table("audit")
    U.ensure_audit_table(s.spark, table)
    counts = s.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).orderBy("event_type").collect()
    for row in counts:
        stage = U.audit_row(JOB_ID, U.DEFAULT_PIPELINE, row.event_type, RUN_INSTANT, RUN_INSTANT, U.SUCCESS, None, row.n)
        U.append_audit(s.spark, table, [stage])
    n_files = U.compact_audit(s.spark, table)
    return T.scan_table(s.spark, table).select(*AUDIT_FACTS, F.lit(n_files).cast("bigint").alias("files"))


# --- jobs ------------------------------------------------------------------------------


def loaded_rows(s: Store, result: jobs.LoadResult) -> DataFrame:
    return T.scan_table(s.spark, result.table)


@query("job_historical")
def _(s: Store) -> DataFrame:
    return loaded_rows(s, jobs.historical_load(s.staged(), s.fresh("lake"), RUN_DATE, s.fresh_table("gold")))


@query("job_daily")
def _(s: Store) -> DataFrame:
    return loaded_rows(s, jobs.daily_load(s.staged(), s.fresh("lake"), RUN_DATE, s.fresh_table("gold")))


@query("job_canonical")
def _(s: Store) -> DataFrame:
    return loaded_rows(
        s, jobs.canonical_load(s.staged(), s.fresh("lake"), "daily", RUN_DATE, s.fresh_table("gold"))
    )


@query("job_canonical_quarantine")
def _(s: Store) -> DataFrame:
    """What the canonical load drops of the rough feed, with the counts of the job."""
    result = jobs.canonical_load(
        s.staged(rough=True), s.fresh("lake"), "daily", RUN_DATE, s.fresh_table("gold"), spread=8
    )
    return L.read_quarantine(s.spark, result.quarantine).select(
        "kind",
        F.get_json_object("value", "$.id").alias("code"),
        F.lit(result.lost_documents).cast("bigint").alias("lost_documents"),
        F.lit(result.lost_features).cast("bigint").alias("lost_features"),
    )


@query("job_canonical_by_feature")
def _(s: Store) -> DataFrame:
    """What the load of the rough feed stores when features are landed one a row."""
    result = jobs.canonical_load(
        s.staged(rough=True), s.fresh("lake"), "daily", RUN_DATE, s.fresh_table("gold"), by_feature=True
    )
    return L.read_silver(s.spark, result.silver, CANONICAL_SILVER)


@query("job_canonical_historical")
def _(s: Store) -> DataFrame:
    result = jobs.canonical_load(
        s.staged(), s.fresh("lake"), "historical", RUN_DATE, s.fresh_table("gold"), include_place=False
    )
    return loaded_rows(s, result)


@query("job_audited")
def _(s: Store) -> DataFrame:
    audit_table = s.fresh_table("audit")
    return loaded_rows(s, audited_run(s, s.staged(), audit_table))


@query("job_append_functions")
def _(s: Store) -> DataFrame:
    root, table = s.fresh("lake"), s.fresh_table("gold")
    for name in ("daily", "historical"):
        result = jobs.append_load(s.staged(), root, name, RUN_DATE, table)
    return loaded_rows(s, result)


@query("job_report")
def _(s: Store) -> DataFrame:
    gold = T.scan_table(s.spark, s.gold())
    summary = R.stored_summary(gold, s.fresh("summary"))
    answers = R.report(gold, summary, AS_OF)
    return one_frame(answers)


@query("job_report_incremental")
def _(s: Store) -> DataFrame:
    """The report out of the states of two loads, the second one stored twice."""
    gold = T.scan_table(s.spark, s.gold())
    first = F.col("code").cast("bigint") % 3 == 0
    path = s.fresh("states")
    for load_id, rows in (("a", gold.filter(first)), ("b", gold.filter(~first)), ("b", gold.filter(~first))):
        R.store_load_states(rows, path, load_id)
    return one_frame(R.report(gold, R.merged_summary(s.spark, path), AS_OF))


def one_frame(answers: dict[str, DataFrame]) -> DataFrame:
    """All answers below each other: the question, its keys, and up to two numbers."""
    result = None
    for question, answer in answers.items():
        keys = [name for name in ("date", "area") if name in answer.columns]
        numbers = [name for name in answer.columns if name not in keys]
        number = [F.round(F.col(name).cast("double"), 4) for name in numbers]
        nothing = F.lit(None)
        rows = answer.select(
            F.lit(question).alias("question"),
            (F.col("date") if "date" in keys else nothing.cast("date")).alias("date"),
            (F.col("area") if "area" in keys else nothing.cast("string")).alias("area"),
            number[0].alias("first_number"),
            (number[1] if len(number) > 1 else nothing.cast("double")).alias("second_number"),
        )
        result = rows if result is None else result.unionAll(rows)
    return result
