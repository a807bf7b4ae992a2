import datetime as dt

import pytest

from tests.conftest import document, feature
from tremorlake.operators import audit as U
from tremorlake.plans import jobs
from tremorlake.sources import tables as T

RUN_DATE = dt.date(2024, 1, 30)
STAGES = ["fetch", "land", "read", "flatten", "transform", "save", "load"]


@pytest.fixture
def place(spark, tmp_path):
    name = f"audit_{tmp_path.name.replace('-', '_')}"
    T.ensure_namespace(spark, name, str(tmp_path / "ns"))
    return name, str(tmp_path / "lake")


def run(spark, place, documents, **options):
    name, root = place
    result = jobs.audited_load(
        documents, root, "daily", RUN_DATE, f"{name}.gold", f"{name}.audit", 101, spark=spark, **options
    )
    rows = {row.function_name: row for row in T.scan_table(spark, f"{name}.audit").collect()}
    return result, rows


def test_run_with_two_documents(spark, place, lines):
    documents = lines(document(feature(), feature()), document(feature()))
    result, rows = run(spark, place, documents)
    assert result.landed and sorted(rows) == sorted(STAGES)
    counts = {name: row.process_record for name, row in rows.items()}
    assert counts == {"fetch": 2, "land": 2, "read": 2, "flatten": 3, "transform": 3, "save": 3, "load": 3}
    for row in rows.values():
        assert (row.status, row.error_msg, row.job_id) == ("Success", None, "101")
        assert row.pipeline_name == "DataPipeline"
        assert row.start_time.microsecond == row.end_time.microsecond == 0
        assert row.start_time <= row.end_time


def test_missing_input_fails_every_stage(spark, place, tmp_path):
    result, rows = run(spark, place, str(tmp_path / "missing"))
    assert not result.landed and result.silver is None
    assert {name: row.status for name, row in rows.items()} == dict.fromkeys(STAGES, "Failed")
    assert all(row.process_record == 0 for row in rows.values())
    assert rows["land"].error_msg == "No data to upload"
    assert rows["save"].error_msg == "Transformed DataFrame is None"
    assert "PATH_NOT_FOUND" in rows["fetch"].error_msg
    assert "\n" not in rows["fetch"].error_msg


def test_no_document_is_a_failed_fetch(spark, place):
    _, rows = run(spark, place, spark.createDataFrame([], "value string"))
    assert rows["fetch"].status == rows["load"].status == "Failed"


def test_stop_on_failure(spark, place, tmp_path):
    _, rows = run(spark, place, str(tmp_path / "missing"), stop_on_failure=True)
    assert sorted(rows) == ["fetch", "land"]


def test_raise_on_error(spark, place, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run(spark, place, str(tmp_path / "missing"), raise_on_error=True)
    name, _ = place
    assert [row.status for row in T.scan_table(spark, f"{name}.audit").collect()] == ["Failed"]


def test_failed_action_fails_the_planned_stages(spark, place, lines, monkeypatch):
    def broken(df, path):
        raise OSError("disk full")

    monkeypatch.setattr(jobs.L, "write_silver", broken)
    _, rows = run(spark, place, lines(document(feature())))
    failed = [name for name in STAGES if rows[name].status == "Failed"]
    assert failed == ["read", "flatten", "transform", "save", "load"]
    assert rows["flatten"].error_msg == "disk full"


def test_clock_and_retry_note(spark, place):
    name, _ = place
    moments = iter(dt.datetime(2024, 1, 1, 0, 0, s, 999, dt.timezone.utc) for s in range(9))
    calls = []

    def append(spark, table, rows):
        calls.append(rows)
        if len(calls) == 1:
            raise OSError("busy")

    trail = U.AuditTrail(spark, f"{name}.a", 7, clock=lambda: next(moments), append=append)
    with trail.stage("one") as stage:
        stage.records = 5
    trail.flush()
    (first,), (second,) = calls
    assert first[:3] == ("7", "DataPipeline", "one") and first[-1] == 5
    assert (first[3].second, first[4].second, first[3].microsecond) == (0, 1, 0)
    assert first[6] is None and second[6] == "Insertion Error: busy"


def test_failing_twice_is_only_logged(spark, place):
    def append(spark, table, rows):
        raise OSError("busy")

    trail = U.AuditTrail(spark, "nowhere", 7, append=append)
    with trail.stage("one"):
        pass
    trail.flush()
    assert trail.pending == []


def test_failed_silver_leaves_gold(spark, place, lines, monkeypatch):
    """The save fails inside a task."""
    from pyspark.sql import functions as F

    name, _ = place
    run(spark, place, lines(document(feature())))
    whole = jobs.nullable.transform_columns
    monkeypatch.setattr(
        jobs.nullable,
        "transform_columns",
        lambda df, as_of=None: whole(df, as_of).withColumn("code", F.raise_error(F.lit("lost disk")).cast("string")),
    )
    T.scan_table(spark, f"{name}.audit")
    spark.sql(f"DROP TABLE {name}.audit")
    _, rows = run(spark, place, lines(document(feature())))
    assert (rows["save"].status, rows["load"].status) == ("Failed", "Failed")
    assert rows["load"].error_msg == jobs.NO_SILVER
    assert T.scan_table(spark, f"{name}.gold").count() == 1


def test_many_records_and_one_bad_row(spark, place):
    name, _ = place
    U.ensure_audit_table(spark, f"{name}.big")
    now = U.utc_now()
    good = U.audit_row(1, "p", "many", now, now, "Success", None, 3_000_000_000)
    bad = U.audit_row(1, "p", "bad", now, now, "Success", None, 1 << 70)
    U.AuditTrail(spark, f"{name}.big", 1)._append_with_retry([good, bad])
    stored = [(row.function_name, row.process_record) for row in T.scan_table(spark, f"{name}.big").collect()]
    assert stored == [("many", 3_000_000_000)]
    assert U.audit_frame(spark, [good]).rdd.getNumPartitions() == 1


def test_input_that_is_gone_when_it_is_written(spark, place, tmp_path):
    """The staged files are there when the job looks for them and empty when they are read."""
    from tremorlake.sources import layers as L

    folder = tmp_path / "staged"
    folder.mkdir()
    (folder / "1.json").write_text(document(feature()))
    documents = L.read_staged(spark, str(folder))
    assert documents.count() == 1
    gone = documents.filter("length(value) < 0")
    result, rows = run(spark, place, gone)
    assert not result.landed and {name: row.status for name, row in rows.items()} == dict.fromkeys(STAGES, "Failed")
    assert rows["fetch"].error_msg == jobs.NO_DOCUMENT and rows["land"].error_msg == "No data to upload"


def test_input_is_read_once(spark, place):
    """Landing counts what it writes and looks at nothing before."""
    seen = spark.sparkContext.accumulator(0)

    def looked(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    documents = spark.createDataFrame([(document(feature()),)] * 3, "value string").coalesce(1).mapInArrow(looked, "value string")
    result, rows = run(spark, place, documents)
    assert result.landed and rows["fetch"].process_record == rows["land"].process_record == 3
    assert seen.value == 3


def test_a_count_that_never_ran_fails_its_stage(spark, place):
    from pyspark.sql import Observation

    name, _ = place
    U.ensure_audit_table(spark, f"{name}.a")
    trail = U.AuditTrail(spark, f"{name}.a", 7)
    with trail.stage("counted") as stage:
        stage.records = 3
    with trail.stage("planned") as stage:
        stage.records = Observation()
    trail.flush()
    rows = {row.function_name: row for row in T.scan_table(spark, f"{name}.a").collect()}
    assert (rows["counted"].status, rows["counted"].process_record) == ("Success", 3)
    assert (rows["planned"].status, rows["planned"].process_record) == ("Failed", 0)
    assert rows["planned"].error_msg.startswith(U.NOT_COUNTED)
