"""Versions of gold tables, repeatable loads, compaction, and states that merge."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import document, feature
from tremorlake.operators import audit as U
from tremorlake.plans import jobs
from tremorlake.plans import report as R
from tremorlake.schemas import columns
from tremorlake.sources import commits
from tremorlake.sources import tables as T

OLD, NEW = columns("n int"), columns("m int, o int")
NOTHING = dt.timedelta(0)
RUN_DATE = dt.date(2024, 1, 30)


@pytest.fixture
def table(spark, tmp_path):
    name = f"tables_{tmp_path.name.replace('-', '_')}"
    T.ensure_namespace(spark, name, str(tmp_path / "ns"))
    return f"{name}.t"


def old(spark, n=5):
    return spark.range(n).selectExpr("CAST(id AS int) AS n")


def new(spark, n=3):
    return spark.range(n).selectExpr("CAST(id AS int) AS m", "1 AS o")


def folders(tmp_path):
    return sorted(path.name for path in (tmp_path / "ns").iterdir() if path.is_dir())


def test_other_columns(spark, table, tmp_path):
    T.truncate_and_load(old(spark), table, OLD)
    T.truncate_and_load(new(spark), table, NEW)
    assert T.scan_table(spark, table).columns == ["m", "o"] and T.scan_table(spark, table).count() == 3
    names = [row.tableName for row in spark.sql(f"SHOW TABLES IN {table.split('.')[0]}").collect()]
    assert names == ["t"]
    assert len(folders(tmp_path)) == 2  # the former version is kept


class Killed(BaseException):
    """The driver dies: nothing is tidied up."""


@pytest.mark.parametrize("error", [OSError, Killed])
@pytest.mark.parametrize("schema, rows", [(OLD, 9), (NEW, 3)])
@pytest.mark.parametrize("step", range(5))
def test_a_failure_between_steps_leaves_a_readable_table(spark, table, tmp_path, monkeypatch, step, schema, rows, error):
    T.truncate_and_load(old(spark), table, OLD)
    run, done = T._run, []

    def fails(spark, statement):
        if len(done) == step:
            raise error("stopped")
        done.append(statement)
        run(spark, statement)

    frame = old(spark, rows) if schema is OLD else new(spark, rows)
    monkeypatch.setattr(T, "_run", fails)
    try:
        T.truncate_and_load(frame, table, schema)
        stopped = False
    except (OSError, Killed):
        stopped = True
    monkeypatch.setattr(T, "_run", run)
    assert stopped == (step < (1 if schema is OLD else 4))
    found = T.scan_table(spark, table)
    loaded = found.columns == schema.fieldNames() and found.count() == rows
    assert loaded or (found.columns == ["n"] and found.count() == 5)
    assert loaded or stopped
    T.truncate_and_load(new(spark, 4), table, NEW, keep=NOTHING)
    assert T.scan_table(spark, table).count() == 4
    assert len(folders(tmp_path)) == 1  # also what the failures have left is gone


def test_a_failed_write_leaves_no_folder(spark, table, tmp_path):
    T.truncate_and_load(old(spark), table, OLD)
    broken = old(spark).select(F.raise_error(F.lit("lost disk")).cast("int").alias("n"))
    with pytest.raises(Exception, match="lost disk"):
        T.truncate_and_load(broken, table, OLD)
    assert len(folders(tmp_path)) == 1 and T.scan_table(spark, table).count() == 5


@pytest.mark.parametrize("schema", [OLD, NEW])
def test_a_reader_that_runs_through_a_load_finishes(spark, table, schema):
    """It has planned its scan before the load and reads after it."""
    T.truncate_and_load(old(spark), table, OLD)
    reader = T.scan_table(spark, table).rdd  # files are chosen here
    assert reader.getNumPartitions() > 0
    T.truncate_and_load(old(spark, 2) if schema is OLD else new(spark, 2), table, schema)
    assert reader.count() == 5


def test_former_versions_stay_for_the_stated_time(spark, table, tmp_path):
    for n in (1, 2, 3):
        T.truncate_and_load(old(spark, n), table, OLD, keep=dt.timedelta(hours=1))
    assert len(folders(tmp_path)) == 3
    T.truncate_and_load(old(spark, 4), table, OLD, keep=NOTHING)
    assert len(folders(tmp_path)) == 1 and T.scan_table(spark, table).count() == 4


def test_a_managed_table_can_be_loaded(spark, table):
    T.append_by_name(old(spark), table, OLD)
    T.truncate_and_load(old(spark, 2), table, OLD)
    assert T.scan_table(spark, table).count() == 2
    T.truncate_and_load(new(spark), table, NEW)
    assert T.scan_table(spark, table).count() == 3


# --- repeatable loads ----------------------------------------------------------------


def test_a_load_runs_twice_under_its_id(spark, table):
    for load_id, n in (("a", 5), ("b'\\", 2), ("b'\\", 3)):
        T.append_by_name(old(spark, n), table, OLD, load_id=load_id)
    rows = T.scan_table(spark, table)
    assert {row.load_id: row["count"] for row in rows.groupBy("load_id").count().collect()} == {"a": 5, "b'\\": 3}


def test_missing_columns_are_null_in_a_repeatable_load(spark, table):
    T.append_by_name(spark.range(1).selectExpr("7 AS o"), table, NEW, load_id="x")
    assert tuple(T.scan_table(spark, table).select("m", "o").first()) == (None, 7)


def test_plain_tables_refuse_a_load_id(spark, table):
    T.append_by_name(old(spark), table, OLD)
    with pytest.raises(ValueError, match="load_id"):
        T.append_by_name(old(spark), table, OLD, load_id="a")
    T.append_by_name(old(spark), table, OLD)
    assert T.scan_table(spark, table).count() == 10


def test_append_jobs(spark, table, lines, tmp_path):
    frame = lines(document(feature(), feature()))
    for _ in range(2):
        jobs.append_load(frame, str(tmp_path / "lake"), "daily", RUN_DATE, table, load_id="20240130")
    assert T.scan_table(spark, table).count() == 2
    for _ in range(2):
        jobs.append_load(frame, str(tmp_path / "lake"), "daily", RUN_DATE, f"{table}_plain")
    assert T.scan_table(spark, f"{table}_plain").count() == 4


# --- compaction ------------------------------------------------------------------------


def flushes(spark, n, month=1):
    """Audit rows of as many flushes, a file each."""
    start = F.make_timestamp(F.lit(2024), F.lit(month) + F.col("id") % 2, F.lit(3), F.lit(4), F.lit(5), F.lit(6))
    rows = spark.range(0, n, 1, n).select(
        F.col("id").cast("string").alias("job_id"),
        F.lit("p").alias("pipeline_name"),
        F.lit("f").alias("function_name"),
        start.alias("start_time"),
        start.alias("end_time"),
        F.lit("Success").alias("status"),
        F.lit(None).cast("string").alias("error_msg"),
        F.col("id").alias("process_record"),
    )
    return rows


def facts(spark, table):
    return sorted(map(str, T.scan_table(spark, table).collect()))


def test_compaction_of_many_flushes(spark, table, tmp_path):
    U.ensure_audit_table(spark, table)
    flushes(spark, 1000).write.insertInto(table)
    before = facts(spark, table)
    assert len(T.scan_table(spark, table).inputFiles()) == 1000
    assert U.compact_audit(spark, table) == 2  # two months
    assert facts(spark, table) == before and len(T.scan_table(spark, table).inputFiles()) == 2
    U.append_audit(spark, table, [U.audit_row(1, "p", "f", U.utc_now(), U.utc_now(), "Success", None, 1)])
    assert U.compact_audit(spark, table, keep=NOTHING) == 3
    assert T.scan_table(spark, table).count() == 1001 and len(folders(tmp_path)) == 1


def test_rows_appended_during_a_compaction_stay(spark, table, monkeypatch):
    U.ensure_audit_table(spark, table)
    flushes(spark, 20).write.insertInto(table)
    run = T._run

    def switch(spark, statement):
        flushes(spark, 3, 5).write.insertInto(table)  # after the rows were read
        run(spark, statement)

    monkeypatch.setattr(T, "_run", switch)
    U.compact_audit(spark, table)
    assert T.scan_table(spark, table).count() == 23


def test_a_failed_compaction_changes_nothing(spark, table, monkeypatch):
    U.ensure_audit_table(spark, table)
    flushes(spark, 20).write.insertInto(table)
    before = facts(spark, table)

    def fails(spark, statement):
        raise OSError("busy")

    monkeypatch.setattr(T, "_run", fails)
    with pytest.raises(OSError, match="busy"):
        U.compact_audit(spark, table)
    assert facts(spark, table) == before


def test_compaction_of_an_empty_table(spark, table):
    U.ensure_audit_table(spark, table)
    U.compact_audit(spark, table)
    assert T.scan_table(spark, table).count() == 0


# --- states that merge -------------------------------------------------------------------


def gold_rows(spark, days, mag):
    rows = [(dt.datetime(2024, 1, day, 5), area, mag + day) for day in days for area in ("A", "B", None)]
    rows += [(None, "A", mag), (dt.datetime(2024, 1, days[0]), "A", None)]
    return spark.createDataFrame(rows, "updated timestamp, area string, mag float")


def summary(frame):
    return sorted(map(str, frame.select("date", "area", "events", "measured", "mag_sum", "mag_max").collect()))


def test_states_of_two_loads_are_the_whole_summary(spark, tmp_path):
    path = str(tmp_path / "states")
    first, second = gold_rows(spark, [1, 2, 3], 1.0), gold_rows(spark, [3, 4], 2.5)
    R.store_load_states(first, path, "a")
    written = {file: file.stat().st_mtime_ns for file in Path(path).rglob("*.parquet")}
    R.store_load_states(second, path, "b")
    assert summary(R.merged_summary(spark, path)) == summary(R.day_area_summary(first.union(second)))
    assert all(file.stat().st_mtime_ns == time for file, time in written.items())
    days = {file.parent.name for file in Path(path).rglob("*.parquet")} - {file.parent.name for file in written}
    assert days == {"date=2024-01-04"}


def test_a_load_that_is_run_again_counts_once(spark, tmp_path):
    path = str(tmp_path / "states")
    R.store_load_states(gold_rows(spark, [1, 2], 1.0), path, "a")
    R.store_load_states(gold_rows(spark, [1, 2, 3], 9.0), path, "b")
    R.store_load_states(gold_rows(spark, [2], 2.0), path, "b")  # other days this time
    whole = gold_rows(spark, [1, 2], 1.0).union(gold_rows(spark, [2], 2.0))
    assert summary(R.merged_summary(spark, path)) == summary(R.day_area_summary(whole))


def test_only_the_days_asked_for_are_read(spark, tmp_path):
    path = str(tmp_path / "states")
    R.store_load_states(gold_rows(spark, list(range(1, 20)), 1.0), path, "a")
    recent = R.merged_summary(spark, path, since=dt.date(2024, 1, 19))
    text = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in text and text.count("Exchange") == 1 and "partial_" in text
    assert {row.date for row in recent.collect()} == {dt.date(2024, 1, 19)}


def test_unfinished_states_are_refused(spark, tmp_path):
    path = str(tmp_path / "states")
    R.store_load_states(gold_rows(spark, [1], 1.0), path, "a")
    (Path(path) / "load=a" / commits.MANIFEST).unlink()
    with pytest.raises(FileNotFoundError):
        R.merged_summary(spark, path)
