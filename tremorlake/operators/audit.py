"""One audit row per stage of a job.

A stage that only builds a plan has no row count yet. Its count is observed
while the sink of its layer runs, and its audit row is written after that
action, so counting costs no extra pass over the data.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tremorlake.schemas import AUDIT
from tremorlake.sources.commits import RECORDS
from tremorlake.sources.layers import memory_frame
from tremorlake.sources.tables import KEEP, append_by_name, compact, ensure_table

log = logging.getLogger(__name__)

# Stage states, the default name of a job, and error texts that
# show up in the audit table.
SUCCESS = "Success"
FAILED = "Failed"
DEFAULT_PIPELINE = "DataPipeline"
NO_DATA = "No data to upload"
NO_FRAME = "Transformed DataFrame is None"
NOT_COUNTED = "no count of this stage"
ERROR_SEPARATOR = "; "


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def observe_count(df: DataFrame, observation: Observation) -> DataFrame:
    """Count the rows of `df` while some later action runs over it.

    Place it in the stage that writes: there a retried task counts once. A
    stage that feeds a shuffle may run twice when an executor is lost.
    """
    return df.observe(observation, F.count(F.lit(1)).alias(RECORDS))


def observed_count(observation: Observation) -> int:
    """The count, once the action is over."""
    return observation.get[RECORDS]


def audit_row(
    job_id: object,
    pipeline_name: str,
    function_name: str,
    start_time: dt.datetime,
    end_time: dt.datetime,
    status: str,
    error_msg: str | None,
    process_record: int = 0,
) -> tuple:
    """One row of the audit table: the id as text, both times in whole seconds."""
    return (
        str(job_id),
        pipeline_name,
        function_name,
        start_time.replace(microsecond=0),
        end_time.replace(microsecond=0),
        status,
        error_msg,
        process_record,
    )


def audit_frame(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Audit rows as a typed frame."""
    return memory_frame(spark, rows, AUDIT)


def ensure_audit_table(spark: SparkSession, table: str) -> None:
    ensure_table(spark, table, AUDIT)


def append_audit(spark: SparkSession, table: str, rows: Sequence[tuple]) -> None:
    append_by_name(audit_frame(spark, rows), table, AUDIT)


def compact_audit(spark: SparkSession, table: str, keep: dt.timedelta = KEEP) -> int:
    """Turn the small files of many flushes into one file a month; the number of files."""
    return compact(spark, table, "start_time", keep)


@dataclass
class Stage:
    """What is known about a stage; the body of the stage fills in `records`."""

    function_name: str
    start_time: dt.datetime
    end_time: dt.datetime | None = None
    error: str | None = None
    records: int | Observation = 0

    def fail(self, error: str) -> None:
        self.error = self.error or error

    def count(self) -> int:
        """The records; a count whose action never ran makes the stage a failed one."""
        if self.error is None and isinstance(self.records, Observation):
            try:
                return observed_count(self.records)
            except Exception as error:
                self.fail(f"{NOT_COUNTED}: {error}")
        return 0 if self.error is not None else self.records


@dataclass
class AuditTrail:
    """Collects the stages of one run and appends them to the audit table.

    `append` writes rows and raises when that fails; a test can hand in its own.
    """

    spark: SparkSession
    table: str
    job_id: object
    pipeline_name: str = DEFAULT_PIPELINE
    raise_on_error: bool = False
    clock: Callable[[], dt.datetime] = utc_now
    append: Callable[[SparkSession, str, Sequence[tuple]], None] = append_audit
    pending: list[Stage] = field(default_factory=list)
    failed: bool = False

    @contextmanager
    def stage(self, function_name: str) -> Iterator[Stage]:
        """Time a stage and note how it ended.

        An error is noted and swallowed, unless the trail was told to raise; the
        caller sees by the missing result that the stage failed.
        """
        stage = Stage(function_name, self.clock())
        self.pending.append(stage)
        try:
            yield stage
        except Exception as error:
            stage.fail(str(error))
            if self.raise_on_error:
                stage.end_time = self.clock()
                self.flush()
                raise
            log.error("%s failed: %s", function_name, error)
        finally:
            stage.end_time = stage.end_time or self.clock()
            self.failed = self.failed or stage.error is not None

    def fail_pending(self, error: str) -> None:
        """An action failed, so the stages it was to run have failed with it."""
        for stage in self.pending:
            stage.fail(error)
        self.failed = True

    def flush(self) -> None:
        """Append the audit rows of all finished stages in one write."""
        stages, self.pending = self.pending, []
        if stages:
            self._append_with_retry([self._row(stage) for stage in stages])

    def _row(self, stage: Stage) -> tuple:
        records = stage.count()
        return audit_row(
            self.job_id,
            self.pipeline_name,
            stage.function_name,
            stage.start_time,
            stage.end_time or self.clock(),
            FAILED if stage.error is not None else SUCCESS,
            stage.error,
            records,
        )

    def _append_with_retry(self, rows: list[tuple]) -> None:
        """Append; on an error add it to the rows' messages and try once more.

        If that fails too, the rows are tried one by one. A row that still fails
        is logged only: a load must not fail for its audit.
        """
        try:
            self.append(self.spark, self.table, rows)
        except Exception as error:
            note = f"Insertion Error: {error}"
            message = AUDIT.fieldNames().index("error_msg")
            noted = [
                (*row[:message], ERROR_SEPARATOR.join(filter(None, [row[message], note])), *row[message + 1 :])
                for row in rows
            ]
            try:
                self.append(self.spark, self.table, noted)
            except Exception:
                self._append_each(noted)

    def _append_each(self, rows: list[tuple]) -> None:
        """Append row by row, so that one that can't be stored doesn't take the others along."""
        for row in rows:
            try:
                self.append(self.spark, self.table, [row])
            except Exception as error:
                log.error("audit row %s not stored: %s", row, error)
