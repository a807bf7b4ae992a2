"""The plans are the ones wanted: one exchange per question, pushed filters,
pruned columns, top-k without a full sort, and no Python in any of them."""

import re

import pytest

import __spark_entry__ as driver
from tremorlake.operators import analytics as A
from tremorlake.operators import canonical as C
from tremorlake.operators import nullable as N
from tremorlake.plans import report as R
from workload.store import AS_OF, store


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return store(spark, sf_dir)


@pytest.fixture(scope="module")
def gold(spark, tables):
    return spark.table(tables.gold())


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def exchanges(frame) -> int:
    return len(re.findall(r"\bExchange\b", plan(frame)))


@pytest.mark.parametrize(
    ("question", "expected"),
    [
        (A.count_by_area, 1),
        (A.avg_mag_by_area, 1),
        (A.count_by_day, 1),
        (A.count_by_day_area, 1),
        (A.avg_daily_count, 2),
        (A.avg_count_by_day_area, 1),
        (A.top_area_last_week, 1),
        (A.top_frequency_intensity, 1),
        (A.magnitude_above, 0),
    ],
)
def test_exchanges(gold, question, expected):
    assert exchanges(question(gold)) == expected


@pytest.mark.parametrize("question", [A.count_by_area, A.avg_mag_by_area, A.top_frequency_intensity])
def test_partial_aggregate_before_the_exchange(gold, question):
    assert "partial_" in plan(question(gold))


def test_strong_events_push_their_filter_and_read_two_columns(gold):
    text = plan(A.magnitude_above(gold))
    assert "GreaterThan(mag,5.0)" in text
    assert re.search(r"ReadSchema: struct<(mag:float,area:string|area:string,mag:float)>", text)


def test_last_week_is_pushed_and_pruned(gold):
    text = plan(A.top_area_last_week(gold, AS_OF))
    assert "ReadSchema: struct<mag:float,updated:timestamp,area:string>" in text
    assert "GreaterThanOrEqual(updated,2024-01-23 00:00:00.0)" in text


@pytest.mark.parametrize("question", [A.top_area_last_week, A.top_frequency_intensity])
def test_top_k(gold, question):
    assert "TakeOrderedAndProject" in plan(question(gold))


@pytest.mark.parametrize("on_error", ["truncate", "skip"])
def test_document_reads_do_not_shuffle_and_parse_once(tables, on_error):
    for rows in (N.transform_columns(N.flatten(tables.documents())), C.canonical_project(tables.lines(), on_error)):
        assert exchanges(rows) == 0
    text = plan(C.canonical_project(tables.lines(), on_error))
    assert text.count("from_json(StructField(documents") == 1
    assert text.count("from_json(ArrayType(StructType(StructField(features") == 1


def test_report_scans_the_table_once_for_the_summary(gold, tables):
    summary = R.stored_summary(gold, tables.fresh("summary"))
    answers = R.report(gold, summary, AS_OF)
    over_gold = [name for name, rows in answers.items() if "updated" in plan(rows) or "mag:float" in plan(rows)]
    assert over_gold == ["areas_above_5"]


@pytest.mark.parametrize(
    "name",
    ["canonical_project", "gold_project", "extract_properties", "conform_schema", "count_by_day_area"],
)
def test_no_python_in_the_plan(spark, sf_dir, name):
    text = plan(driver.queries()[name](spark, sf_dir))
    assert not re.search(r"Python|Pandas|ArrowEval", text)
