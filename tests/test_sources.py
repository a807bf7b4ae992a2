import datetime as dt
import json
from pathlib import Path

import pytest

from tests.conftest import document, feature
from tremorlake import session
from tremorlake.operators import canonical as C
from tremorlake.operators import nullable as N
from tremorlake.operators.shape import cast_columns, conform_schema
from tremorlake.schemas import CANONICAL_GOLD, CANONICAL_SILVER, NULLABLE, columns
from tremorlake.sources import layers as L
from tremorlake.sources import tables as T


def test_dated_paths():
    paths = L.Layers("/lake/", "nullable", "daily", dt.date(2024, 1, 5))
    assert paths.bronze == "/lake/bronze/nullable/daily/20240105/raw_data.json"
    assert paths.silver == "/lake/silver/nullable/daily/20240105/transformed_data"


def staged(spark, folder: Path, *texts):
    folder.mkdir()
    for number, text in enumerate(texts):
        (folder / f"{number}.json").write_text(text)
    return L.read_staged(spark, str(folder))


def test_pretty_documents_are_landed_on_one_line(spark, tmp_path):
    pretty = json.dumps(json.loads(document(feature(), feature())), indent=2).replace("\n", "\r\n")
    source = staged(spark, tmp_path / "in", pretty, document(feature()))
    assert L.read_bronze_json(spark, str(tmp_path / "in" / "0.json")).selectExpr(
        "sum(size(features))"
    ).first()[0] is None
    out = str(tmp_path / "out")
    assert L.land_bronze(source, out) is True
    assert L.read_bronze_text(spark, out).count() == 2
    assert N.flatten(L.read_bronze_json(spark, out)).count() == 3
    assert C.canonical_project(L.read_bronze_text(spark, out)).count() == 3


def test_landing_nothing_writes_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "value string")
    assert L.land_bronze(empty, str(tmp_path / "out")) is False
    assert not (tmp_path / "out").exists()


def test_landing_replaces(spark, lines, tmp_path):
    for text in ("{}", '{"a": 1}'):
        L.land_bronze(lines(text), str(tmp_path / "out"))
    assert [row.value for row in L.read_bronze_text(spark, str(tmp_path / "out")).collect()] == ['{"a": 1}']


def test_bronze_as_whole_text(spark, lines, tmp_path):
    L.land_bronze(lines("{}", "[]").coalesce(1), str(tmp_path / "out"))
    assert [row.value for row in L.read_bronze_text(spark, str(tmp_path / "out"), True).collect()] == ["{}\n[]\n"]


def test_single_silver_file_with_declared_schema(spark, lines, tmp_path):
    rows = C.canonical_project(lines(document(feature()), document(feature())).repartition(2))
    path = L.write_silver_typed(rows, str(tmp_path / "silver"), CANONICAL_SILVER, n_files=1)
    assert len(list(Path(path).glob("*.parquet"))) == 1
    assert L.read_silver(spark, f"{path}/*.parquet", CANONICAL_SILVER).count() == 2


def test_conform_schema(spark):
    frame = spark.createDataFrame([("1", "x", 2)], "a string, b string, extra int")
    target = columns("b string, a int, missing float")
    shaped = conform_schema(frame, target)
    assert shaped.schema.simpleString() == target.simpleString()
    assert tuple(shaped.first()) == ("x", 1, None)
    with pytest.raises(ValueError, match="extra"):
        conform_schema(frame, target, extra="error")


def test_cast_columns(spark):
    frame = spark.createDataFrame([("1", "2.5"), ("x", None)], "a string, b string")
    assert [tuple(row) for row in cast_columns(frame, {"a": "int", "b": "float"}).collect()] == [
        (1, 2.5),
        (None, None),
    ]


def test_debug_sample(spark):
    assert [row.id for row in L.debug_sample(spark.range(100), 3, ["id"]).collect()] == [0, 1, 2]
    assert L.debug_sample(spark.range(100), 7).count() == 7


@pytest.fixture
def namespace(spark, tmp_path):
    name = f"ns_{tmp_path.name.replace('-', '_')}"
    T.ensure_namespace(spark, name, str(tmp_path / "ns"))
    T.ensure_namespace(spark, name)
    return name


def test_append_without_place_and_twice(spark, lines, namespace):
    table = f"{namespace}.gold"
    for include_place in (True, False, True):
        silver = C.canonical_project(lines(document(feature())), include_place=include_place)
        T.append_by_name(C.gold_project(silver, include_place=include_place), table, CANONICAL_GOLD)
    places = sorted(str(row.place) for row in T.scan_table(spark, table).collect())
    assert places == ["5 km S of Here", "5 km S of Here", "None"]


def test_truncate_and_load(spark, namespace):
    schema = columns("a int")
    for value in (1, 2):
        T.truncate_and_load(spark.createDataFrame([(value,)], "a int"), f"{namespace}.t", schema)
    assert [row.a for row in T.scan_table(spark, f"{namespace}.t").collect()] == [2]


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_dir(spark, "x").startswith(f"{shared}/tremorlake/x-")


class FakeSession:
    """A session without a shared folder, on a given master."""

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})


def test_scratch_without_shared_folder():
    first, second = (session.scratch_dir(FakeSession("local[2]"), "x") for _ in range(2))
    assert first != second and Path(first).parents[1] == Path(second).parents[1]
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(FakeSession("yarn"), "x")


def test_failed_load_leaves_the_table(spark, tmp_path):
    from pyspark.sql import functions as F
    from pyspark.sql.types import LongType, StructType

    schema = StructType().add("n", LongType())
    namespace = f"failed_{tmp_path.name.replace('-', '_')}"
    T.ensure_namespace(spark, namespace, str(tmp_path / "ns"))
    table = f"{namespace}.t"
    for n in (10, 7):
        T.truncate_and_load(spark.range(n).toDF("n"), table, schema)
        assert T.scan_table(spark, table).count() == n
    broken = spark.range(3).select(F.when(F.col("id") < 2, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("n"))
    with pytest.raises(Exception, match="no"):
        T.truncate_and_load(broken, table, schema)
    assert T.scan_table(spark, table).count() == 7
    T.append_by_name(spark.range(1).toDF("n"), table, schema)
    assert T.scan_table(spark, table).count() == 8
    T.truncate_and_load(spark.range(2).toDF("m"), table, StructType().add("m", LongType()))
    assert T.scan_table(spark, table).columns == ["m"] and T.scan_table(spark, table).count() == 2


def test_silver_without_files_is_refused(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        L.read_silver(spark, str(tmp_path / "empty"), NULLABLE)


def test_clocks_are_utc_in_any_zone(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from tremorlake.functions import scalars as S

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.range(1).select(
            S.epoch_ms_to_iso(F.lit(1731283200123)).alias("a"),
            S.epoch_ms_to_iso(F.lit(-1500)).alias("b"),
            S.epoch_ms_to_iso(F.lit(0)).alias("c"),
            S.record_clock_iso(dt.datetime(2024, 3, 10, 7, 30)).alias("d"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == (
        "2024-11-11T00:00:00.123000",
        "1969-12-31T23:59:58.500000",
        "1970-01-01T00:00:00",
        "2024-03-10T07:30:00.000000",
    )


def test_scratch_is_removed_by_one_call(spark, monkeypatch):
    monkeypatch.setattr(session, "_made", [])  # not those of other tests
    paths = [session.scratch_dir(spark, "gone") for _ in range(3)]
    for path in paths[:2]:
        spark.range(3).write.parquet(path)
    assert session.remove_scratch(spark) == 2
    assert not any(Path(path).exists() for path in paths) and session.remove_scratch(spark) == 0
