import datetime as dt

from tests.conftest import document, feature
from tremorlake.functions import scalars as S
from tremorlake.operators import nullable as N
from tremorlake.schemas import AUDITED, NULLABLE


def test_flat_row(documents):
    text = document(feature({"mag": 2.5, "time": 1731283200123, "updated": 0, "felt": 3, "title": "t"}))
    rows = N.transform_columns(N.flatten(documents(text)), dt.datetime(2024, 1, 2))
    assert rows.schema.simpleString() == NULLABLE.simpleString()
    (row,) = rows.collect()
    assert (row.mag, row.felt, row.title, row.tz) == (2.5, 3, "t", None)
    assert (row.geometry_type, row.longitude, row.latitude, row.depth) == ("Point", 1.5, 2.5, 3.5)
    assert row.area == "Here"


def test_audited_row(documents):
    rows = N.transform_columns(N.flatten_audited(documents(document(feature()))))
    assert sorted(rows.columns) == sorted(AUDITED.fieldNames())
    assert rows.first()["id"] == "x"


def test_documents_without_features_give_no_rows(documents):
    assert N.flatten(documents('{"features": []}', '{"type": "x"}', "{broken")).count() == 0


def test_mistyped_leaves_become_null_and_the_row_stays(documents):
    text = document(feature({"mag": "2.5", "felt": 3.0, "sig": 4}))
    (row,) = N.flatten(documents(text)).select("mag", "felt", "sig").collect()
    assert tuple(row) == (None, None, 4)


def test_null_place_keeps_all_rows(documents):
    text = document(feature(), feature({"place": None}), feature(), feature())
    rows = N.transform_columns(N.flatten(documents(text)))
    assert [row.area for row in rows.collect()] == ["Here", None, "Here", "Here"]


def test_missing_and_short_positions_are_null(documents):
    text = document(feature() | {"geometry": None}, feature(geometry={"coordinates": [1, 2]}))
    rows = N.flatten(documents(text)).select("longitude", "latitude", "depth")
    assert [tuple(row) for row in rows.collect()] == [(None, None, None), (1.0, 2.0, None)]


def test_epoch_to_timestamp(spark):
    texts = ["1731283200123", "0", None, "abc", "-1500", "1.7312832E12", "9" * 40]
    frame = spark.createDataFrame([(text,) for text in texts], "ms string")
    shown = frame.select(S.epoch_ms_to_timestamp("ms").cast("string").alias("t"))
    assert [row.t for row in shown.collect()][:6] == [
        "2024-11-11 00:00:00",
        "1970-01-01 00:00:00",
        None,
        None,
        "1969-12-31 23:59:59",
        "2024-11-11 00:00:00",
    ]


def test_area_regex_and_split(spark):
    places = ["10 km S of Bay of Plenty, NZ", "roof of X", "Kof Y", "Alaska Peninsula", None]
    frame = spark.createDataFrame([(place,) for place in places], "place string")
    rows = frame.select(S.area_regex("place").alias("r"), S.area_split("place").alias("s")).collect()
    assert [tuple(row) for row in rows] == [
        ("Bay of Plenty, NZ", "Bay"),
        ("of X", "X"),
        ("Y", ""),
        ("", ""),
        (None, ""),
    ]


def test_clocks(spark):
    moment = dt.datetime(2024, 1, 30, 12, 30, 0, 5)
    row = spark.range(1).select(
        S.load_clock(moment).cast("string").alias("t"), S.record_clock_iso(moment).alias("iso")
    ).first()
    assert tuple(row) == ("2024-01-30 12:30:00.000005", "2024-01-30T12:30:00.000005")
    spread = spark.range(0, 1000, 1, 4).select(S.load_clock().alias("t")).distinct()
    assert spread.count() == 1


def test_days_before(spark):
    row = spark.range(1).select(
        S.days_before(dt.date(2024, 1, 30), 7).alias("d"), S.days_before(None, 0).alias("today")
    ).first()
    assert row.d == dt.date(2024, 1, 23)
    assert abs((row.today - dt.date.today()).days) <= 1
