import json
from unittest import mock

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tests.conftest import document, feature
from tremorlake.operators import canonical as C
from tremorlake.schemas import CANONICAL_GOLD, CANONICAL_SILVER


def project(frame, *names, **options):
    return [tuple(row) for row in C.canonical_project(frame, **options).select(*names).collect()]


def one(lines, name, **properties):
    (row,) = project(lines(document(feature(properties))), name)
    return row[0]


@pytest.mark.parametrize(
    ("value", "expected"),
    [(7, 7), ("7", 7), ("3.7", 0), (3.7, 3), (-3.7, -3), (True, 1), (None, 0), ("", 0), ([], 0),
     ({}, 0), ("abc", 0), (3.0, 3), (" 7 ", 7), ("+7", 7), (0, 0)],
)
def test_int_leaf(lines, value, expected):
    assert one(lines, "station_count", nst=value) == expected


@pytest.mark.parametrize(
    ("value", "expected"),
    [(2.5, 2.5), ("2.5", 2.5), (2, 2.0), (True, 1.0), (None, 0.0), ("x", 0.0), ([1], 0.0), ("1e2", 100.0)],
)
def test_float_leaf(lines, value, expected):
    assert one(lines, "magnitude", mag=value) == expected


@pytest.mark.parametrize(
    ("value", "expected"),
    [("green", "green"), (None, ""), ("", ""), (0, ""), (0.0, ""), (False, ""), ([], ""), ({}, ""),
     ("0", "0"), ("false", "false"), ("[]", "[]")],
)
def test_text_leaf(lines, value, expected):
    assert one(lines, "alert_status", alert=value) == expected


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        (1731283200123, "2024-11-11T00:00:00.123000"),
        (1731283200000, "2024-11-11T00:00:00"),
        ("1731283200123", "2024-11-11T00:00:00.123000"),
        (1731283200700, "2024-11-11T00:00:00.700000"),
        (0, None),
        (None, None),
        ("", None),
        (False, None),
        ("abc", "1970-01-01T00:00:00"),
        ("0", "1970-01-01T00:00:00"),
        (0.5, "1970-01-01T00:00:00"),
        ([1], "1970-01-01T00:00:00"),
        (-1500, "1969-12-31T23:59:58.500000"),
    ],
)
def test_epoch_leaf(lines, value, expected):
    assert one(lines, "event_time", time=value) == expected


@pytest.mark.parametrize(
    ("place", "area"),
    [
        ("10 km S of Bay of Plenty, NZ", "Bay"),
        ("roof of X", "X"),
        ("Kof Y", ""),
        ("Alaska Peninsula", ""),
        ("5", ""),
        ("[x] of y", "y"),
    ],
)
def test_area(lines, place, area):
    assert project(lines(document(feature({"place": place}))), "place", "area") == [(place, area)]


def test_absent_keys_take_defaults(lines):
    bare = {"type": "Feature", "properties": {}, "geometry": {}}
    (row,) = C.canonical_project(lines(document(bare, {}))).distinct().collect()
    for field in CANONICAL_SILVER.fields:
        expected = {"float": 0.0, "int": 0, "string": ""}[field.dataType.simpleString()]
        if field.name in C.EPOCH_COLUMNS:
            expected = None
        assert row[field.name] == expected, field.name


BAD_FEATURES = {
    "null place": feature({"place": None}),
    "number place": feature({"place": 5}),
    "boolean place": feature({"place": True}),
    "null properties": feature(properties=None) | {"properties": None},
    "text properties": feature() | {"properties": "x"},
    "null geometry": feature() | {"geometry": None},
    "list geometry": feature() | {"geometry": [1, 2, 3]},
    "null position": feature(geometry={"coordinates": None}),
    "short position": feature(geometry={"coordinates": [1, 2]}),
    "number": 5,
    "null": None,
    "late epoch": feature({"time": 10**18}),
    "late epoch text": feature({"updated": "9" * 30}),
    "infinite int": feature({"sig": "INFINITE"}),
}


@pytest.mark.parametrize("name", BAD_FEATURES)
def test_bad_feature_ends_or_leaves_the_document(lines, name):
    text = document(
        feature({"code": "a"}), BAD_FEATURES[name], feature({"code": "b"}), feature({"code": "c"})
    ).replace('"INFINITE"', "1e400")
    frame = lines(text, document(feature({"code": "z"})))
    assert project(frame, "event_code") == [("a",), ("z",)]
    assert project(frame, "event_code", on_error="skip") == [("a",), ("b",), ("c",), ("z",)]


def test_epoch_text_that_is_no_integer_is_not_bad(lines):
    frame = lines(document(feature({"time": "1e30"}), feature({"time": 1})))
    assert project(frame, "event_time") == [("1970-01-01T00:00:00",), ("1970-01-01T00:00:00.001000",)]


def test_unknown_error_rule(lines):
    with pytest.raises(ValueError):
        C.canonical_project(lines(document(feature())), on_error="ignore")


GOOD = document(feature({"code": "good"}))
REJECTED_LINES = {
    "cut": GOOD[:-3],
    "text after": GOOD + " x",
    "two documents": GOOD + "," + GOOD,
    "no feature list": '{"type": "FeatureCollection"}',
    "null features": '{"features": null}',
    "object features": '{"features": {"a": 1}}',
    "list document": "[1]",
    "number document": "5",
    "null document": "null",
    "empty": "",
    "single quotes": GOOD.replace('"', "'"),
}


@pytest.mark.parametrize("name", REJECTED_LINES)
def test_rejected_line(lines, name):
    frame = lines(GOOD, REJECTED_LINES[name], GOOD)
    assert project(frame, "event_code") == [("good",), ("good",)]
    assert C.accepted_documents(frame).count() == 2
    assert [row.value for row in C.rejected_documents(frame).collect()] == [REJECTED_LINES[name]]


def test_empty_feature_list(lines):
    frame = lines('{"features": []}', GOOD)
    assert project(frame, "event_code") == [("good",)]
    assert C.rejected_documents(frame).count() == 0


def test_repeated_key_keeps_the_last(lines):
    text = document(feature()).replace('"place"', '"code": "first", "code": "last", "place"')
    odd = document(feature({"nst": "7"})).replace('"place"', '"code": "first", "code": "last", "place"')
    assert project(lines(text, odd), "event_code") == [("last",), ("last",)]


def odd_lines():
    leaves = [None, "", "0", 0, 1, 2.5, True, False, [], {}, "x", "12"]
    names = ["mag", "time", "nst", "alert", "url", "place", "cdi"]
    return [
        document(
            feature({"code": "first"}),
            *(feature({name: leaf, "code": f"{name}{i}"}) for i, leaf in enumerate(leaves)),
        )
        for name in names
    ]


@pytest.mark.parametrize("on_error", ["truncate", "skip"])
def test_typed_read_agrees_with_the_second_look(lines, monkeypatch, on_error):
    frame = lines(GOOD, *odd_lines())
    quick = sorted(map(str, C.canonical_project(frame, on_error).collect()))
    monkeypatch.setattr(C, "_needs_second_look", lambda features: "true")
    assert sorted(map(str, C.canonical_project(frame, on_error).collect())) == quick


LEAVES = st.one_of(
    st.none(),
    st.booleans(),
    st.integers(-(10**17), 10**17),
    st.integers(-3, 3),
    st.floats(-1e6, 1e6),
    st.sampled_from(["", "0", "7", "3.7", "false", "x of y of z", "[", "1e3", "NaN", " 8 ", "2.50"]),
    st.just([]),
    st.just({}),
)
FEATURES = st.builds(
    lambda properties, position: feature(properties, {"coordinates": position}),
    st.dictionaries(st.sampled_from(["mag", "time", "nst", "alert", "place", "felt", "type", "code"]), LEAVES),
    st.lists(st.one_of(st.none(), st.floats(-180, 180), st.integers(-9, 9)), min_size=2, max_size=4),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(FEATURES, max_size=4), min_size=20, max_size=40), st.sampled_from(["truncate", "skip"]))
def test_any_document_reads_the_same_both_ways(spark, feature_lists, on_error):
    texts = [(document(*features),) for features in feature_lists]
    frame = spark.createDataFrame(texts, "value string")
    quick = sorted(map(str, C.canonical_project(frame, on_error).collect()))
    with mock.patch.object(C, "_needs_second_look", lambda features: "true"):
        exact = sorted(map(str, C.canonical_project(frame, on_error).collect()))
    assert quick == exact


def test_clean_documents_need_no_second_look(lines):
    clean = feature({"time": 1, "updated": 2, "alert": None, "felt": None, "code": "0x", "mag": 2})
    assert not C.screen_documents(lines(document(clean))).filter("odd").count()


ODD_FEATURES = {
    "text of an object": '"{}"',
    "text with a place": json.dumps(json.dumps(feature())),
    "infinite integer": '{"properties": {"place": "of X", "nst": 1e400}, "geometry": {"coordinates": [1, 2, 3]}}',
    "number as code": '{"properties": {"place": "of X", "code": 1e5}, "geometry": {"coordinates": [1, 2, 3]}}',
    "long number as code": '{"properties": {"place": "of X", "code": 0.1234567890123456789}, "geometry": {"coordinates": [1, 2, 3]}}',
}


@pytest.mark.parametrize("name", list(ODD_FEATURES))
def test_long_documents_follow_the_same_rules(lines, name):
    short = '{"features": [%s, %s], "pad": "%s"}'
    both = [short % (ODD_FEATURES[name], json.dumps(feature({"nst": "7"})), "x" * size) for size in (1, 33 * 2**20)]
    few, many = (sorted(map(str, C.canonical_project(lines(text), "skip").collect())) for text in both)
    assert few == many and len(few) >= 1


@pytest.mark.parametrize("nst", ["7", '"7"'])
def test_nan_is_no_json(lines, nst):
    text = '{"features": [%s, {"properties": {"nst": %s, "mag": NaN}}]}' % (json.dumps(feature()), nst)
    assert C.canonical_project(lines(text)).count() == 0
    assert [row.kind for row in C.lost_input(lines(text)).collect()] == ["document"]


def test_lost_input(lines):
    bad = feature({"place": None})
    frame = lines(document(feature(), bad, feature()), "no json", '{"entries": []}', document(feature()))
    lost = sorted((row.kind, row.value[:9]) for row in C.lost_input(frame).collect())
    assert [kind for kind, _ in lost] == ["document", "document", "feature", "feature"]
    assert [row.kind for row in C.lost_input(frame, "skip").collect()].count("feature") == 1


def test_spread_is_one_exchange_when_asked_for(lines):
    def plan(**options):
        return C.canonical_project(lines(GOOD), **options)._jdf.queryExecution().executedPlan().toString()

    assert "Exchange" not in plan() and plan(spread=3).count("Exchange") == 1


def test_gold_types_and_times(lines):
    silver = C.canonical_project(lines(document(feature({"time": 1731283200123, "mag": 2.5}))))
    gold = C.gold_project(silver)
    assert gold.schema.simpleString() == CANONICAL_GOLD.simpleString()
    row = gold.selectExpr("date_format(event_time, 'HH:mm:ss.SSS') AS t", "last_update", "magnitude").first()
    assert tuple(row) == ("00:00:00.123", None, 2.5)


def test_without_place(lines):
    frame = lines(json.dumps({"features": [feature()]}))
    assert "place" not in C.canonical_project(frame, include_place=False).columns


@pytest.mark.parametrize("on_error", ["truncate", "skip"])
def test_tagged_rows_are_the_projected_ones(lines, on_error):
    bad = feature({"place": None})
    odd = feature({"nst": "7", "alert": False})
    frame = lines(
        document(feature(), odd, bad, feature({"code": "z"})), "no json", document(), document(feature()), '{"entries": []}'
    )
    tagged = C.tagged_project(frame, on_error)
    rows = tagged.filter("kind = 'row'").drop("kind", "lost")
    assert sorted(map(str, rows.collect())) == sorted(map(str, C.canonical_project(frame, on_error).collect()))
    lost = tagged.filter("kind <> 'row'")
    assert lost.filter("event_code IS NULL AND magnitude IS NULL").count() == lost.count() == (4 if on_error == "truncate" else 3)


def test_tagged_input_looks_at_a_line_once(lines):
    text = C.tagged_project(lines(GOOD))._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json(StructField(documents") == 1
    assert text.count("from_json(ArrayType(StructType(StructField(features") == 1
    with pytest.raises(ValueError, match="on_error"):
        C.tagged_input(lines(GOOD), "stop")


def long_documents(lines):
    """Three documents, two of them equal; bad features at the front, within and nowhere."""
    bad = feature({"place": None})
    long = [feature({"code": str(i), "nst": "7" if i % 3 else 7}) for i in range(700)]
    cut = [*long[:650], bad, *long[650:], bad]
    return lines(document(*cut), document(*long), document(*cut), document(bad, feature()), "no json", document())


@pytest.mark.parametrize("cut_rows", [1_000_000, 0])
def test_prefix_cut_over_tasks(spark, lines, tmp_path, monkeypatch, cut_rows):
    """A document's features are on many tasks, and the rows are those of the truncate rule."""
    monkeypatch.setattr(C, "CUT_ROWS", cut_rows)
    monkeypatch.setattr(C, "CUT_BLOCK", 50)
    frame = long_documents(lines)
    landed = C.land_features(frame, str(tmp_path / "features"))
    spread = spark.read.schema(landed.schema).parquet(str(tmp_path / "features")).repartition(7)
    for features in (landed, spread):
        rows = C.project_features(C.cut_features(features, str(tmp_path / "cuts")))
        assert sorted(map(str, rows.collect())) == sorted(map(str, C.canonical_project(frame).collect()))
    assert rows.count() == 650 + 700 + 650


def test_prefix_cut_is_one_exchange_with_a_partial_step(lines, tmp_path):
    landed = C.land_features(long_documents(lines), str(tmp_path / "features"))
    text = C.first_bad_ordinals(landed)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "partial_min" in text
    text = C.cut_features(landed, str(tmp_path / "cuts"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text


def test_a_large_document_is_read_by_many_tasks(spark, lines, tmp_path):
    """After landing, files are split by size, not by document."""
    landed = C.land_features(long_documents(lines).coalesce(1), str(tmp_path / "features"))
    rows = landed.select("document", "ordinal", F.to_json("feature").alias("feature"))
    rows.write.option("parquet.block.size", 4096).parquet(str(tmp_path / "small"))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        read = spark.read.parquet(str(tmp_path / "small"))
        places = read.select("document", F.spark_partition_id().alias("task")).distinct()
        assert places.groupBy("document").count().agg(F.max("count")).first()[0] > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


@pytest.mark.parametrize("cut_rows", [1_000_000, 0])
def test_losses_over_tasks_are_the_same(lines, tmp_path, monkeypatch, cut_rows):
    monkeypatch.setattr(C, "CUT_ROWS", cut_rows)
    monkeypatch.setattr(C, "CUT_BLOCK", 50)
    frame = long_documents(lines)
    tagged = C.tagged_over_tasks(C.land_features(frame, str(tmp_path / "features")), str(tmp_path / "cuts"))
    assert sorted(map(str, tagged.collect())) == sorted(map(str, C.tagged_project(frame).collect()))


def test_loads_by_feature(spark, lines, tmp_path):
    import datetime as dt

    from tremorlake.plans import jobs
    from tremorlake.sources import layers as L
    from tremorlake.sources import tables as T

    T.ensure_namespace(spark, "by_feature", str(tmp_path / "ns"))
    found = []
    for number, by_feature in enumerate((False, True)):
        result = jobs.canonical_load(
            long_documents(lines), str(tmp_path / f"lake{number}"), "daily", dt.date(2024, 1, 30), f"by_feature.t{number}", by_feature=by_feature
        )
        rows = L.read_silver(spark, result.silver, CANONICAL_SILVER).collect()
        lost = L.read_quarantine(spark, result.quarantine).collect()
        found.append((sorted(map(str, rows)), sorted(map(str, lost)), result.lost_documents, result.lost_features))
    assert found[0] == found[1] and found[0][2:] == (1, 2 * 52 + 2)
    with pytest.raises(ValueError, match="truncates"):
        jobs.canonical_load(lines(GOOD), str(tmp_path), "daily", dt.date(2024, 1, 30), "by_feature.t", on_error="skip", by_feature=True)
