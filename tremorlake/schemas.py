"""Declared schemas of every layer. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "float": FloatType(),
    "timestamp": TimestampType(),
}


def columns(text: str) -> StructType:
    """A flat schema from `name type, name type`; needs no running session."""
    named = (column.split() for column in text.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in named])


# ---------------------------------------------------------------------------
# Field names, types and order of the feed and of each table.
# ---------------------------------------------------------------------------
PROPERTIES = columns(
    "mag float, place string, time string, updated string, tz int, url string, "
    "detail string, felt int, cdi float, mmi float, alert string, status string, "
    "tsunami int, sig int, net string, code string, ids string, sources string, "
    "types string, nst int, dmin float, rms float, gap float, magType string, "
    "title string"
)

METADATA = columns(
    "generated bigint, url string, title string, status int, api string, count int"
)

COORDINATES = ("longitude", "latitude", "depth")

CANONICAL_SILVER = columns(
    "magnitude float, place string, event_time string, last_update string, "
    "timezone_offset int, info_url string, description string, felt_reports int, "
    "cdi_value float, mmi_value float, alert_status string, event_status string, "
    "tsunami_warning int, significance int, network_code string, event_code string, "
    "event_ids string, data_sources string, event_types string, station_count int, "
    "min_distance float, rms_value float, gap_angle float, magnitude_type string, "
    "event_type string, longitude float, latitude float, depth float, area string"
)

# Canonical column -> feed property it comes from.
CANONICAL_SOURCES = {
    "magnitude": "mag",
    "place": "place",
    "event_time": "time",
    "last_update": "updated",
    "timezone_offset": "tz",
    "info_url": "url",
    "description": "detail",
    "felt_reports": "felt",
    "cdi_value": "cdi",
    "mmi_value": "mmi",
    "alert_status": "alert",
    "event_status": "status",
    "tsunami_warning": "tsunami",
    "significance": "sig",
    "network_code": "net",
    "event_code": "code",
    "event_ids": "ids",
    "data_sources": "sources",
    "event_types": "types",
    "station_count": "nst",
    "min_distance": "dmin",
    "rms_value": "rms",
    "gap_angle": "gap",
    "magnitude_type": "magType",
    "event_type": "type",
}

EPOCH_COLUMNS = ("event_time", "last_update")

AUDIT = columns(
    "job_id string, pipeline_name string, function_name string, "
    "start_time timestamp, end_time timestamp, status string, error_msg string, "
    "process_record bigint"
)

# ---------------------------------------------------------------------------
# Schemas that follow from the ones above.
# ---------------------------------------------------------------------------
_GEOMETRY = StructType().add("type", StringType()).add("coordinates", ArrayType(FloatType()))

_FEATURE = (
    StructType()
    .add("type", StringType())
    .add("properties", PROPERTIES)
    .add("geometry", _GEOMETRY)
    .add("id", StringType())
)

BRONZE = (
    StructType()
    .add("type", StringType())
    .add("metadata", METADATA)
    .add("features", ArrayType(_FEATURE))
)


def _with_types(schema: StructType, change: dict[str, DataType]) -> list[StructField]:
    return [StructField(f.name, change.get(f.name, f.dataType), True) for f in schema.fields]


_LOADED_PROPERTIES = _with_types(
    PROPERTIES, {"time": TimestampType(), "updated": TimestampType()}
)

NULLABLE = StructType(
    [
        *_LOADED_PROPERTIES,
        StructField("geometry_type", StringType()),
        *(StructField(name, FloatType()) for name in COORDINATES),
        StructField("area", StringType()),
        StructField("insert_dt", TimestampType()),
    ]
)

AUDITED = StructType(
    [
        *_LOADED_PROPERTIES,
        *(StructField(name, FloatType()) for name in COORDINATES),
        StructField("id", StringType()),
        StructField("ingestion_timestamp", TimestampType()),
        StructField("area", StringType()),
        StructField("insert_dt", TimestampType()),
    ]
)

# The warehouse widens numbers and stores both event times as timestamps.
_WIDENED: dict[type, DataType] = {FloatType: DoubleType(), IntegerType: LongType()}

CANONICAL_GOLD = StructType(
    [
        *_with_types(
            StructType(
                [
                    StructField(f.name, _WIDENED.get(type(f.dataType), f.dataType))
                    for f in CANONICAL_SILVER.fields
                ]
            ),
            {name: TimestampType() for name in EPOCH_COLUMNS},
        ),
        StructField("insert_dt", TimestampType()),
    ]
)


def without(schema: StructType, *names: str) -> StructType:
    """The schema less the named columns, e.g. the canonical load without `place`."""
    return StructType([f for f in schema.fields if f.name not in names])
