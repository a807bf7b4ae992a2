"""The `events` table seen as a GeoJSON feed.

Every field of a feature is a SQL expression over a row of `events` that reads
the same in Spark and DuckDB, so queries and their SQL share one definition.

A document holds the features of one day and one block of consecutive event
ids. The event id is the key of `events`, so a document never holds more than
`BLOCK` features, however many events a day, user or type has.

Events are grouped as they are and become text where their document is written:
the text of a feature is some twenty times as long as what it says of its event.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tremorlake.schemas import COORDINATES, PROPERTIES

BLOCK = 200

PLACE = (
    "CASE WHEN event_id % 11 = 0 THEN event_type "
    "WHEN event_id % 13 = 0 THEN concat(user_id, ' km S of Bay of ', event_type) "
    "ELSE concat(user_id, ' km NE of ', event_type) END"
)

# Property -> expression. Times are in TIMES below, they differ per engine.
EXPRESSIONS = {
    "mag": "value",
    "place": PLACE,
    "tz": "CASE WHEN event_id % 5 = 0 THEN event_id % 24 * 60 - 720 END",
    "url": "concat('https://feed.example/event/', event_id)",
    "detail": "CASE WHEN event_id % 7 > 0 THEN concat('https://feed.example/detail/', event_id) END",
    "felt": "CASE WHEN event_id % 3 > 0 THEN user_id % 50 END",
    "cdi": "CASE WHEN event_id % 4 = 0 THEN value / 10 END",
    "mmi": "CASE WHEN event_id % 6 = 0 THEN value / 8 END",
    "alert": "CASE event_id % 4 WHEN 0 THEN 'green' WHEN 1 THEN 'yellow' END",
    "status": "CASE WHEN event_id % 2 = 0 THEN 'reviewed' ELSE 'automatic' END",
    "tsunami": "event_id % 2",
    "sig": "event_id % 1000",
    "net": "concat('n', user_id % 5)",
    "code": "concat('', event_id)",
    "ids": "concat(',n', user_id % 5, event_id, ',')",
    "sources": "concat(',n', user_id % 5, ',')",
    "types": "',origin,phase-data,'",
    "nst": "user_id",
    "dmin": "CASE WHEN event_id % 9 > 0 THEN CAST(event_id % 1000 AS DOUBLE) / 100 END",
    "rms": "CAST(user_id % 200 AS DOUBLE) / 100",
    "gap": "CAST(event_id % 360 AS DOUBLE)",
    "magType": "CASE event_id % 3 WHEN 0 THEN 'ml' WHEN 1 THEN 'md' ELSE 'mb' END",
    "title": "concat('Event ', event_id)",
    "type": "event_type",
}

POSITION = {
    "longitude": "CAST(user_id % 360 - 180 AS DOUBLE)",
    "latitude": "CAST(user_id % 180 - 90 AS DOUBLE)",
    "depth": "value",
}

UPDATE_DELAY_MS = 3_600_000

SPARK_TIMES = {
    "time": "unix_millis(CAST(ts AS TIMESTAMP))",
    "updated": f"unix_millis(CAST(ts AS TIMESTAMP)) + {UPDATE_DELAY_MS}",
}

# Faults of the rough feed, by event. `PLACE_NULL`, `GEOMETRY_NULL` and
# `SHORT_POSITION` are bad features, `BARE` has empty properties and geometry.
PLACE_NULL = "event_id % 97 = 13"
GEOMETRY_NULL = "event_id % 101 = 17"
SHORT_POSITION = "event_id % 103 = 19"
BARE = "event_id % 107 = 23"
BAD_FEATURE = f"({PLACE_NULL} OR {GEOMETRY_NULL} OR {SHORT_POSITION})"

# JSON text of two leaves of the rough feed: numbers of several spellings.
ROUGH_LEAVES = {
    "nst": (
        "CASE event_id % 5 WHEN 0 THEN '\"3.7\"' WHEN 1 THEN '\"7\"' WHEN 2 THEN 'true' "
        "WHEN 3 THEN '3.7' ELSE concat('', user_id) END"
    ),
    "mag": "CASE WHEN event_id % 3 = 0 THEN concat('\"', event_id % 90, '.5\"') "
    "ELSE concat('', event_id % 90, '.25') END",
    "time": (
        "CASE event_id % 29 WHEN 4 THEN 'null' WHEN 5 THEN '0' WHEN 6 THEN '\"abc\"' "
        "WHEN 7 THEN '\"\"' WHEN 8 THEN '-1500' ELSE concat('', event_ms) END"
    ),
    "alert": "CASE event_id % 4 WHEN 0 THEN '\"green\"' WHEN 1 THEN '\"\"' WHEN 2 THEN 'false' ELSE 'null' END",
}

# Faults of whole documents of the rough feed, by block.
BROKEN_BLOCK = 3
UNNAMED_BLOCK = 5
BLOCK_CYCLE = 7


def events(spark: SparkSession, sf_dir: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{sf_dir}/events.parquet")


def flat_features(events: DataFrame) -> DataFrame:
    """Events as the flat rows the flattened feed has, without the detour over JSON.

    Only the columns a query uses are read and computed.
    """
    fields = {**EXPRESSIONS, **SPARK_TIMES}
    properties = [
        f"CAST({fields[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in PROPERTIES.fields
    ]
    position = [f"CAST({POSITION[name]} AS float) AS {name}" for name in COORDINATES]
    return events.selectExpr(*properties, "'Point' AS geometry_type", *position)


# What a feature needs of its event, and a name or a literal in the SQL above.
FACTS = ("event_id", "event_ms", "user_id", "event_type", "value")
_TOKEN = re.compile(rf"'[^']*'|\b(?:{'|'.join(FACTS)})\b")

# Times of a feature, out of the facts of its event.
FEATURE_TIMES = {"time": "event_ms", "updated": f"event_ms + {UPDATE_DELAY_MS}"}


def _of_event(sql: str) -> str:
    """An expression over columns as one over the fields of a struct `event`."""
    return _TOKEN.sub(lambda token: token[0] if token[0].startswith("'") else f"event.{token[0]}", sql)


def _properties(rough: bool, faults: bool) -> str:
    fields = {**EXPRESSIONS, **FEATURE_TIMES}
    if rough:
        fields |= {name: f"parse_json({sql})" for name, sql in ROUGH_LEAVES.items()}
    if faults:
        fields["place"] = f"CASE WHEN NOT ({PLACE_NULL}) THEN {PLACE} END"
    return ", ".join(f"{sql} AS {name}" for name, sql in fields.items())


def _position(faults: bool) -> str:
    position = f"array({', '.join(POSITION[name] for name in COORDINATES)})"
    if faults:
        position = f"CASE WHEN {SHORT_POSITION} THEN slice({position}, 1, 2) ELSE {position} END"
    return position


def _feature_json(rough: bool, faults: bool) -> str:
    """The feature of an event as JSON text; a null field is written as null."""
    geometry = f"struct('Point' AS type, {_position(faults)} AS coordinates)"
    if faults:
        geometry = f"CASE WHEN NOT ({GEOMETRY_NULL}) THEN {geometry} END"
    text = f"""to_json(
        struct('Feature' AS type, struct({_properties(rough, faults)}) AS properties,
               {geometry} AS geometry, concat('', event_id) AS id),
        map('ignoreNullFields', 'false'))"""
    if rough:
        bare = """concat('{"type":"Feature","properties":{},"geometry":{},"id":"', event_id, '"}')"""
        text = f"CASE WHEN {BARE} THEN {bare} ELSE {text} END"
    return text


def documents(events: DataFrame, rough: bool = False, faults: bool = True) -> DataFrame:
    """The feed as raw documents over several lines (column `value`).

    The rough feed has leaves of mixed types and features without any. With its
    faults it also has bad features, and among every seven blocks one whose
    documents are cut off and one whose documents have no feature list.
    """
    faults = rough and faults
    timed = events.withColumns(
        {
            "event_ms": F.expr(SPARK_TIMES["time"]),
            "feed_day": F.to_date("ts"),
            "block": F.expr(f"event_id div {BLOCK}"),
        }
    )
    grouped = timed.groupBy("feed_day", "block").agg(F.collect_list(F.struct(*FACTS)).alias("events"))
    # Facts are shuffled, not text. A document is in the order of event id and text.
    written = _of_event(f"struct(event_id, {_feature_json(rough, faults)} AS feature)")
    features = f"array_sort(transform(events, event -> {written}))"
    grouped = grouped.withColumn("features", F.expr(features))
    head = F.concat(
        F.lit('{"type":"FeatureCollection",\n"metadata":{"generated":'),
        F.unix_millis(F.col("feed_day").cast("timestamp")),
        F.lit(',"url":"https://feed.example/day","title":"Events of a day","status":200,"api":"1","count":'),
        F.array_size("events"),
        F.lit('},\n"'),
    )
    listed = F.concat(
        F.lit('":[\n'),
        F.array_join(F.transform("features", lambda row: row["feature"]), ",\n"),
        F.lit("\n]}\n"),
    )
    if not faults:
        return grouped.select(F.concat(head, F.lit("features"), listed).alias("value"))
    cycle = F.col("block") % BLOCK_CYCLE
    name = F.when(cycle == UNNAMED_BLOCK, F.lit("entries")).otherwise(F.lit("features"))
    whole = F.concat(head, name, listed)
    cut = F.substring(whole, F.lit(1), F.length(whole) - 5)
    return grouped.select(F.when(cycle == BROKEN_BLOCK, cut).otherwise(whole).alias("value"))
