"""The same results as DuckDB SQL over the `events` view.

`feature` has one row per event with the columns of the flat nullable rows;
`rough` has one row per event with what the rough feed says about it.
"""

from __future__ import annotations

from pyspark.sql.types import DataType, FloatType, IntegerType, StringType, StructType

from tremorlake.schemas import (
    AUDITED,
    CANONICAL_SILVER,
    CANONICAL_SOURCES,
    COORDINATES,
    NULLABLE,
    PROPERTIES,
)
from workload import feed
from workload.store import AS_OF

SHOWN = "'%Y-%m-%d %H:%M:%S.%g'"
CLOCKS = ("insert_dt", "ingestion_timestamp")
SQL_TYPES: dict[type, str] = {FloatType: "FLOAT", IntegerType: "INTEGER"}

MOMENTS = {"time": "ts", "updated": "ts + INTERVAL 1 HOUR"}
AREA_REGEX = f"regexp_extract({feed.PLACE}, 'of (.+)$', 1)"
AREA_SPLIT = f"coalesce(string_split({feed.PLACE}, ' of ')[2], '')"


def sql_type(to: DataType) -> str:
    return SQL_TYPES.get(type(to), "VARCHAR")


def typed(expression: str, to: DataType) -> str:
    return f"CAST({expression} AS {sql_type(to)})"


def shown_seconds(moment: str) -> str:
    return f"strftime(date_trunc('second', {moment}), {SHOWN})"


def shown_millis(moment: str) -> str:
    return f"strftime(date_trunc('millisecond', {moment}), {SHOWN})"


def iso(ms: str) -> str:
    """ISO text of epoch milliseconds; the fraction only if there is one."""
    moment = f"make_timestamp({ms} * 1000)"
    return (
        f"CASE WHEN {ms} % 1000 = 0 THEN strftime({moment}, '%Y-%m-%dT%H:%M:%S') "
        f"ELSE strftime({moment}, '%Y-%m-%dT%H:%M:%S.%f') END"
    )


def millis(moment: str) -> str:
    """Whole epoch milliseconds, cut rather than rounded."""
    return f"(epoch_us({moment}) // 1000)"


def position(name: str) -> str:
    return f"CAST({feed.POSITION[name]} AS FLOAT)"


def flat_columns() -> list[str]:
    """The 25 properties as the bronze schema types them; times are epoch text."""
    columns = []
    for field in PROPERTIES.fields:
        if field.name in MOMENTS:
            expression = millis(MOMENTS[field.name])
        else:
            expression = feed.EXPRESSIONS[field.name]
        columns.append(f'{typed(expression, field.dataType)} AS "{field.name}"')
    return columns


def nullable_columns(schema=NULLABLE, nulls: tuple[str, ...] = ()) -> str:
    known = {
        **{name: shown_seconds(moment) for name, moment in MOMENTS.items()},
        **{name: position(name) for name in COORDINATES},
        "geometry_type": "'Point'",
        "area": AREA_REGEX,
        "id": "CAST(event_id AS VARCHAR)",
    }
    columns = []
    for field in schema.fields:
        if field.name in CLOCKS:
            continue
        if field.name in nulls:
            expression = "CAST(NULL AS VARCHAR)"
        elif field.name in known:
            expression = known[field.name]
        else:
            expression = typed(feed.EXPRESSIONS[field.name], field.dataType)
        columns.append(f'{expression} AS "{field.name}"')
    return ", ".join(columns)


def canonical_columns(gold: bool = False, schema=None) -> str:
    widened = {FloatType: "DOUBLE", IntegerType: "BIGINT"}
    columns = []
    for field in (schema or CANONICAL_SILVER).fields:
        name, source = field.name, CANONICAL_SOURCES.get(field.name)
        if source in MOMENTS:
            moment = MOMENTS[source]
            expression = shown_millis(moment) if gold else iso(millis(moment))
        elif name == "area":
            expression = AREA_SPLIT
        else:
            raw = feed.POSITION[name] if name in COORDINATES else feed.EXPRESSIONS[source]
            default = "0" if type(field.dataType) in SQL_TYPES else "''"
            expression = typed(f"coalesce({raw}, {default})", field.dataType)
            if gold and type(field.dataType) in widened:
                expression = f"CAST({expression} AS {widened[type(field.dataType)]})"
        columns.append(f'{expression} AS "{name}"')
    return ", ".join(columns)


NULLABLE_ROWS = f"SELECT {nullable_columns()} FROM events"
CANONICAL_ROWS = f"SELECT {canonical_columns()} FROM events"
GOLD_ROWS = f"SELECT {canonical_columns(gold=True)} FROM events"

FEATURE = f"""
WITH feature AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS code, CAST(value AS FLOAT) AS mag,
         {AREA_REGEX} AS area,
         CAST(ts + INTERVAL 1 HOUR AS DATE) AS updated_day, CAST(ts AS DATE) AS event_day
  FROM events
)"""

DOCUMENTS = f"""
  SELECT CAST(ts AS DATE) AS feed_day, event_id // {feed.BLOCK} AS block, count(*) AS features
  FROM events GROUP BY ALL"""

# What the rough feed keeps: features of readable documents before the first
# bad one of their document.
ROUGH = f"""
WITH rough AS (
  SELECT *, {millis("ts")} AS event_ms, CAST(ts AS DATE) AS feed_day,
         event_id // {feed.BLOCK} AS block, {feed.BARE} AS bare,
         NOT ({feed.BARE}) AND {feed.BAD_FEATURE} AS bad
  FROM events
), readable AS (
  SELECT * FROM rough
  WHERE block % {feed.BLOCK_CYCLE} NOT IN ({feed.BROKEN_BLOCK}, {feed.UNNAMED_BLOCK})
), kept AS (
  SELECT readable.*
  FROM readable LEFT JOIN (
    SELECT feed_day, block, min(event_id) AS first_bad FROM readable WHERE bad GROUP BY ALL
  ) USING (feed_day, block)
  WHERE first_bad IS NULL OR event_id < first_bad
)"""

# The rough feed without its faults keeps every event.
MIXED = f"""
WITH kept AS (SELECT *, {millis("ts")} AS event_ms, {feed.BARE} AS bare FROM events)"""

DAY = "strftime({0}, '%Y-%m-%d') AS date"
UPDATED_DAY = DAY.format("updated_day")
WEEK_START = f"DATE '{AS_OF}' - 7"


def audit_rows(*stages: str) -> str:
    """Successful audit rows that count the events, one per stage."""
    rows = [
        f"SELECT '101' AS job_id, 'DataPipeline' AS pipeline_name, '{stage}' AS function_name, "
        "'Success' AS status, CAST(NULL AS VARCHAR) AS error_msg, "
        "CAST(count(*) AS BIGINT) AS process_record FROM events"
        for stage in stages
    ]
    return " UNION ALL ".join(rows)


def two_stages(count_message: str, refuse_message: str) -> str:
    return (
        f"SELECT '101' AS job_id, 'DataPipeline' AS pipeline_name, 'count' AS function_name, "
        f"'Success' AS status, {count_message} AS error_msg, "
        "CAST(count(*) AS BIGINT) AS process_record FROM events "
        "UNION ALL SELECT '101', 'DataPipeline', 'refuse', 'Failed', "
        f"{refuse_message}, CAST(0 AS BIGINT)"
    )


_RETRY_NOTE = "Insertion Error: sink busy"

_STAGE_COUNTS = """
  SELECT unnest(['fetch', 'land', 'read']) AS function_name, (SELECT count(*) FROM document) AS n
  UNION ALL
  SELECT unnest(['flatten', 'transform', 'save', 'load']), (SELECT count(*) FROM events)"""

_EVENT_MS = """CASE event_id % 29 WHEN 4 THEN NULL WHEN 5 THEN NULL WHEN 6 THEN 0
  WHEN 7 THEN NULL WHEN 8 THEN -1500 ELSE event_ms END"""

# Columns of the rough feed that differ from the clean one.
ROUGH_CODE = "CASE WHEN bare THEN '' ELSE CAST(event_id AS VARCHAR) END AS event_code"
ROUGH_TIME = f"CASE WHEN bare THEN NULL ELSE {iso(f'({_EVENT_MS})')} END AS event_time"
ROUGH_UPDATE = f"CASE WHEN bare THEN NULL ELSE {iso('(event_ms + 3600000)')} END AS last_update"
ROUGH_STATIONS = """CAST(CASE WHEN bare THEN 0 ELSE
  CASE event_id % 5 WHEN 0 THEN 0 WHEN 1 THEN 7 WHEN 2 THEN 1 WHEN 3 THEN 3 ELSE user_id END
  END AS INTEGER) AS station_count"""
ROUGH_MAGNITUDE = """CAST(CASE WHEN bare THEN 0.0 WHEN event_id % 3 = 0 THEN event_id % 90 + 0.5
  ELSE event_id % 90 + 0.25 END AS FLOAT) AS magnitude"""
ROUGH_ALERT = "CASE WHEN NOT bare AND event_id % 4 = 0 THEN 'green' ELSE '' END AS alert_status"


def rough_columns() -> str:
    """The whole canonical row of the rough feed."""
    own = [ROUGH_CODE, ROUGH_TIME, ROUGH_UPDATE, ROUGH_STATIONS, ROUGH_MAGNITUDE, ROUGH_ALERT]
    known = {column.rsplit(" AS ", 1)[1]: column for column in own}
    columns = []
    for field in CANONICAL_SILVER.fields:
        if field.name in known:
            columns.append(known[field.name])
            continue
        default = "0" if type(field.dataType) in SQL_TYPES else "''"
        clean = canonical_columns(schema=StructType([field])).rsplit(" AS ", 1)[0]
        columns.append(
            f"CASE WHEN bare THEN {typed(default, field.dataType)} ELSE {clean} END AS {field.name}"
        )
    return ", ".join(columns)


def json_leaf(name: str, expression: str) -> str:
    """A field of a feature as JSON text; a null is written as null."""
    texts = {field.name for field in PROPERTIES.fields if isinstance(field.dataType, StringType)} | {"type"}
    shown = f"CAST({expression} AS VARCHAR)"
    if name in texts and name not in MOMENTS:
        shown = f"'\"' || {shown} || '\"'"
    return f"'\"{name}\":' || coalesce({shown}, 'null')"


def _line_hashes() -> str:
    """Hashes of the landed lines: the whole text of each document, rebuilt from its events."""
    fields = {**feed.EXPRESSIONS, **{name: millis(moment) for name, moment in MOMENTS.items()}}
    properties = " || ',' || ".join(json_leaf(name, expression) for name, expression in fields.items())
    position = " || ',' || ".join(f"CAST({feed.POSITION[name]} AS VARCHAR)" for name in COORDINATES)
    feature = f"""'{{"type":"Feature","properties":{{' || {properties} ||
    '}},"geometry":{{"type":"Point","coordinates":[' || {position} || ']}},"id":"' || event_id || '"}}'"""
    return f"""
WITH feature AS (
  SELECT CAST(ts AS DATE) AS feed_day, event_id // {feed.BLOCK} AS block, event_id, {feature} AS text FROM events
), line AS (
  SELECT '{{"type":"FeatureCollection", "metadata":{{"generated":' || {millis("CAST(feed_day AS TIMESTAMP)")} ||
    ',"url":"https://feed.example/day","title":"Events of a day","status":200,"api":"1","count":' || count(*) ||
    '}}, "features":[ ' || string_agg(text, ', ' ORDER BY event_id) || ' ]}}' AS text
  FROM feature GROUP BY feed_day, block
)
SELECT sha256(text) AS line_sha256, false AS landed_without_data FROM line"""


LINE_HASHES = _line_hashes()

ORACLES: dict[str, str] = {
    # sources and sinks
    "bronze_land": LINE_HASHES,
    "bronze_read_text": f"""
SELECT {millis("CAST(feed_day AS TIMESTAMP)")} AS generated, features AS declared FROM ({DOCUMENTS})""",
    "bronze_read_json": f"""
SELECT 'FeatureCollection' AS document_type, {millis("CAST(feed_day AS TIMESTAMP)")} AS generated,
       'Events of a day' AS title, CAST(200 AS INTEGER) AS status,
       CAST(features AS INTEGER) AS declared, CAST(features AS INTEGER) AS features
FROM ({DOCUMENTS})""",
    "silver_write": NULLABLE_ROWS,
    "silver_write_single": CANONICAL_ROWS,
    "silver_read": f"SELECT code, mag, sig, nst, felt, time, area FROM ({NULLABLE_ROWS})",
    "gold_append": f"{GOLD_ROWS} UNION ALL {GOLD_ROWS}",
    "gold_append_repeatable": " UNION ALL ".join(f"SELECT *, '{day}' AS load_id FROM ({GOLD_ROWS})" for day in ("20240129", "20240130")),
    "gold_truncate_load": NULLABLE_ROWS,
    "gold_new_columns": NULLABLE_ROWS,
    "ensure_namespace": "SELECT true AS namespace_exists, count(*) AS stored FROM events",
    "ensure_table": audit_rows("count"),
    "table_scan": f"SELECT code, area, mag, updated FROM ({NULLABLE_ROWS})",
    "dated_path": f"""
SELECT 'bronze/nullable/daily/20240130/raw_data.json' AS path, count(*) AS documents
FROM ({DOCUMENTS})""",
    "memory_source": "SELECT 'daily' AS feed, count(*) AS records FROM events",
    "debug_sample": """
SELECT event_id, event_type, user_id FROM events ORDER BY event_id LIMIT 20""",
    # projections, nesting, schema
    "explode_features": "SELECT CAST(event_id AS VARCHAR) AS id, 'Feature' AS type FROM events",
    "extract_properties": f"SELECT {', '.join(flat_columns())} FROM events",
    "split_coordinates": f"""
SELECT CAST(event_id AS VARCHAR) AS id,
       {", ".join(f"{position(name)} AS {name}" for name in COORDINATES)} FROM events""",
    "drop_columns": "SELECT CAST(event_id AS VARCHAR) AS id, 'Point' AS geometry_type FROM events",
    "cast_columns": f"SELECT code, mag, sig, felt FROM ({NULLABLE_ROWS})",
    "with_columns": f"SELECT code, time, updated, area FROM ({NULLABLE_ROWS})",
    "canonical_project": CANONICAL_ROWS,
    "gold_project": GOLD_ROWS,
    "audited_project": f"SELECT {nullable_columns(AUDITED)} FROM events",
    "conform_schema": f"SELECT {nullable_columns(nulls=('geometry_type',))} FROM events",
    "append_missing_column": f"""
SELECT event_code, place, area FROM ({GOLD_ROWS})
UNION ALL SELECT event_code, CAST(NULL AS VARCHAR), area FROM ({GOLD_ROWS})""",
    "split_outputs": """
SELECT 'silver' AS tag, count(*) AS records FROM events UNION ALL SELECT 'bq', 0""",
    # scalar functions
    "safe_cast": f"""{MIXED}
SELECT {ROUGH_CODE}, {ROUGH_STATIONS}, {ROUGH_MAGNITUDE},
       CASE WHEN bare THEN '' ELSE {feed.PLACE} END AS place
FROM kept""",
    "falsy_to_empty": f"""{MIXED}
SELECT {ROUGH_CODE}, {ROUGH_ALERT},
       CASE WHEN bare THEN '' ELSE coalesce({feed.EXPRESSIONS["detail"]}, '') END AS description
FROM kept""",
    "epoch_ms_to_timestamp": f"""
SELECT CAST(event_id AS VARCHAR) AS code, {shown_seconds("ts")} AS time FROM events""",
    "epoch_ms_to_iso": f"{MIXED} SELECT {ROUGH_CODE}, {ROUGH_TIME}, {ROUGH_UPDATE} FROM kept",
    "area_regex": f"SELECT CAST(event_id AS VARCHAR) AS code, {AREA_REGEX} AS area FROM events",
    "area_split": f"SELECT CAST(event_id AS VARCHAR) AS code, {AREA_SPLIT} AS area FROM events",
    "to_date": f"{FEATURE} SELECT code, {UPDATED_DAY} FROM feature",
    "load_clock": "SELECT count(*) AS stamped, true AS constant FROM events",
    "record_clock_iso": """
SELECT count(*) AS stamped, '2024-01-30T12:00:00.000000' AS first_clock,
       '2024-01-30T12:00:00.000000' AS last_clock FROM events""",
    "date_arith": f"""{FEATURE}
SELECT strftime({WEEK_START}, '%Y-%m-%d') AS week_start,
       count(*) FILTER (updated_day < {WEEK_START}) AS before,
       count(*) FILTER (updated_day >= {WEEK_START}) AS since
FROM feature""",
    "json_parse": f"""
SELECT block % {feed.BLOCK_CYCLE} <> {feed.BROKEN_BLOCK} AS is_json, count(*) AS documents
FROM ({DOCUMENTS}) GROUP BY 1""",
    "json_serialise": f"""
SELECT concat('{{"code":"', event_id, '","area":"', {AREA_REGEX}, '","sig":', event_id % 1000, '}}')
         AS document
FROM events""",
    "field_default": f"""{MIXED}
SELECT {ROUGH_CODE},
       CASE WHEN bare THEN '' ELSE {AREA_SPLIT} END AS area,
       CASE WHEN bare THEN CAST(0 AS FLOAT) ELSE {position("longitude")} END AS longitude,
       CASE WHEN bare THEN CAST(0 AS FLOAT) ELSE {position("depth")} END AS depth
FROM kept""",
    # errors
    "skip_bad_documents": f"""
SELECT readable AS accepted, count(*) AS documents,
       CAST(sum(CASE WHEN readable THEN features ELSE 0 END) AS BIGINT) AS features
FROM (
  SELECT *, block % {feed.BLOCK_CYCLE} NOT IN ({feed.BROKEN_BLOCK}, {feed.UNNAMED_BLOCK}) AS readable
  FROM ({DOCUMENTS})
) GROUP BY 1""",
    "truncate_at_bad_feature": f"{ROUGH} SELECT {rough_columns()} FROM kept",
    "truncate_over_tasks": f"{ROUGH} SELECT {rough_columns()} FROM kept",
    "skip_bad_feature": f"{ROUGH} SELECT {ROUGH_CODE}, {ROUGH_TIME} FROM readable WHERE NOT bad",
    "job_canonical_quarantine": f"""{ROUGH}, lost AS (
  SELECT 'feature' AS kind, CAST(event_id AS VARCHAR) AS code
  FROM readable ANTI JOIN kept USING (event_id)
  UNION ALL
  SELECT 'document', NULL FROM (SELECT DISTINCT feed_day, block FROM rough)
  WHERE block % {feed.BLOCK_CYCLE} IN ({feed.BROKEN_BLOCK}, {feed.UNNAMED_BLOCK})
)
SELECT kind, code, count(*) FILTER (WHERE kind = 'document') OVER () AS lost_documents,
       count(*) FILTER (WHERE kind = 'feature') OVER () AS lost_features FROM lost""",
    # predicates, aggregates, windows, top-k
    "magnitude_above": f"{FEATURE} SELECT area, mag FROM feature WHERE mag > 5",
    "last_week_filter": f"""{FEATURE}
SELECT code, {UPDATED_DAY} FROM feature WHERE updated_day >= {WEEK_START}""",
    "count_by_area": f"""{FEATURE}
SELECT area, count(*) AS earthquake_count_by_region FROM feature GROUP BY area""",
    "avg_mag_by_area": f"""{FEATURE}
SELECT area, round(avg(CAST(mag AS DOUBLE)), 4) AS avg_mag FROM feature GROUP BY area""",
    "count_by_day": f"""{FEATURE}
SELECT {UPDATED_DAY}, count(*) AS num_of_eq FROM feature GROUP BY updated_day""",
    "count_by_day_area": f"""{FEATURE}
SELECT {UPDATED_DAY}, area, count(*) AS num_of_eq FROM feature GROUP BY updated_day, area""",
    "avg_daily_count": f"""{FEATURE}
SELECT round(avg(n), 4) AS average_earthquakes_same_day
FROM (SELECT count(*) AS n FROM feature GROUP BY updated_day)""",
    "avg_count_day_area": f"""{FEATURE}
SELECT date, area, earthquake_count,
       avg(earthquake_count) OVER (PARTITION BY date, area) AS average_earthquakes_same_day_same_region
FROM (
  SELECT {UPDATED_DAY}, area, count(*) AS earthquake_count FROM feature GROUP BY updated_day, area
)""",
    "top_area_last_week": f"""{FEATURE}
SELECT area, max(mag) AS highest_magnitude_last_week FROM feature
WHERE updated_day >= {WEEK_START}
GROUP BY area ORDER BY highest_magnitude_last_week DESC, area LIMIT 1""",
    "areas_above_5": f"{FEATURE} SELECT area, mag FROM feature WHERE mag > 5",
    "top5_frequency_intensity": f"""{FEATURE}
SELECT area, count(*) AS highest_frequency, max(mag) AS highest_intensity FROM feature
GROUP BY area ORDER BY highest_frequency DESC, highest_intensity DESC, area LIMIT 5""",
    "row_count": "SELECT 'silver' AS stage, count(*) AS records FROM events",
    "window_avg_partition": f"""{FEATURE}
SELECT date, area, earthquake_count,
       avg(earthquake_count) OVER (PARTITION BY date, area) AS partition_avg
FROM (
  SELECT {DAY.format("event_day")}, area, count(*) AS earthquake_count
  FROM feature GROUP BY event_day, area
)""",
    "top_1": f"""{FEATURE}
SELECT area, max(mag) AS highest_magnitude FROM feature
GROUP BY area ORDER BY highest_magnitude DESC, area LIMIT 1""",
    "top_5_two_keys": f"""{FEATURE}
SELECT {UPDATED_DAY}, count(*) AS frequency, max(mag) AS intensity FROM feature
GROUP BY updated_day ORDER BY frequency DESC, intensity DESC, updated_day LIMIT 5""",
    # audit
    "audit_frame": f"""
SELECT job_id, pipeline_name, function_name, '2024-01-30 12:00:00.000' AS start_time,
       '2024-01-30 12:00:00.000' AS end_time, status, error_msg, process_record
FROM ({audit_rows("flatten")})""",
    "audit_append": audit_rows("read", "flatten"),
    "audit_compaction": """
SELECT '101' AS job_id, 'DataPipeline' AS pipeline_name, event_type AS function_name, 'Success' AS status,
       CAST(NULL AS VARCHAR) AS error_msg, CAST(count(*) AS BIGINT) AS process_record, CAST(1 AS BIGINT) AS files
FROM events GROUP BY event_type""",
    "audited_stage": two_stages("CAST(NULL AS VARCHAR)", "'refused'"),
    "stage_row_counts": f"""
WITH document AS ({DOCUMENTS})
SELECT function_name, 'Success' AS status, CAST(n AS BIGINT) AS process_record
FROM ({_STAGE_COUNTS})""",
    "audit_write_retry": two_stages(f"'{_RETRY_NOTE}'", f"'refused; {_RETRY_NOTE}'"),
    "audit_failure_cascade": f"""
WITH document AS ({DOCUMENTS})
SELECT status, function_name, CAST(1 AS BIGINT) AS stages,
       CAST(CASE status WHEN 'Success' THEN n ELSE 0 END AS BIGINT) AS records
FROM ({_STAGE_COUNTS}) CROSS JOIN (SELECT unnest(['Success', 'Failed']) AS status)""",
    "audit_types": """
SELECT 'string' AS job_id_type, '101' AS job_id, true AS whole_seconds, true AS in_order,
       CAST(count(*) AS BIGINT) AS process_record
FROM events
UNION ALL SELECT 'string', '101', true, true, CAST(0 AS BIGINT)""",
    # jobs
    "job_historical": NULLABLE_ROWS,
    "job_daily": NULLABLE_ROWS,
    "job_canonical": GOLD_ROWS,
    "job_canonical_by_feature": f"{ROUGH} SELECT {rough_columns()} FROM kept",
    "job_canonical_historical": f"""
SELECT * REPLACE (CAST(NULL AS VARCHAR) AS place) FROM ({GOLD_ROWS})""",
    "job_audited": f"SELECT {nullable_columns(nulls=('geometry_type',))} FROM events",
    "job_append_functions": f"{NULLABLE_ROWS} UNION ALL {NULLABLE_ROWS}",
}


def _report() -> str:
    """All answers below each other, from the SQL of the single questions."""
    layout = {
        "count_by_area": ("NULL", "area", "earthquake_count_by_region", "NULL"),
        "avg_mag_by_area": ("NULL", "area", "avg_mag", "NULL"),
        "count_by_day": ("date", "NULL", "num_of_eq", "NULL"),
        "count_by_day_area": ("date", "area", "num_of_eq", "NULL"),
        "avg_daily_count": ("NULL", "NULL", "average_earthquakes_same_day", "NULL"),
        "avg_count_day_area": (
            "date", "area", "earthquake_count", "average_earthquakes_same_day_same_region",
        ),
        "top_area_last_week": ("NULL", "area", "highest_magnitude_last_week", "NULL"),
        "areas_above_5": ("NULL", "area", "mag", "NULL"),
        "top5_frequency_intensity": ("NULL", "area", "highest_frequency", "highest_intensity"),
    }
    parts = []
    for question, (date, area, first, second) in layout.items():
        parts.append(
            f"SELECT '{question}' AS question, CAST({date} AS VARCHAR) AS date, "
            f"CAST({area} AS VARCHAR) AS area, round(CAST({first} AS DOUBLE), 4) AS first_number, "
            f"round(CAST({second} AS DOUBLE), 4) AS second_number FROM ({ORACLES[question]})"
        )
    return " UNION ALL ".join(parts)


ORACLES["job_report"] = ORACLES["job_report_incremental"] = _report()
