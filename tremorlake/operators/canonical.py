"""The canonical semantics: long names, missing values take defaults.

Input is a frame of bronze lines (column `value`); everything up to the flat
row happens in the task that reads the line, without a shuffle.

A line is read twice at most. The first read is a typed JSON parse, quick and
right for every document whose leaves have their declared types. It notes
documents with anything odd: a leaf of another type, a null that may be an
error, text that is no JSON. Only those are read again as a variant, which
remembers what each leaf was and so can follow the rules to the letter.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
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
)

from tremorlake.functions import variants as V
from tremorlake.functions.scalars import area_split, epoch_ms_to_iso, record_clock_iso
from tremorlake.operators.shape import conform_schema
from tremorlake.schemas import (
    CANONICAL_GOLD,
    CANONICAL_SILVER,
    CANONICAL_SOURCES,
    COORDINATES,
    EPOCH_COLUMNS,
    without,
)
from tremorlake.sources import commits
from tremorlake.sources.layers import DOCUMENT_KIND, FEATURE_KIND, ROW_KIND

SILVER_TAG = "silver"
WAREHOUSE_TAG = "bq"


# So many cuts, of two numbers each, are broadcast; about 10 MB.
CUT_ROWS = 250_000
# Ordinals of a block, if there are more.
CUT_BLOCK = 1024

_MISTYPED = "mistyped"
# NaN and Infinity are no JSON. The typed read refuses them as the exact one does,
# so a document with one is rejected whatever its other leaves are.
_JSON_OPTIONS = {
    "columnNameOfCorruptRecord": _MISTYPED,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}
_LISTED = "array<struct<features: array<variant>>>"
_STRICT = "map('allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"


def _read_type(field: StructField) -> DataType:
    """The type a property is read as. Numbers are narrowed last."""
    if isinstance(field.dataType, FloatType):
        return DoubleType()
    if isinstance(field.dataType, IntegerType) or field.name in EPOCH_COLUMNS:
        return LongType()
    return field.dataType


def _sources(wanted: type) -> list[str]:
    """Properties read as the given type."""
    return [f.name for f in _PROPERTIES.fields if isinstance(f.dataType, wanted)]


_PROPERTIES = StructType(
    [
        StructField(CANONICAL_SOURCES[f.name], _read_type(f))
        for f in CANONICAL_SILVER.fields
        if f.name in CANONICAL_SOURCES
    ]
)
_EPOCHS = [CANONICAL_SOURCES[name] for name in EPOCH_COLUMNS]
_INTS = [name for name in _sources(LongType) if name not in _EPOCHS]
_TEXTS = [name for name in _sources(StringType) if name != "place"]

_POSITION = ArrayType(DoubleType())
_FEATURE = (
    StructType()
    .add("properties", _PROPERTIES)
    .add("geometry", StructType().add("coordinates", _POSITION))
)
_TYPED = (
    StructType()
    .add("documents", ArrayType(StructType().add("features", ArrayType(_FEATURE))))
    .add(_MISTYPED, StringType())
)


# --- documents -----------------------------------------------------------------


def parse_documents(lines: DataFrame) -> DataFrame:
    """Add `features`, a list of variants; null if the line has none or is no JSON.

    Each feature is a variant of its own, so a document can be of any length and
    the rule is the same for all. The line is parsed as the only element of a JSON
    array. That way text after the document makes the line invalid, which a parser
    that stops at the end of the first value would let pass.
    """
    parsed = f"from_json(concat('[', value, ']'), '{_LISTED}', {_STRICT})"
    listed = lines.selectExpr("*", f"{parsed} AS parsed")
    features = """CASE WHEN array_size(parsed) = 1 THEN transform(get(parsed, 0).features,
        feature -> coalesce(feature, parse_json('null'))) END"""
    return listed.selectExpr("*", f"{features} AS features").drop("parsed")


def accepted_documents(lines: DataFrame) -> DataFrame:
    """Documents with a feature list; the other lines are dropped."""
    return parse_documents(lines).filter("features IS NOT NULL")


def rejected_documents(lines: DataFrame) -> DataFrame:
    """The lines `accepted_documents` drops, for a quarantine table."""
    return parse_documents(lines).filter("features IS NULL").select("value")


# --- bad features ----------------------------------------------------------------


def _not_an_object(feature: str, path: str, child: str) -> str:
    """The value at the path is there but no object.

    A child that is there proves an object, so the type is only worked out for
    the rare value without one.
    """
    present = f"{V.leaf(feature, path)} IS NOT NULL"
    return f"({child} IS NULL AND {present} AND {V.kind(feature, path)} NOT LIKE 'OBJECT%')"


def is_bad_feature(feature: str) -> str:
    """A feature (a variant) that cannot be turned into a row, as SQL text.

    Absent keys are fine and take defaults. Bad are: a feature, properties or
    geometry that is no object; a place that is no text; coordinates that are
    null or fewer than three; an epoch no calendar time can show; an integer
    field with an infinite number.
    """
    place, coordinates = "$.properties.place", "$.geometry.coordinates"
    part = f"coalesce({V.leaf(feature, '$.properties')}, {V.leaf(feature, '$.geometry')})"
    too_short = f"{V.leaf(feature, coordinates + '[2]')} IS NULL"
    checks = [
        _not_an_object(feature, "$", part),
        _not_an_object(feature, "$.properties", V.leaf(feature, place)),
        f"{V.kind(feature, place)} <> 'STRING'",
        _not_an_object(feature, "$.geometry", V.leaf(feature, coordinates)),
        f"{V.leaf(feature, coordinates)} IS NOT NULL AND {too_short}",
        *(V.epoch_out_of_range(feature, f"$.properties.{name}") for name in _EPOCHS),
        *(V.is_infinite(feature, f"$.properties.{name}") for name in _INTS),
    ]
    return V.any_of(checks)


def keep_good_features(documents: DataFrame, on_error: str = "truncate") -> DataFrame:
    """Apply the error rule to the variants in `features`.

    `truncate` ends a document at its first bad feature, so that one and all
    later ones are lost. `skip` drops the bad features alone.
    """
    bad = is_bad_feature("feature")
    others = [name for name in documents.columns if name != "features"]
    if on_error == "skip":
        kept = f"filter(features, feature -> NOT ({bad}))"
        return documents.selectExpr(*others, f"{kept} AS features")
    if on_error != "truncate":
        raise ValueError(f"on_error must be 'truncate' or 'skip', not {on_error!r}")
    first_bad = f"array_position(transform(features, feature -> {bad}), true)"
    located = documents.selectExpr("*", f"CAST({first_bad} AS int) AS first_bad")
    kept = "CASE WHEN first_bad > 0 THEN slice(features, 1, first_bad - 1) ELSE features END"
    return located.selectExpr(*others, f"{kept} AS features")


# --- reading features --------------------------------------------------------------

# Texts a place that is no text can show as.
_NUMBER_OR_BOOLEAN = "^(?:[-+.0-9eE]+|Infinity|-Infinity|NaN|true|false)$"
_CONTAINER_START = "'[', '{'"


def _needs_second_look(features: str) -> str:
    """Whether a typed feature list cannot be trusted as it is, as SQL text.

    Its nulls may stand for null or absent, and its texts for text or another
    value. Wherever the rules tell these apart, the list needs a second look.
    Most checks run over one property of all features at once.
    """
    place = "feature.properties.place"
    lacks_parts = f"""{place} IS NULL
        OR {place} RLIKE '{_NUMBER_OR_BOOLEAN}' OR left({place}, 1) IN ({_CONTAINER_START})
        OR coalesce(array_size(feature.geometry.coordinates), 0) < {len(COORDINATES)}"""
    checks = [f"exists({features}, feature -> {lacks_parts})"]
    for name in _EPOCHS:
        epochs = f"{features}.properties.{name}"
        checks += [
            f"array_contains({epochs}, 0L)",
            f"NOT {V.in_calendar(f'array_min({epochs})')}",
            f"NOT {V.in_calendar(f'array_max({epochs})')}",
        ]
    checks += [
        f"arrays_overlap({features}.properties.{name}, array({V.FALSY_LIST}))" for name in _TEXTS
    ]
    return V.any_of(checks)


def _exact_property(name: str) -> str:
    """A typed property of a variant, by the rules of its kind.

    An epoch that is falsy becomes null, one that is no integer zero; a falsy
    text becomes empty.
    """
    value, path = f"seen.properties.{name}", f"$.properties.{name}"
    if name in _EPOCHS:
        return V.exact_epoch(value, "seen.feature", path)
    if name in _TEXTS:
        return V.falsy_to_empty(value, "seen.feature", path)
    return value


def _exact_features(features: str) -> str:
    """Typed features out of variants."""
    properties = V.get("feature", "$.properties", _PROPERTIES.simpleString())
    seen = f"transform({features}, feature -> struct(feature, {properties} AS properties))"
    exact = ", ".join(f"{_exact_property(name)} AS {name}" for name in _PROPERTIES.fieldNames())
    position = V.get("seen.feature", "$.geometry.coordinates", _POSITION.simpleString())
    return f"""transform({seen}, seen -> struct(
        struct({exact}) AS properties, struct({position} AS coordinates) AS geometry))"""


def _screened(lines: DataFrame) -> DataFrame:
    """Read lines by type: `typed` features, and whether a line is `odd`."""
    wrapped = F.concat(F.lit('{"documents":['), F.col("value"), F.lit("]}"))
    parsed = lines.select("value", F.from_json(wrapped, _TYPED, _JSON_OPTIONS).alias("parsed"))
    listed = parsed.selectExpr(
        "value",
        "CASE WHEN array_size(parsed.documents) = 1 THEN parsed.documents[0].features END AS typed",
        f"parsed.{_MISTYPED} IS NOT NULL AS {_MISTYPED}",
    )
    odd = f"{_MISTYPED} OR {_needs_second_look('typed')}"
    return listed.selectExpr("value", "typed", f"{odd} AS odd")


def screen_documents(lines: DataFrame) -> DataFrame:
    """Lines read by type; `value` is kept for odd lines only."""
    return _screened(lines).selectExpr("CASE WHEN odd THEN value END AS value", "typed", "odd")


def tagged_input(lines: DataFrame, on_error: str = "truncate", spread: int | None = None) -> DataFrame:
    """All that a load makes of its lines, out of one look at each line.

    One row per good feature (`kind` is row, `feature` is typed), per document that is lost
    as a whole because it is no JSON or has no feature list (document, its text in `lost`),
    and per feature the error rule drops (feature, its text in `lost`).
    """
    looked = parse_documents(
        _screened(lines).selectExpr("CASE WHEN odd THEN value END AS value", "value AS line", "typed", "odd")
    )
    bad = is_bad_feature("feature")
    if on_error == "skip":
        kept, gone = f"filter(features, feature -> NOT ({bad}))", f"filter(features, feature -> {bad})"
    elif on_error == "truncate":
        first = f"CAST(array_position(transform(features, feature -> {bad}), true) AS int)"
        looked = looked.selectExpr("*", f"{first} AS first_bad")
        kept = "CASE WHEN first_bad > 0 THEN slice(features, 1, first_bad - 1) ELSE features END"
        gone = "CASE WHEN first_bad > 0 THEN slice(features, first_bad, array_size(features)) ELSE array() END"
    else:
        raise ValueError(f"on_error must be 'truncate' or 'skip', not {on_error!r}")
    parted = looked.selectExpr(
        "CASE WHEN odd THEN features IS NULL ELSE typed IS NULL END AS rejected",
        "line",
        "typed",
        "odd",
        f"CASE WHEN odd THEN {kept} END AS kept",
        f"CASE WHEN odd THEN {gone} END AS gone",
    )
    good = f"CASE WHEN odd THEN {_exact_features('kept')} ELSE typed END"
    items = f"""CASE WHEN rejected THEN array(named_struct('kind', '{DOCUMENT_KIND}', 'feature', CAST(NULL AS {_FEATURE.simpleString()}), 'lost', line))
        ELSE concat(
            transform({good}, feature -> named_struct('kind', '{ROW_KIND}', 'feature', feature, 'lost', CAST(NULL AS string))),
            transform(coalesce(gone, array()), feature -> named_struct(
                'kind', '{FEATURE_KIND}', 'feature', CAST(NULL AS {_FEATURE.simpleString()}), 'lost', to_json(feature)))) END"""
    rows = parted.select(F.explode_outer(F.expr(items)).alias("item")).filter("item IS NOT NULL").select("item.*")
    return rows.repartition(spread) if spread else rows


def lost_input(lines: DataFrame, on_error: str = "truncate") -> DataFrame:
    """What the error rule drops: `kind` (document or feature) and its text `value`."""
    lost = tagged_input(lines, on_error).filter(F.col("kind") != ROW_KIND)
    return lost.select("kind", F.col("lost").alias("value"))


def tagged_project(
    lines: DataFrame, on_error: str = "truncate", include_place: bool = True, spread: int | None = None
) -> DataFrame:
    """Canonical rows and what was lost on the way, told apart by `kind`.

    The columns of a row are null where something was lost, and `lost` is null in a row.
    """
    return _tagged_columns(tagged_input(lines, on_error, spread), include_place)


def _tagged_columns(tagged: DataFrame, include_place: bool) -> DataFrame:
    is_row = F.col("kind") == ROW_KIND
    columns = [F.when(is_row, canonical_column(field)).alias(field.name) for field in silver_schema(include_place).fields]
    return tagged.select("kind", *columns, "lost")


def canonical_features(lines: DataFrame, on_error: str = "truncate", spread: int | None = None) -> DataFrame:
    """Bronze lines to one column `feature`, one typed row per good feature.

    Lines without features leave a null row that is dropped after the explode.
    A plain explode would let the optimizer drop them up front, at the price of
    parsing every line again for that filter. `spread` deals the features over that
    many tasks, by one exchange; without it they stay with their document's task.
    """
    documents = keep_good_features(parse_documents(screen_documents(lines)), on_error)
    exact = _exact_features("features")
    features = documents.selectExpr(f"CASE WHEN odd THEN {exact} ELSE typed END AS features")
    rows = features.select(F.explode_outer("features").alias("feature"))
    rows = rows.filter("feature IS NOT NULL")
    return rows.repartition(spread) if spread else rows


# --- a document over many tasks ------------------------------------------------------


def land_features(lines: DataFrame, path: str) -> DataFrame:
    """Store the features of all documents, one a row, and read them back.

    `document` tells documents apart (also equal ones), `ordinal` is the place of a feature
    in its document from 0, `feature` its value. A line is read by one task here; from then
    on its features are rows like any others, in files that are split by size. A document
    that is no JSON or has no feature list is one row: its text in `lost`, the rest null.
    """
    numbered = parse_documents(lines).withColumn("document", F.monotonically_increasing_id())
    rejected = F.when(F.col("features").isNull(), F.col("value")).alias("lost")
    rows = numbered.select("document", rejected, F.posexplode_outer("features").alias("at", "feature"))
    rows = rows.filter("at IS NOT NULL OR lost IS NOT NULL")
    rows = rows.select("document", F.col("at").cast("long").alias("ordinal"), "feature", "lost")
    commits.write_complete(rows, path, lambda df, to: df.write.parquet(to))
    return lines.sparkSession.read.schema(rows.schema).parquet(path)


def first_bad_ordinals(landed: DataFrame) -> DataFrame:
    """`document`, `first_bad` and `last` ordinal of each document that has a bad feature.

    One exchange; before it every task has at most one row per document.
    """
    bad = F.when(F.expr(is_bad_feature("feature")), F.col("ordinal"))
    features = landed.filter("ordinal IS NOT NULL")
    found = features.groupBy("document").agg(F.min(bad).alias("first_bad"), F.max("ordinal").alias("last"))
    return found.filter("first_bad IS NOT NULL")


def with_cuts(landed: DataFrame, path: str) -> DataFrame:
    """The landed rows with `first_bad`, the first bad ordinal of their document, on all
    rows from there on; null on the rows before.

    The cuts are written to the path. Up to `CUT_ROWS` of them go to every task. More are
    joined by document and block of ordinals, and a document has a cut in each block from
    its first bad feature on; so the rows of one document stay spread over the tasks.
    """
    cuts = first_bad_ordinals(landed)
    n_cuts = commits.write_complete(cuts, path, lambda df, to: df.write.parquet(to))
    cuts = landed.sparkSession.read.schema(cuts.schema).parquet(path)
    if n_cuts <= CUT_ROWS:
        cuts = F.broadcast(cuts.select(F.col("document").alias("cut"), F.col("first_bad").alias("from_bad")))
        same = F.col("document") == F.col("cut")
    else:
        first, last = F.floor(F.col("first_bad") / CUT_BLOCK), F.floor(F.col("last") / CUT_BLOCK)
        block = F.explode(F.sequence(first, last)).alias("block")
        cuts = cuts.select(F.col("document").alias("cut"), F.col("first_bad").alias("from_bad"), block)
        same = (F.col("document") == F.col("cut")) & (F.floor(F.col("ordinal") / CUT_BLOCK) == F.col("block"))
    joined = landed.join(cuts, same, "left")
    reached = F.when(F.col("ordinal") >= F.col("from_bad"), F.col("from_bad"))
    return joined.select(*landed.columns, reached.alias("first_bad"))


def cut_features(landed: DataFrame, path: str) -> DataFrame:
    """The features before the first bad one of their document; the cuts go to the path."""
    kept = with_cuts(landed, path).filter("first_bad IS NULL AND ordinal IS NOT NULL")
    return kept.select("document", "ordinal", "feature")


def tagged_over_tasks(landed: DataFrame, path: str, include_place: bool = True) -> DataFrame:
    """As `tagged_project` under the truncate rule, with the features of a document on many tasks."""
    kind = f"""CASE WHEN ordinal IS NULL THEN '{DOCUMENT_KIND}'
        WHEN first_bad IS NULL THEN '{ROW_KIND}' ELSE '{FEATURE_KIND}' END"""
    exact = _exact_features("array(feature)")
    rows = with_cuts(landed, path).selectExpr(f"{kind} AS kind", "feature", "lost").selectExpr(
        "kind",
        f"CASE WHEN kind = '{ROW_KIND}' THEN get({exact}, 0) END AS typed",
        f"CASE WHEN kind = '{FEATURE_KIND}' THEN to_json(feature) ELSE lost END AS lost",
    )
    return _tagged_columns(rows.withColumnRenamed("typed", "feature"), include_place)


def project_features(features: DataFrame, include_place: bool = True) -> DataFrame:
    """Canonical rows of features that are rows of their own; all must be good ones."""
    exact = _exact_features("array(feature)")
    rows = features.select(F.expr(f"get({exact}, 0)").alias("feature"))
    return rows.select([canonical_column(field) for field in silver_schema(include_place).fields])


# --- rows ------------------------------------------------------------------------


def canonical_column(field: StructField) -> Column:
    """One named column of the canonical row, over the column `feature`."""
    name = field.name
    if name == "area":
        return area_split(F.expr("coalesce(feature.properties.place, '')")).alias(name)
    if name in EPOCH_COLUMNS:
        return epoch_ms_to_iso(f"feature.properties.{CANONICAL_SOURCES[name]}").alias(name)
    if name in COORDINATES:
        value = f"get(feature.geometry.coordinates, {COORDINATES.index(name)})"
    else:
        value = f"feature.properties.{CANONICAL_SOURCES[name]}"
    default = "''" if isinstance(field.dataType, StringType) else "0"
    return F.expr(f"{V.safe_cast(value, field.dataType, default)} AS {name}")


def silver_schema(include_place: bool = True) -> StructType:
    return CANONICAL_SILVER if include_place else without(CANONICAL_SILVER, "place")


def gold_schema(include_place: bool = True) -> StructType:
    return CANONICAL_GOLD if include_place else without(CANONICAL_GOLD, "place")


def canonical_project(
    lines: DataFrame, on_error: str = "truncate", include_place: bool = True, spread: int | None = None
) -> DataFrame:
    """Bronze lines to canonical silver rows."""
    fields = silver_schema(include_place).fields
    rows = canonical_features(lines, on_error, spread)
    return rows.select([canonical_column(field) for field in fields])


def gold_project(
    silver: DataFrame, as_of: dt.datetime | None = None, include_place: bool = True
) -> DataFrame:
    """Canonical silver to gold: wider numbers, real timestamps, the load clock."""
    stamped = silver.withColumn("insert_dt", record_clock_iso(as_of))
    return conform_schema(stamped, gold_schema(include_place))


def split_outputs(projected: DataFrame) -> dict[str, DataFrame]:
    """The tagged outputs of the projection. Every row carries the silver tag, so
    the warehouse tag is an empty frame of the same columns."""
    return {SILVER_TAG: projected, WAREHOUSE_TAG: projected.filter(F.lit(False))}
