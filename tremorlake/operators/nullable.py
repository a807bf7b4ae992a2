"""The nullable semantics: short names, missing values stay null."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorlake.functions.scalars import area_regex, epoch_ms_to_timestamp, load_clock
from tremorlake.schemas import COORDINATES, PROPERTIES


def explode_features(documents: DataFrame) -> DataFrame:
    """One row per feature; a document without features gives none."""
    return documents.select(F.explode("features").alias("feature"))


def property_columns(feature: str = "feature") -> list[Column]:
    """Every declared property as a typed top-level column."""
    return [
        F.expr(f"try_cast({feature}.properties.{f.name} AS {f.dataType.simpleString()}) AS {f.name}")
        for f in PROPERTIES.fields
    ]


def coordinate_columns(coordinates: Column | str) -> list[Column]:
    """Longitude, latitude and depth; null where the array is too short."""
    return [F.get(coordinates, F.lit(i)).alias(name) for i, name in enumerate(COORDINATES)]


def split_coordinates(df: DataFrame, column: str = "coordinates") -> DataFrame:
    """Replace the coordinate array by its three columns."""
    return df.select("*", *coordinate_columns(column)).drop(column)


def flatten(documents: DataFrame) -> DataFrame:
    """Documents to one flat row per feature: 25 properties, geometry type, position."""
    flat = explode_features(documents).select(
        *property_columns(),
        F.col("feature.geometry.type").alias("geometry_type"),
        F.col("feature.geometry.coordinates").alias("coordinates"),
    )
    return split_coordinates(flat)


def flatten_audited(documents: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """As `flatten`, but with the feature id and the read clock, without geometry type."""
    return explode_features(documents).select(
        *property_columns(),
        *coordinate_columns("feature.geometry.coordinates"),
        F.col("feature.id").alias("id"),
        load_clock(as_of).alias("ingestion_timestamp"),
    )


def transform_columns(flat: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Both epochs to timestamps, the area out of the place, and the load clock."""
    return flat.withColumns(
        {
            "time": epoch_ms_to_timestamp("time"),
            "updated": epoch_ms_to_timestamp("updated"),
            "area": area_regex("place"),
            "insert_dt": load_clock(as_of),
        }
    )
