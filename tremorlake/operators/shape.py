"""Projections that change the shape of a frame, driven by a schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


def cast_columns(df: DataFrame, types: Mapping[str, DataType | str]) -> DataFrame:
    """Cast columns in place; a value that does not convert becomes null."""
    return df.withColumns({name: F.col(name).try_cast(to) for name, to in types.items()})


def conform_schema(df: DataFrame, schema: StructType, extra: str = "drop") -> DataFrame:
    """Force names, order and types of a declared schema.

    A missing column becomes null. A column the schema does not know is
    dropped, or refused with `extra="error"`.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    unknown = sorted(set(present) - set(schema.fieldNames()))
    if extra == "error" and unknown:
        raise ValueError(f"columns not in the target schema: {', '.join(unknown)}")

    def target(name: str, to: DataType) -> str:
        if name not in present:
            return f"CAST(NULL AS {to.simpleString()}) AS `{name}`"
        if present[name] == to:
            return f"`{name}`"
        return f"try_cast(`{name}` AS {to.simpleString()}) AS `{name}`"

    return df.selectExpr(*(target(f.name, f.dataType) for f in schema.fields))
