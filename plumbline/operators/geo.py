"""Geometry columns of whole frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.geometry import is_geometry, promote
from plumbline.functions.text import quoted
from plumbline.functions.wkb import from_wkb, to_wkb


def hex_bytes(column: str):
    """Bytes of hex text; text that is none gives its own bytes, which no reader takes for a geometry."""
    return F.coalesce(F.unhex(quoted(column)), F.encode(quoted(column), "utf-8"))


def decode_geometry(df: DataFrame, column: str) -> DataFrame:
    """WKB bytes, or their hex text, to the in-flight struct; other types and a missing column are left alone.

    What cannot be read, text that is no hex included, becomes an unreadable geometry, which validation rejects as invalid.
    """
    if column not in df.columns:
        return df
    data_type = df.schema[column].dataType
    if isinstance(data_type, T.BinaryType):
        return df.withColumn(column, from_wkb(quoted(column), lenient=True))
    if isinstance(data_type, T.StringType):
        return df.withColumn(column, from_wkb(hex_bytes(column), lenient=True))
    return df


def geometry_bytes(df: DataFrame, column: str) -> DataFrame:
    """The geometry column as WKB bytes for storage, marked in the column metadata. Hex text is only unhexed."""
    if column not in df.columns:
        return df
    data_type = df.schema[column].dataType
    value = quoted(column)
    if is_geometry(data_type):
        value = to_wkb(value)
    elif isinstance(data_type, T.StringType):
        value = hex_bytes(column)
    elif not isinstance(data_type, T.BinaryType):
        return df
    return df.withColumn(column, value).withMetadata(column, {"geometry": "wkb"})


def promote_geometry(df: DataFrame, expected_type: str | None, column: str) -> DataFrame:
    """Single-part geometries to the multi-part type the template expects, if they match it."""
    if column not in df.columns or not expected_type or not is_geometry(df.schema[column].dataType):
        return df
    return df.withColumn(column, promote(quoted(column), expected_type))
