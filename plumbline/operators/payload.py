"""Nested asset payloads, built as columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.geometry import COLLECTION, geojson, is_geometry
from plumbline.functions.text import characteristic_name, double_text, is_usable, quoted, sql_name, timestamp_text
from plumbline.operators.lookup import attach_signals, masterdata_ids
from plumbline.operators.skew import MAX_BROADCAST_BYTES

HIDDEN_TYPE = "iotsynoptic"  # fixed value: characteristics of this type never reach a payload
HASH_CODE = "XV_hash_code"  # fixed value: the characteristic that names a payload if it is filled


@dataclass(frozen=True)
class Template:
    """A template and its characteristics (``code``, ``name``, ``type``; type names in lower case)."""

    id: int
    code: str
    geometry_type: str | None = None
    is_enabled: bool = True
    is_deleted: bool = False
    characteristics: Sequence[Mapping] = field(default_factory=tuple)


@dataclass(frozen=True)
class PayloadSettings:
    name_prefix: str = ""
    code_reference_prefix: str = ""
    origin_id: int = 1
    consumer_application_id: int = 1
    main_hierarchy_parent: int = 0
    batch_size: int = 100
    hash_code: str = HASH_CODE


def payload_characteristics(characteristics: Sequence[Mapping]) -> list[dict]:
    """Characteristics that go into payloads, type names in lower case."""
    lowered = [{**c, "type": (c.get("type") or "").lower() or None} for c in characteristics]
    return [c for c in lowered if c["type"] != HIDDEN_TYPE]


def default_value(type_name: str | None) -> Column:
    """Value of a characteristic the row has no column for."""
    if type_name == "double":
        return F.lit(0.0)
    if type_name == "integer":
        return F.lit(0)
    if type_name in ("maindata", "date"):
        return F.lit(None).cast("string")
    return F.lit("")


def formatted_value(type_name: str, name: str, data_type: T.DataType) -> tuple[Column, Column | None]:
    """(payload value, whether the row's value cannot be formatted) of a column by its characteristic type."""
    value = quoted(name)
    if type_name == "double":
        floating = isinstance(data_type, T.FractionalType) and not isinstance(data_type, T.DecimalType)
        text = F.expr(double_text(sql_name(name))) if floating else value.cast("string")
        return F.when(is_usable(value, floating), text).otherwise(F.lit("0.0")), None
    if type_name == "integer":
        if isinstance(data_type, T.IntegralType):
            return F.coalesce(value.cast("string"), F.lit("0")), None
        floating = isinstance(data_type, (T.FloatType, T.DoubleType))
        if isinstance(data_type, T.StringType):
            whole = F.when(value.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(value).try_cast("decimal(38,0)"))
        elif isinstance(data_type, T.NumericType):
            whole = value.try_cast("bigint")
        else:
            whole = F.lit(None).cast("bigint")
        usable = is_usable(value, floating)
        return F.when(usable, whole.cast("string")).otherwise(F.lit("0")), usable & whole.isNull()
    if type_name == "date":
        if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
            return timestamp_text(value), None
        if isinstance(data_type, (T.DateType, T.NullType)):
            return value.cast("string"), None
        return F.lit(None).cast("string"), value.isNotNull()
    return value, None


def _characteristics(df, characteristics, ids, has_signals):
    """Array of struct<name, value, code, type>, the value column per code, and the problem texts."""
    entries, values, problems = [], {}, []
    for c in characteristics:
        code, type_name = c["code"], c["type"]
        problem = None
        if type_name == "iotsignal" and has_signals:
            value = F.to_variant_object("signals")
        elif code in ids:
            value = F.col(ids[code])
        elif code in df.columns and type_name != "iotsignal":
            value, problem = formatted_value(type_name, code, df.schema[code].dataType)
        else:
            value = default_value(type_name)
        if problem is not None:
            problems.append(F.when(problem, F.lit(f"Value of {code} is no {type_name}")))
        values[code] = value
        entries.append(F.struct(
            characteristic_name(F.lit(c.get("name")).cast("string")).alias("name"), value.cast("variant").alias("value"),
            F.lit(code).alias("code"), F.lit(type_name).alias("type"),
        ))
    return F.array(*entries), values, problems


def code_reference(hash_value: Column | None, id_value: Column, prefix: str) -> Column:
    """Prefix and the hash code; a missing or blank hash code gives way to the id."""
    id_text = F.coalesce(id_value.cast("string"), F.lit("None"))
    if hash_value is None:
        return F.concat(F.lit(prefix), id_text)
    text = hash_value.cast("string")
    return F.concat(F.lit(prefix), F.when(F.trim(text) != "", text).otherwise(id_text))


def with_lookups(
    df: DataFrame, characteristics: Sequence[Mapping], id_column: str, masterdata: DataFrame | None,
    tags: DataFrame | None, max_bytes: int,
) -> tuple[DataFrame, dict[str, str]]:
    """Join what the characteristics look up; returns the frame and the id column per master-data code."""
    ids = {}
    coded = [c["code"] for c in characteristics if c["type"] == "maindata" and c["code"] in df.columns]
    if coded and masterdata is not None:
        ids = {code: f"_masterdata_{number}" for number, code in enumerate(coded)}
        df = masterdata_ids(df, ids, masterdata, max_bytes)
    elif coded:
        df = df.withColumns({f"_masterdata_{n}": F.lit(None).cast("bigint") for n, _ in enumerate(coded)})
        ids = {code: f"_masterdata_{n}" for n, code in enumerate(coded)}
    if any(c["type"] == "iotsignal" for c in characteristics):
        if tags is not None:
            return attach_signals(df, tags, id_column, max_bytes), ids
        none = F.array().cast("array<struct<uid:string,type:string,name:string>>")
        df = df.withColumn("signals", none)
    return df, ids


def build_payloads(
    df: DataFrame,
    template: Template,
    settings: PayloadSettings,
    masterdata: DataFrame | None = None,
    tags: DataFrame | None = None,
    id_column: str = "id",
    geometry_column: str = "geom",
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """The standard rows with their ``payload`` struct and ``reject`` (NULL if the payload could be built).

    ``masterdata`` has columns key, value, id; ``tags`` has name, uid, pos.
    """
    columns = df.columns
    characteristics = payload_characteristics(template.characteristics)
    joined, ids = with_lookups(df, characteristics, id_column, masterdata, tags, max_bytes)
    has_signals = "signals" in joined.columns
    items, values, problems = _characteristics(joined, characteristics, ids, has_signals)

    hash_value = values.get(settings.hash_code)
    shape = F.lit(None).cast("struct<type:string,coordinates:variant>")
    if geometry_column in columns and is_geometry(df.schema[geometry_column].dataType):
        shape = geojson(sql_name(geometry_column))
        is_collection = quoted(geometry_column)["type"] == COLLECTION
        problems.append(F.when(is_collection, F.lit("A geometry collection has no coordinates")))
    payload = F.struct(
        F.lit(int(template.id)).alias("templateId"),
        F.lit(template.code).alias("templateCode"),
        items.alias("characteristics"),
        F.concat(F.lit(settings.name_prefix), F.coalesce(quoted("name").cast("string"), F.lit("None"))).alias("name"),
        F.lit(bool(template.is_enabled)).alias("isEnabled"),
        F.lit(bool(template.is_deleted)).alias("isDeleted"),
        F.lit(settings.origin_id).alias("originId"),
        shape.alias("geometry"),
        F.array(F.struct(
            quoted("id").alias("externalId"), F.lit(settings.consumer_application_id).alias("consumerapplicationId")
        )).alias("externalObjects"),
        F.lit(settings.main_hierarchy_parent).alias("mainHierarchyParent"),
        code_reference(hash_value, quoted("id"), settings.code_reference_prefix).alias("codeReference"),
    )
    problem = F.array_compact(F.array(*problems)) if problems else F.array().cast("array<string>")
    reason = F.when(F.size(problem) > 0, F.struct(
        F.lit("invalid_type").alias("code"), F.get(problem, 0).alias("message"),
        F.lit(None).cast("string").alias("field"),
    ))
    return joined.select(*[quoted(c) for c in columns], payload.alias("payload"), reason.alias("reject"))


def payload_json(payload: Column) -> Column:
    """Payload as JSON text, NULL fields kept."""
    return F.to_json(payload, {"ignoreNullFields": "false"})
