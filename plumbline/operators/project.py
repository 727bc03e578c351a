"""Template projection: source rows to typed template rows, then union and name fill."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.casting import blank_to_null, cast_can_fail, default_literal, safe_cast, typed_null
from plumbline.functions.text import quoted, sql_name, sql_text

INVALID_FIELDS = "_invalid_type_fields"


def check_template(core_fields: Sequence[str], characteristics: Sequence[Mapping]) -> None:
    """Every characteristic has a code, and no output column would appear twice (ignoring letter case)."""
    seen = {name.lower() for name in core_fields}
    for characteristic in characteristics:
        code = characteristic.get("code")
        if not code:
            raise ValueError(f"a characteristic needs a code: {characteristic}")
        if code.lower() in seen:
            raise ValueError(f"Characteristic code is used twice or is a core field: {code}")
        seen.add(code.lower())


def _free_names(start: str, taken: Sequence[str]) -> str:
    """A beginning for working columns that no given column has."""
    while any(name.lower().startswith(start) for name in taken):
        start = "_" + start
    return start


def project_to_template(
    df: DataFrame,
    core_fields: Sequence[str],
    characteristics: Sequence[Mapping],
    mapping: Mapping[str, Mapping],
    core_types: Mapping[str, T.DataType] | None = None,
) -> DataFrame:
    """Core fields as they are, a typed column per characteristic, and the codes that did not cast.

    ``mapping`` gives per characteristic code the source field and default value. A core field the source lacks becomes
    NULL (text, unless ``core_types`` names another type).

    The select is in three steps, so that what several columns need is computed once a row however wide the template is: each source
    field without blanks, each cast of it, and the columns with defaults and the list of codes. No step shuffles, and the
    optimizer merges those that repeat nothing.
    """
    check_template(core_fields, characteristics)
    sources = {field.name: field.dataType for field in df.schema.fields}
    core_types = core_types or {}
    core = {
        name: sql_name(name) if name in sources
        else f"CAST(NULL AS {core_types.get(name, T.StringType()).simpleString()})"
        for name in core_fields
    }
    start = _free_names("_of_source_", core_fields)
    shown: dict[str, str] = {}  # source field: its working column without blanks
    casts: dict[tuple[str, str], str] = {}  # source field and type: the working column of the cast
    columns, offences = [], []
    for characteristic in characteristics:
        code, type_name, mapped = characteristic["code"], characteristic.get("type"), mapping.get(characteristic["code"])
        if not mapped:
            columns.append(f"{typed_null(type_name)} AS {sql_name(code)}")
            continue
        default, field = default_literal(mapped.get("default_value"), type_name), mapped.get("field")
        if field not in sources:
            columns.append(f"{default} AS {sql_name(code)}")
            continue
        source = shown.setdefault(field, f"{start}{len(shown)}")
        cast = casts.setdefault((field, type_name.lower()), f"{start}cast_{len(casts)}")
        value = cast if mapped.get("default_value") is None else f"CASE WHEN {source} IS NULL THEN {default} ELSE {cast} END"
        columns.append(f"{value} AS {sql_name(code)}")
        if cast_can_fail(sources[field], type_name):
            offences.append(f"CASE WHEN {source} IS NOT NULL AND {cast} IS NULL THEN {sql_text(code)} ELSE '' END")
    # No code is empty. Unlike array_compact, array_remove is compiled, and with it the tests.
    invalid = f"array_remove(CAST(array({', '.join(offences)}) AS array<string>), '') AS {INVALID_FIELDS}"
    whole = [f"{value} AS {sql_name(name)}" for name, value in core.items()]
    present = df.selectExpr(*whole, *[f"{blank_to_null(sql_name(f), sources[f])} AS {name}" for f, name in shown.items()])
    typed = present.selectExpr("*", *[f"{safe_cast(shown[f], sources[f], kind)} AS {name}" for (f, kind), name in casts.items()])
    return typed.selectExpr(*[sql_name(name) for name in core_fields], *columns, invalid)


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by name, duplicates kept; every table must have the same set of column names.

    Columns whose types differ between the tables (an id that is a number here and text there) are widened to text.
    """
    if not tables:
        raise ValueError("nothing to unify")
    names = tables[0].columns
    for table in tables[1:]:
        if set(table.columns) != set(names):
            raise ValueError(f"Tables differ in columns: {sorted(set(table.columns) ^ set(names))}")
    mixed = {name for name in names if len({table.schema[name].dataType.simpleString() for table in tables}) > 1}
    aligned = [
        table.select(*[quoted(n).cast("string").alias(n) if n in mixed else sql_name(n) for n in names])
        for table in tables
    ]
    return reduce(DataFrame.unionByName, aligned)


def fill_name(df: DataFrame, id_column: str = "id", name_column: str = "name") -> DataFrame:
    """Missing or blank names take the id's text; the column is added if the frame has none."""
    id_text, name = (f"CAST({sql_name(c)} AS string)" for c in (id_column, name_column))
    if name_column not in df.columns:
        return df.withColumn(name_column, F.expr(id_text))
    return df.withColumn(name_column, F.expr(f"CASE WHEN trim({name}) <> '' THEN {name} ELSE {id_text} END"))
