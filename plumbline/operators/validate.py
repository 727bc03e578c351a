"""Row classification: every row is either valid or carries exactly one reject reason.

The rules apply in order (type, mandatory, duplicate id, geometry), each to the rows that passed the ones before. They
are folded into a single ``reject`` column, so the wide rows are read once; only ids travel for the duplicate rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.geometry import is_geometry, is_polygonal, structurally_valid
from plumbline.functions.text import quoted, sql_name, sql_text
from plumbline.functions.topology import topologically_valid
from plumbline.operators.geo import decode_geometry
from plumbline.operators.project import INVALID_FIELDS
from plumbline.operators.skew import MAX_BROADCAST_BYTES, mark_members

# Reject codes and messages.
INVALID_TYPE = "invalid_type"
REQUIRED_FIELD_MISSING = "required_field_missing"
DUPLICATED_ID = "duplicated_id"
INVALID_GEOMETRY = "invalid_geometry"
MESSAGES = {
    INVALID_TYPE: "One or more fields contain values with an invalid type.",
    REQUIRED_FIELD_MISSING: "One or more mandatory fields contain null values.",
    DUPLICATED_ID: "Duplicated ID found.",
    INVALID_GEOMETRY: "Geometry is invalid.",
}


@dataclass(frozen=True)
class Rules:
    """Columns the rules look at. An empty list of mandatory fields switches that rule off."""

    core_fields: Sequence[str] = ("id", "name", "geom")
    mandatory: Sequence[str] = ("id", "name")
    id_column: str = "id"
    geometry_column: str = "geom"


def check_structure(df: DataFrame, rules: Rules) -> None:
    """All columns the rules need must be there (exact names)."""
    needed = {*rules.core_fields, *rules.mandatory, rules.id_column, rules.geometry_column}
    missing = sorted(needed - set(df.columns))
    if missing:
        raise ValueError(f"the rows lack {missing}, which the rules look at")


def reject(code: str, field: str) -> str:
    """SQL of the struct<code, message, field> of one reason."""
    return f"named_struct('code', '{code}', 'message', {sql_text(MESSAGES[code])}, 'field', {field})"


def has_invalid_types() -> str:
    return f"size({INVALID_FIELDS}) > 0"


def invalid_fields() -> str:
    """SQL of the codes that did not cast, joined with commas."""
    return f"concat_ws(',', {INVALID_FIELDS})"


def any_null(fields: Sequence[str]) -> str:
    return " OR ".join(f"{sql_name(f)} IS NULL" for f in fields) or "false"


def null_fields(fields: Sequence[str]) -> str:
    """SQL of the names of the listed fields that are NULL in the row, joined with commas."""
    names = [f"CASE WHEN {sql_name(f)} IS NULL THEN {sql_text(f)} END" for f in fields]
    return f"concat_ws(',', {', '.join(names or ['NULL'])})"


def duplicate_keys(df: DataFrame, id_column: str) -> DataFrame:
    """Ids that occur more than once, with their row counts ``n``; a NULL id is never a duplicate.

    Counts are combined before the shuffle, so an id that owns a third of the rows costs one record per task.
    """
    counts = df.filter(quoted(id_column).isNotNull()).groupBy(id_column).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter("n > 1")


def mark_duplicates(
    df: DataFrame, id_column: str, eligible: Column | None = None, flag: str = "is_duplicate",
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Flag all rows of ids that occur more than once among the eligible rows."""
    eligible = F.lit(True) if eligible is None else eligible
    keys = duplicate_keys(df.filter(eligible), id_column)
    return mark_members(df, keys, id_column, eligible, flag, max_bytes)


def geometry_verdict(df: DataFrame, column: str, skip: Column, flag: str = "_bad_geometry") -> DataFrame:
    """Flag geometries that break the OGC rules; NULL is fine, skipped rows are not judged.

    Only polygonal geometries that pass the structural rules go to the topology function.
    """
    geometry = sql_name(column)
    checked = df.withColumns({"_skip": F.coalesce(skip, F.lit(False)), "_sound": structurally_valid(geometry)})
    to_check = F.expr(f"CASE WHEN NOT _skip AND _sound AND {is_polygonal(geometry)} THEN {geometry} END")
    checked = checked.withColumn("_topology", topologically_valid(to_check))
    bad = F.expr("coalesce(NOT _skip AND NOT (_sound AND coalesce(_topology, true)), false)")
    return checked.withColumn(flag, bad).drop("_skip", "_sound", "_topology")


def classify(df: DataFrame, rules: Rules, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Add ``reject`` (NULL for valid rows) and drop the internal invalid-field column."""
    check_structure(df, rules)
    columns = [c for c in df.columns if c != INVALID_FIELDS]
    df = decode_geometry(df, rules.geometry_column)
    wrong_type = has_invalid_types() if INVALID_FIELDS in df.columns else "false"
    field = invalid_fields() if INVALID_FIELDS in df.columns else "''"
    missing = any_null(rules.mandatory)
    early = F.expr(f"{wrong_type} OR {missing}")
    marked = mark_duplicates(df, rules.id_column, ~early, "_duplicate", max_bytes)
    if is_geometry(marked.schema[rules.geometry_column].dataType):
        marked = geometry_verdict(marked, rules.geometry_column, early | F.col("_duplicate"))
    else:
        marked = marked.withColumn("_bad_geometry", F.lit(False))
    reason = F.expr(f"""CASE
        WHEN {wrong_type} THEN {reject(INVALID_TYPE, field)}
        WHEN {missing} THEN {reject(REQUIRED_FIELD_MISSING, null_fields(rules.mandatory))}
        WHEN _duplicate THEN {reject(DUPLICATED_ID, sql_text(rules.id_column))}
        WHEN _bad_geometry THEN {reject(INVALID_GEOMETRY, sql_text(rules.geometry_column))} END""")
    return marked.select(*[sql_name(c) for c in columns], reason.alias("reject"))


def split(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) frames of a classified one; the rejected one keeps its ``reject`` column."""
    valid = classified.filter(F.col("reject").isNull()).drop("reject")
    return valid, classified.filter(F.col("reject").isNotNull())
