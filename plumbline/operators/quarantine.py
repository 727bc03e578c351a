"""Quarantine records of rejected rows and of rejected batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.geometry import is_geometry, wkt
from plumbline.functions.text import quoted, sql_name, timestamp_text
from plumbline.operators.skew import MAX_BROADCAST_BYTES, measured_bytes, settled

# Stages, and the code of a payload the receiving side turned down.
STANDARDIZATION = "standardization"
SERIALIZATION = "serialization"
UPLOAD = "upload"
REJECTED_ASSET = "dmd_rejected_asset"

RECORD = T.StructType([
    T.StructField(name, T.TimestampType() if name == "failed_at" else T.StringType())
    for name in (
        "run_id", "environment", "template_code", "stage", "error_code", "error_message", "asset", "source_id",
        "code_reference", "field_name", "quarantine_id", "failed_at",
    )
])


def asset_json(df: DataFrame, columns: list[str]) -> Column:
    """The row as JSON text, NULL fields kept; geometries as well-known text and timestamps as plain text."""
    def shown(name):
        data_type = df.schema[name].dataType
        if is_geometry(data_type):
            return wkt(sql_name(name)).alias(name)
        if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
            return timestamp_text(quoted(name), " ").alias(name)
        return quoted(name)

    return F.to_json(F.struct(*[shown(c) for c in columns]), {"ignoreNullFields": "false"})


#: Equal records are numbered in stretches of so many, each stretch in a task of its own.
STRETCH = 10_000
#: What a record's id is derived from.
_CONTENT = [name for name in RECORD.names if name not in ("quarantine_id", "failed_at")]


def _records(rows: DataFrame, run_id, environment, template, stage, code, message, asset, source_id, code_reference, field, failed_at) -> DataFrame:
    values = {
        "run_id": F.lit(run_id), "environment": F.lit(environment), "template_code": F.lit(template), "stage": F.lit(stage),
        "error_code": code, "error_message": message, "asset": asset, "source_id": source_id, "code_reference": code_reference,
        "field_name": field,
    }
    told = rows.select(*[values[name].cast(RECORD[name].dataType).alias(name) for name in _CONTENT])
    return identified(told, F.current_timestamp() if failed_at is None else F.lit(failed_at).cast("timestamp"))


def _identity(occurrence: Column) -> Column:
    digest = F.sha2(F.concat(F.to_json(F.struct(*_CONTENT), {"ignoreNullFields": "false"}), F.lit("#"), occurrence.cast("string")), 256)
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def identified(told: DataFrame, failed_at: Column) -> DataFrame:
    """Records with an id that a repeated run gives again: a digest of all they tell, and of which of several equal records they are.

    The records are settled, as they are read up to three times and to find them costs more than to keep them. Equal records are rare, and only
    they have to be counted: a digest of each record is counted map-side, the digests that occur more than once are settled, and the other
    records get their id where they are. Equal records become one row and its number of repeats, which is then dealt
    out again in stretches.
    """
    told = settled(told.select(*_CONTENT, F.xxhash64(*_CONTENT).alias("_mark")))
    marks = settled(told.groupBy("_mark").agg(F.count("*").alias("n")).filter("n > 1").select("_mark"))
    size = measured_bytes(marks)
    if size:
        marks = F.broadcast(marks) if size <= MAX_BROADCAST_BYTES else marks
        again = told.join(marks, "_mark", "left_semi").groupBy(*_CONTENT).agg(F.count("*").alias("n"))
        again = again.select(*_CONTENT, "n", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("long"), F.lit(STRETCH).cast("long"))).alias("first"))
        again = again.repartition("source_id", "code_reference", "first")
        last = F.least(F.col("n") - 1, F.col("first") + (STRETCH - 1))
        again = again.select(*_CONTENT, F.explode(F.sequence(F.col("first"), last)).alias("occurrence"))
        once = told.join(marks, "_mark", "left_anti").select(*_CONTENT, F.lit(0).cast("long").alias("occurrence"))
        told = once.unionByName(again)
    else:
        told = told.select(*_CONTENT, F.lit(0).cast("long").alias("occurrence"))
    return told.select(*_CONTENT, _identity(F.col("occurrence")).alias("quarantine_id"), failed_at.alias("failed_at"))


def quarantine_records(
    rejected: DataFrame, run_id: str, environment: str, template: str, stage: str, error_code: str,
    error_message: str, failed_at: str | None = None,
) -> DataFrame:
    """One record per rejected row. The row's own reason wins over the supplied code and message."""
    payload = [c for c in rejected.columns if c != "reject"]
    own = (lambda part: F.col("reject")[part]) if "reject" in rejected.columns else (lambda part: F.lit(None))
    source_id = quoted("id") if "id" in payload else F.lit(None)
    reference = quoted("codeReference") if "codeReference" in payload else F.lit(None)
    return _records(
        rejected, run_id, environment, template, stage, F.coalesce(own("code"), F.lit(error_code)),
        F.coalesce(own("message"), F.lit(error_message)), asset_json(rejected, payload), source_id, reference,
        own("field"), failed_at,
    )


def row_records(
    lost: DataFrame, run_id: str, environment: str, template: str, stage: str, failed_at: str | None = None
) -> DataFrame:
    """Records for rows that are JSON text already (``asset``, ``source_id``, ``reject``)."""
    return _records(
        lost, run_id, environment, template, stage, F.col("reject.code"), F.col("reject.message"), F.col("asset"),
        F.col("source_id"), F.lit(None), F.col("reject.field"), failed_at,
    )


def batch_records(
    refused: DataFrame, run_id: str, environment: str, template: str, failed_at: str | None = None
) -> DataFrame:
    """Records for the payloads (``code_reference``, ``payload`` JSON text) of refused batches, with the answer's text."""
    return _records(
        refused, run_id, environment, template, UPLOAD, F.lit(REJECTED_ASSET), F.col("answer"), F.col("payload"), F.lit(None),
        F.col("code_reference"), F.lit(None), failed_at,
    )
