"""Quarantine records as JSON Lines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.text import timestamp_text
from plumbline.operators.quarantine import RECORD
from plumbline.operators.skew import settled

# What Spark writes as % and two digits in the name of a partition folder.
_ESCAPED = "\"#%'*/:=?\\{[]^"

PARTITIONS = ("environment", "date", "run_id", "template", "stage", "attempt")


def failure_day(failed_at: Column) -> Column:
    """UTC date of a failure as text, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(failed_at) / 86400).cast("int")).cast("string")


def record_line(records: DataFrame) -> Column:
    """A record as one JSON text: the rejected row nested as an object, NULL fields kept, the time in UTC."""
    shown = {
        "asset": F.parse_json("asset"),
        "failed_at": F.concat(
            timestamp_text(F.to_utc_timestamp("failed_at", F.current_timezone())), F.lit("+00:00")
        ),
    }
    fields = [shown.get(name, F.col(name)).alias(name) for name in RECORD.names]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


@dataclass(frozen=True)
class Scope:
    """Whose records one call stores: all of one stage of one template in one run, as found by one attempt."""

    environment: str
    run_id: str
    template: str
    stage: str
    attempt: str = "1"

    def folder(self, path: str, day: str = "*") -> str:
        values = {"environment": self.environment, "date": day, "run_id": self.run_id, "template": self.template, "stage": self.stage, "attempt": self.attempt}
        return "/".join([path.rstrip("/"), *[f"{name}={day if name == 'date' else folder_name(values[name])}" for name in PARTITIONS]])


def folder_name(value: str) -> str:
    """A value as it stands in the name of a partition folder; what has a meaning in a path pattern is among what is written as digits."""
    return "__HIVE_DEFAULT_PARTITION__" if not value else "".join(f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 32 or ord(c) == 127 else c for c in value)


def _stored(spark: SparkSession, path: str, scope: Scope) -> DataFrame | None:
    """(id, failed_at, date) of what is stored for a scope on any day; only its own folders are listed."""
    try:
        lines = spark.read.option("basePath", path).text(scope.folder(path))
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            return None
        raise
    told = F.from_json("value", "quarantine_id string, failed_at timestamp")
    return settled(lines.select(told["quarantine_id"].alias("quarantine_id"), told["failed_at"].alias("first_failed_at"), F.col("date").cast("string").alias("date")))


def write_quarantine(records: DataFrame, path: str, attempt: str = "1", scope: Scope | None = None) -> None:
    """Store records below environment/date/run_id/template/stage/attempt; no records, no files.

    The lines are written as text because a JSON writer would drop the folder columns from the records. A call holds all records of its scope,
    and afterwards exactly they are stored for it, whatever day an earlier call was made: a record that is known by its id keeps the time and
    day of its first failure, a new one is added, one that is not told again goes. Scopes of other names, such as other attempts, stay. Without
    ``scope`` the scopes are those that the records name; a call that may have no records must hand its scope in, or nothing stale is found.
    """
    spark = records.sparkSession
    if scope is None:
        records = settled(records)  # read for the names and for each of them; what they are derived from is computed once
        named = records.select("environment", "run_id", "template_code", "stage").distinct().collect()  # one, or a few
        scopes = [Scope(*row, attempt) for row in named]
    else:
        scopes = [scope]
    for one in scopes:
        own = records if scope is not None else records.filter(
            F.col("environment").eqNullSafe(one.environment) & F.col("run_id").eqNullSafe(one.run_id) & F.col("template_code").eqNullSafe(one.template) & F.col("stage").eqNullSafe(one.stage))
        known, days = _stored(spark, path, one), set()
        if known is not None:
            own = own.join(known.drop("date"), "quarantine_id", "left").withColumn("failed_at", F.coalesce("first_failed_at", "failed_at")).drop("first_failed_at")
            days = {row["date"] for row in known.select("date").distinct().collect()}  # days on which this scope was stored
        lines = own.select(
            "environment", failure_day(F.col("failed_at")).alias("date"), "run_id", F.col("template_code").alias("template"),
            "stage", F.lit(one.attempt).alias("attempt"), record_line(own).alias("value"),
        )
        if known is not None:
            lines = settled(lines)
            days -= {row["date"] for row in lines.select("date").distinct().collect()}
        lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).text(path)
        for day in sorted(days):  # none of that day's records is told again
            lines.select("value").limit(0).write.mode("overwrite").text(one.folder(path, day))
