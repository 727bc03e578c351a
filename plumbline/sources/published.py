"""Published datasets: data in a folder of its own for each attempt, and a manifest that says which one counts.

A dataset's folder holds ``attempts/<name>``, where an attempt writes for itself, and ``manifest``, to which publishing adds one line. Readers
take the newest line and read the folder it names. So a reader sees the dataset as it was before an attempt, or all of what the attempt stored,
never a part; an attempt that fails leaves what was published before it; and a reader that has begun keeps its files, as none are deleted.
The folders are run-scoped: let them expire. A line is one small file that the writer's commit renames into place.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LINE = "version bigint, attempt string, folder string, columns string, tag string"


@dataclass(frozen=True)
class Version:
    """One published state of a dataset: its number, the attempt that stored it, where below the dataset's folder, and its columns."""

    number: int
    attempt: str
    folder: str
    columns: T.StructType
    tag: str | None = None


def new_attempt() -> str:
    return uuid.uuid4().hex


def attempt_path(path: str, attempt: str) -> str:
    return f"{path.rstrip('/')}/attempts/{attempt}"


def _absent(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (error.getCondition() or "")


def newest(spark: SparkSession, path: str) -> Version | None:
    """The version that readers of ``path`` see, or None where nothing was published."""
    try:
        lines = spark.read.schema(_LINE).json(f"{path.rstrip('/')}/manifest")
    except AnalysisException as error:
        if _absent(error):
            return None
        raise
    row = lines.filter("version IS NOT NULL").agg(F.max_by(F.struct("*"), F.struct("version", "attempt"))).first()[0]
    return row and Version(row["version"], row["attempt"], row["folder"], T.StructType.fromJson(json.loads(row["columns"])), row["tag"])


def publish(spark: SparkSession, path: str, attempt: str, columns: T.StructType, part: str = "", tag: str | None = None) -> Version:
    """Make what ``attempt`` stored (in ``part`` of its folder) the dataset's newest version; of two at once the later name wins.

    ``tag`` is the caller's own note on the version, such as what it was made from.
    """
    before = newest(spark, path)
    folder = f"attempts/{attempt}/{part}".rstrip("/")
    version = Version(before.number + 1 if before else 1, attempt, folder, columns, tag)
    line = [(version.number, attempt, folder, columns.json(), tag)]
    spark.createDataFrame(line, _LINE).coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/manifest")
    return version


def read_version(spark: SparkSession, path: str, version: Version, base_path: str | None = None) -> DataFrame:
    """The rows of a version; its columns keep type and metadata. Columns of folders above come only with ``base_path``."""
    reader = spark.read.schema(version.columns)
    place = f"{path.rstrip('/')}/{version.folder}"
    try:
        found = (reader if base_path is None else reader.option("basePath", base_path)).parquet(place)
    except AnalysisException as error:
        if not _absent(error):
            raise
        return spark.createDataFrame([], version.columns)  # a partition folder without rows is never made
    own = place.removeprefix((base_path or place).rstrip("/"))
    above = [part.partition("=")[0] for part in path.removeprefix((base_path or path).rstrip("/")).split("/") if "=" in part]
    inner = {part.partition("=")[0] for part in own.split("/") if "=" in part} - set(above) - set(version.columns.names)
    return found.drop(*inner)
