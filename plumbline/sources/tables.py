"""Source tables and stored datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from plumbline.operators.geo import decode_geometry, geometry_bytes
from plumbline.operators.project import project_to_template
from plumbline.functions.geometry import GEOMETRY
from plumbline.sources.layout import dataset_path
from plumbline.sources.published import attempt_path, newest, new_attempt, publish, read_version


@dataclass(frozen=True)
class Partitioning:
    """How a JDBC table is cut into parallel range scans. Bounds only shape the cut; no row is left out."""

    column: str
    lower: int | str
    upper: int | str
    partitions: int


@dataclass(frozen=True)
class JdbcTables:
    """Tables of a relational database. Without an entry in ``partitioning`` a table is one scan in one task."""

    url: str
    schema: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"
    fetch_size: int = 10_000
    partitioning: Mapping[str, Partitioning] = field(default_factory=dict)

    def options(self, table: str) -> dict:
        """Arguments of ``spark.read.jdbc``; schema and table are quoted, so their case is kept."""
        def quote(name):
            return '"' + name.replace('"', '""') + '"'

        arguments = {
            "url": self.url,
            "table": f"{quote(self.schema)}.{quote(table)}",
            "properties": {"user": self.user, "password": self.password, "driver": self.driver,
                           "fetchsize": str(self.fetch_size)},
        }
        cut = self.partitioning.get(table)
        if cut:
            arguments |= {"column": quote(cut.column), "lowerBound": cut.lower, "upperBound": cut.upper,
                          "numPartitions": cut.partitions}
        return arguments

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.jdbc(**self.options(table))


@dataclass(frozen=True)
class ParquetTables:
    """Tables kept as Parquet, one directory or file per table."""

    root: str

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(f"{self.root.rstrip('/')}/{table}.parquet")


def read_source_table(spark: SparkSession, source, table: str, geometry_column: str) -> DataFrame:
    """A source table with its geometry column decoded."""
    return decode_geometry(source.read(spark, table), geometry_column)


def read_dataset(spark: SparkSession, path: str, base_path: str | None = None) -> DataFrame:
    """The newest published version of a dataset, or plain Parquet where nothing was published.

    With ``base_path`` the run id becomes a column that prunes directories.
    """
    version = newest(spark, path)
    if version is not None:
        return read_version(spark, path, version, base_path)
    reader = spark.read if base_path is None else spark.read.option("basePath", base_path)
    return reader.parquet(path)


def write_dataset(df: DataFrame, path: str, geometry_column: str | None = None, overwrite: bool = True) -> None:
    """Publish a frame as the newest version of a dataset, with its partitioning; geometries become WKB.

    Readers see the version before it until the last row is stored. Fails on existing data unless told to overwrite.
    """
    stored = geometry_bytes(df, geometry_column) if geometry_column else df
    spark, attempt = df.sparkSession, new_attempt()
    if not overwrite and newest(spark, path) is not None:
        raise FileExistsError(f"the dataset {path} already exists")
    stored.write.mode("errorifexists").parquet(attempt_path(path, attempt))
    publish(spark, path, attempt, stored.schema)


def read_template_tables(
    spark: SparkSession, base: str, run_id: str, tables: Sequence[str], core_fields: Sequence[str],
    characteristics: Sequence[Mapping], mapping: Mapping[str, Mapping], geometry_column: str,
) -> list[DataFrame]:
    """All raw tables of a template, projected to it. No table, or an unreadable one, fails the template."""
    if not tables:
        raise ValueError("the template names no table to read")
    projected = []
    for table in tables:
        raw = decode_geometry(read_dataset(spark, dataset_path(base, run_id, table)), geometry_column)
        projected.append(
            project_to_template(raw, core_fields, characteristics, mapping, {geometry_column: GEOMETRY})
        )
    return projected
