"""Metadata snapshots (templates, master data, tags) stored as JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.operators.payload import Template
from plumbline.operators.skew import lookup_join, settled, settled_with_size

# Field names of the snapshots.
TEMPLATES = "array<struct<id:bigint,code:string,name:string,isDeleted:boolean,isEnabled:boolean,geometryType:string>>"
SCHEMAS = "array<struct<id:bigint,characteristics:array<struct<code:string,name:string,type:string>>>>"
MASTERDATA = "array<struct<code:string,name:string,relations:array<struct<name:string,id:bigint>>>>"
TAGS = "array<struct<name:string,uid:string>>"


def _document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Entries of a JSON array document with their positions."""
    text = spark.read.text(path, wholetext=True)
    entries = text.select(F.posexplode(F.from_json("value", schema)).alias("pos", "entry"))
    return entries.select("pos", "entry.*")


def _lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Entries of JSON Lines files with their positions: 0, 1, 2, ... in the order of lines, files in the order of their paths.

    Files are cut into splits that are read in parallel. The lines of each split are counted, and a split starts at the sum of
    the counts before it. Blank lines have no position; a line that is no JSON object is an error. Lines are stored once
    in the shared folder, so that counts and positions come from the same reading.
    """
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    read = settled(text.filter("trim(value) <> ''").withColumn("at", F.monotonically_increasing_id()))
    splits = read.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    # One row for each split (128 MB by default), so this window is small where the catalogue is large.
    before = F.coalesce(F.sum("n").over(Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    split = F.concat("file", F.lit("#"), F.col("start"))
    shifts, size = settled_with_size(splits.select(split.alias("split"), (before - F.col("first")).alias("shift")))
    entry = F.from_json("value", schema.removeprefix("array<").removesuffix(">"), {"mode": "FAILFAST"})
    placed = lookup_join(read, split, shifts, "split", F.col("at"), index_bytes=size)
    return placed.select((F.col("at") + F.col("shift")).alias("pos"), entry.alias("entry")).select("pos", "entry.*")


def _entries(spark: SparkSession, path: str, schema: str, lines: bool) -> DataFrame:
    return _lines(spark, path, schema) if lines else _document(spark, path, schema)


def load_template(spark: SparkSession, templates_path: str, schemas_path: str, code: str) -> Template:
    """A template by its exact code (first match; unknown is an error) with its characteristics (none listed: empty)."""
    found = _document(spark, templates_path, TEMPLATES).filter(F.col("code") == code).orderBy("pos").head(1)
    if not found:
        raise ValueError(f"Template with code '{code}' not found.")
    head = found[0]
    listed = _document(spark, schemas_path, SCHEMAS).filter(F.col("id") == head["id"]).orderBy("pos").head(1)
    characteristics = [c.asDict() for c in (listed[0]["characteristics"] or [])] if listed else []
    for characteristic in characteristics:
        characteristic["type"] = (characteristic["type"] or "").lower() or None
    return Template(
        id=head["id"], code=head["code"], geometry_type=head["geometryType"], is_enabled=bool(head["isEnabled"]),
        is_deleted=bool(head["isDeleted"]), characteristics=tuple(characteristics),
    )


def masterdata_relations(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Flat relation rows of a master-data snapshot; an entry without relations keeps one row with NULLs.

    The snapshot is one JSON array, or with ``lines`` JSON Lines, an entry a line, which are read in parallel.
    """
    entries = _entries(spark, path, MASTERDATA, lines)
    return entries.select(
        F.col("pos").alias("entry_pos"), "code", "name", F.posexplode_outer("relations").alias("rel_pos", "relation")
    ).select("entry_pos", "code", "name", "rel_pos", F.col("relation.name").alias("value"), "relation.id")


def tag_catalogue(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Tags of a catalogue snapshot in catalogue order: name, uid, pos. ``lines`` as in ``masterdata_relations``."""
    return _entries(spark, path, TAGS, lines).select("name", "uid", F.col("pos").cast("bigint").alias("pos"))
