"""S1-S4, K1, K3, F1-F3: sources, sinks and whole jobs over files in the shared folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.functions.wkb import to_wkb
from plumbline.operators.project import union_tables
from plumbline.operators.lookup import masterdata_index
from plumbline.operators.payload import PayloadSettings, Template
from plumbline.plans.deliver import deliver
from plumbline.plans.errors import StageFailed
from plumbline.plans.extract import extract
from plumbline.plans.standardize import Run, standardize
from plumbline.operators.geo import decode_geometry
from plumbline.sources.layout import dataset_path
from plumbline.sources.quarantine import Scope, write_quarantine
from plumbline.sources.tables import ParquetTables, read_dataset, read_source_table, read_template_tables, write_dataset
from registry.inputs import (
    NAMED_SQL, PARTY, PARTY_CHARACTERISTICS, PARTY_CORE, PARTY_MAPPING, PARTY_RULES, PARTIES_SQL, party_raw, points,
    PARTY_SOURCES, reject_sql, rings, scratch, select_sql, table,
)
from registry.lookups import nation_relations, tags
from registry.payloads import SETTINGS, records
from registry.privacy import with_points
from registry.shaping import SHOWN_SQL, shown

RUN_ID = "manual__2024-03-01T10:20:30+00:00"
RUN_PATH = "20240301T102030.000000Z"


@dataclass(frozen=True)
class DerivedTables:
    """A source whose tables are derived from the given ones."""

    sf_dir: str

    def read(self, spark, name):
        if name == "rings":
            return rings(spark, self.sf_dir).withColumn("geom", F.hex(to_wkb(F.col("geom"))))
        raw = with_points(party_raw(spark, self.sf_dir, name))
        return raw.withColumn("geom", to_wkb(F.col("geom")))


def read_table(spark, sf_dir):
    orders = ParquetTables(sf_dir).read(spark, "orders")
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


def read_geometry_table(spark, sf_dir):
    df = read_source_table(spark, DerivedTables(sf_dir), "rings", "geom")
    ring = F.col("geom.parts")[0][0]
    return df.select("p_partkey", F.col("geom.type").alias("type"), F.size(ring).alias("n"), ring[2][0].alias("x"), ring[2][1].alias("y"))


def read_back(spark, sf_dir):
    base = scratch(spark, "standard")
    write_dataset(points(spark, sf_dir), dataset_path(base, RUN_ID, "points"), "geom")
    stored = read_dataset(spark, dataset_path(base, RUN_ID, "points"), base)
    meta = stored.schema["geom"].metadata.get("geometry", "")
    df = decode_geometry(stored, "geom")
    return df.select("o_orderkey", "run_id", F.lit(meta).alias("stored_as"), F.coalesce(F.col("geom.parts")[0][0][0][1], F.lit(-1.0)).alias("y"))


def overwritten(spark, sf_dir):
    path = dataset_path(scratch(spark, "standard"), "first run", "customer")
    write_dataset(table(spark, sf_dir, "supplier"), path)
    write_dataset(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), path)
    return read_dataset(spark, path)


def published_versions(spark, sf_dir):
    """What readers see after a first write, during and after a second one that fails half way, and after a third one."""
    path = dataset_path(scratch(spark, "standard"), "run", "customer")

    def seen(moment):
        return read_dataset(spark, path).select(F.lit(moment).alias("moment"), "key", "name")

    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    write_dataset(supplier, path)
    first = seen("first")
    broken = F.when(F.col("key") % 97 == 5, F.raise_error(F.lit("lost"))).otherwise(F.col("name"))
    try:
        write_dataset(customer.withColumn("name", broken), path)
        failed = seen("a broken write was published")
    except PySparkException:
        failed = seen("failed")
    write_dataset(customer, path)
    return first.unionByName(failed).unionByName(seen("third"))


def raw_party(spark, sf_dir, at_once=1):
    base = scratch(spark, "raw")
    extract(spark, DerivedTables(sf_dir), {"PARTY": ["customer", "supplier"]}, base, RUN_ID, "geom", at_once)
    return base


def extracted_together(spark, sf_dir):
    return extracted(spark, sf_dir, 2)


def extracted(spark, sf_dir, at_once=1):
    base = raw_party(spark, sf_dir, at_once)
    frames = [
        read_dataset(spark, dataset_path(base, RUN_ID, name)).select(
            F.lit(name).alias("source"), "k", "id", "name", "balance", F.col("geom").isNotNull().alias("has_geom")
        ) for name in ("customer", "supplier")
    ]
    return frames[0].unionByName(frames[1])


def template_tables(spark, sf_dir):
    frames = read_template_tables(
        spark, raw_party(spark, sf_dir), RUN_ID, ["customer", "supplier"], ("k", *PARTY_CORE, "geom"), PARTY_CHARACTERISTICS,
        PARTY_MAPPING, "geom",
    )
    return shown(union_tables(frames))


def party_run(spark, sf_dir):
    base = scratch(spark, "run")
    return Run(
        run_id=RUN_ID, environment="DEV", raw=raw_party(spark, sf_dir), standard=f"{base}/standard",
        quarantine=f"{base}/quarantine", max_quarantine_ratio=0.5, rules=PARTY_RULES, ledger=f"{base}/ledger",
    )


def standardized(spark, sf_dir):
    """Standard rows and quarantine lines of a whole run, read back from where it stored them."""
    run = party_run(spark, sf_dir)
    counts = standardize(spark, run, [PARTY], {"PARTY": ["customer", "supplier"]}, PARTY_MAPPING)["PARTY"]
    valid = read_dataset(spark, dataset_path(run.standard, RUN_ID, "PARTY")).select(
        F.lit("valid").alias("side"), "id", "name", F.col("P_amount").cast("string").alias("amount"), F.lit(None).cast("string").alias("code"),
    )
    lines = spark.read.json(run.quarantine)
    lost = lines.select(
        F.lit("rejected").alias("side"), F.col("asset.id").alias("id"), F.col("asset.name").alias("name"),
        F.col("asset.P_amount").cast("string").alias("amount"), F.col("error_code").alias("code"),
    )
    return valid.unionByName(lost).withColumns(
        {"written": F.lit(counts["written"]).cast("bigint"), "quarantined": F.lit(counts["quarantined"]).cast("bigint")}
    )


def delivered(spark, sf_dir):
    """Payloads of a whole run as the receiving side saw them; every batch is accepted."""
    run = party_run(spark, sf_dir)
    standardize(spark, run, [PARTY], {"PARTY": ["customer", "supplier"]}, PARTY_MAPPING)
    sent = f"{run.standard}-sent"

    def accept(batches):
        batches.write.mode("overwrite").parquet(sent)
        return spark.read.parquet(sent).select("batch_id", F.lit(200).alias("status"), F.lit("ok").alias("body"))

    counts = deliver(spark, run, [PARTY], SETTINGS, accept)["PARTY"]
    items = spark.read.parquet(sent).select(F.inline("items"))
    return items.select(
        "source_id", "code_reference", F.get_json_object("payload", "$.name").alias("name"),
        F.get_json_object("payload", "$.geometry.coordinates").alias("coordinates"), F.lit(counts["written"]).cast("bigint").alias("written"),
    )


ASSET = Template(id=7, code="ASSET", characteristics=(
    {"code": "I", "name": "I", "type": "integer"}, {"code": "ASIA", "name": "Nation", "type": "maindata"},
    {"code": "G", "name": "Tags", "type": "iotsignal"}))


def delivered_outcomes(spark, sf_dir):
    """A delivery with master data and tags where some assets cannot be built, some batches are refused and the gate fails.

    Batches hold one asset, so that what is refused does not depend on the partitioning.
    """
    base = scratch(spark, "outcomes")
    run = Run(run_id=RUN_ID, environment="DEV", raw=base, standard=f"{base}/standard", quarantine=f"{base}/quarantine",
              max_quarantine_ratio=0.1, rules=PARTY_RULES, ledger=f"{base}/ledger")
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))  # 25 rows by definition
    assets = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.lit(None).cast("binary").alias("geom"),
        F.expr("CASE WHEN c_custkey % 11 = 0 THEN 'x' ELSE CAST(c_custkey AS string) END").alias("I"), F.col("n_name").alias("ASIA"))
    write_dataset(assets, dataset_path(run.standard, RUN_ID, "ASSET"), "geom")
    sent = f"{base}/sent"

    def answer(batches):
        batches.write.mode("overwrite").parquet(sent)
        refused = F.col("items")[0]["source_id"].cast("bigint") % 5 == 0
        return spark.read.parquet(sent).select("batch_id", F.when(refused, 422).otherwise(200).alias("status"), F.lit("said").alias("body"))

    try:
        deliver(spark, run, [ASSET], PayloadSettings(batch_size=1), answer, masterdata_index(nation_relations(spark, sf_dir)), tags(spark, sf_dir))
        counts, gate = {}, "passed"
    except StageFailed as failed:
        counts, gate = failed.outcomes["ASSET"], "failed"
    stored = spark.read.json(run.quarantine).select(F.coalesce("source_id", "code_reference").alias("id"), "stage", "error_code")
    payload = spark.read.parquet(sent).select(F.inline("items")).select(
        F.col("source_id").alias("id"), F.get_json_object("payload", "$.characteristics[1].value").alias("nation"),
        F.json_array_length(F.get_json_object("payload", "$.characteristics[2].value")).cast("bigint").alias("signals"))
    return payload.join(stored, "id", "full").select(
        "id", F.coalesce("stage", F.lit("delivered")).alias("stage"), "error_code", "nation", "signals", F.lit(gate).alias("gate"),
        F.lit(counts.get("written")).cast("bigint").alias("written"), F.lit(counts.get("quarantined")).cast("bigint").alias("quarantined"))


def resumed_delivery(spark, sf_dir):
    """A delivery in waves whose line breaks in the third one, and whose receiver is out of order for some; then the same delivery again.

    ``accepted`` counts how often an asset was answered well in both tries, ``sends_without_failures`` how often it was sent to a receiver in order.
    """
    base = scratch(spark, "resumed")
    run = Run(run_id=RUN_ID, environment="DEV", raw=base, standard=f"{base}/standard", quarantine=f"{base}/quarantine", max_quarantine_ratio=0.0,
              rules=PARTY_RULES, ledger=f"{base}/ledger")
    assets = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.lit(None).cast("binary").alias("geom"), F.col("c_custkey").cast("string").alias("I"))
    write_dataset(assets, dataset_path(run.standard, RUN_ID, "ONE"), "geom")
    template, sent = Template(id=8, code="ONE", characteristics=({"code": "I", "name": "I", "type": "integer"},)), []

    def answer(last):
        def told(batches):
            if len(sent) == last:
                raise ConnectionError("the line is down")
            out_of_order = (F.col("items")[0]["source_id"].cast("bigint") % 7 == 0) if not sent else F.lit(False)
            sent.append(f"{base}/sent/{len(sent)}")
            batches.withColumn("status", F.when(out_of_order, 503).otherwise(200)).write.parquet(sent[-1])
            return spark.read.parquet(sent[-1]).select("batch_id", "status", F.lit("said").alias("body"))
        return told

    try:
        deliver(spark, run, [template], PayloadSettings(batch_size=1), answer(2), waves=4)
        raise AssertionError("the first try came through")
    except StageFailed:
        pass
    counts = deliver(spark, run, [template], PayloadSettings(batch_size=1), answer(None), waves=2)["ONE"]
    told = spark.read.parquet(*sent).select(F.explode("items").alias("i"), "status")
    return told.groupBy(F.col("i.source_id").alias("id")).agg(
        F.count_if(F.col("status") == 200).alias("accepted"), (F.count("*") - F.count_if(F.col("status") == 503)).alias("sends_without_failures"),
    ).withColumn("written", F.lit(counts["written"]).cast("bigint"))


def quarantine_sink(spark, sf_dir):
    """Two calls with different halves of the rejects, the second one repeated under its name."""
    path = scratch(spark, "quarantine")
    rejects = records(spark, sf_dir)
    even = F.pmod(F.xxhash64("source_id", "asset"), F.lit(2)) == 0
    write_quarantine(rejects.where(even), path, "first")
    for _ in range(2):
        write_quarantine(rejects.where(~even), path, "second")
    return spark.read.json(path).select(
        "environment", "run_id", "template", "stage", "template_code", "error_code", "source_id", "field_name",
        F.col("asset.name").alias("name"),
    )


def repeated_quarantine(spark, sf_dir):
    """Three tries of one scope on three days: half of the rejects, all of them, and those with a source id; times are of the first failure."""
    path, scope = scratch(spark, "quarantine"), Scope("DEV", "run-1", "PARTY", "standardization")
    rejects = records(spark, sf_dir)
    for day, told in ((1, rejects.where("error_code <> 'invalid_type'")), (2, rejects), (3, rejects.where("source_id IS NOT NULL"))):
        write_quarantine(told.withColumn("failed_at", F.lit(f"2024-03-0{day} 08:00:00").cast("timestamp")), path, scope=scope)
    stored = spark.read.json(path)
    return stored.select("error_code", "source_id", F.col("asset.name").alias("name"), F.col("date").cast("string").alias("day"),
                         (F.count("*").over(Window.partitionBy("quarantine_id")) == 1).alias("told_once"))


QUERIES = {
    "S1_read_table": read_table,
    "S2_read_geometry_table": read_geometry_table,
    "S3_read_dataset": read_back,
    "S4_template_tables": template_tables,
    "K1_write_dataset": overwritten,
    "K1_published_versions": published_versions,
    "K3_quarantine_sink": quarantine_sink,
    "K3_repeated_quarantine": repeated_quarantine,
    "F1_extract": extracted,
    "F1_extract_together": extracted_together,
    "F2_standardize": standardized,
    "F3_deliver": delivered,
    "F3_deliver_outcomes": delivered_outcomes,
    "F3_resumed_delivery": resumed_delivery,
}

_CODED = reject_sql(NAMED_SQL)
_COUNTED = f"SELECT *, count(*) FILTER (WHERE code IS NULL) OVER () AS written, count(*) FILTER (WHERE code IS NOT NULL) OVER () AS quarantined FROM ({_CODED})"

ORACLES = {
    "S1_read_table": "SELECT o_orderkey, o_custkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders",
    # The WKB reader closes open rings, so every ring has five points.
    "S2_read_geometry_table": """
SELECT p_partkey, 'Polygon' AS type, 5 AS n, CAST(p_partkey + 1 AS DOUBLE) AS x,
       CAST(p_size + CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE 1 END AS DOUBLE) AS y FROM part""",
    "S3_read_dataset": f"""
SELECT o_orderkey, '{RUN_PATH}' AS run_id, 'wkb' AS stored_as,
       CAST(CASE WHEN o_orderkey % 43 <> 0 THEN o_orderkey ELSE -1 END AS DOUBLE) AS y FROM orders""",
    "S4_template_tables": f"SELECT {SHOWN_SQL} FROM ({PARTIES_SQL})",
    "K1_write_dataset": "SELECT c_custkey, c_name FROM customer",
    "K1_published_versions": """
SELECT 'first' AS moment, s_suppkey AS key, s_name AS name FROM supplier UNION ALL SELECT 'failed', s_suppkey, s_name FROM supplier
UNION ALL SELECT 'third', c_custkey, c_name FROM customer""",
    "K3_quarantine_sink": f"""
SELECT 'DEV' AS environment, 'run-1' AS run_id, 'PARTY' AS template, 'standardization' AS stage, 'PARTY' AS template_code,
       code AS error_code, id AS source_id, field AS field_name, name FROM ({_CODED}) WHERE code IS NOT NULL""",
    "K3_repeated_quarantine": f"""
SELECT code AS error_code, id AS source_id, name, CASE WHEN code = 'invalid_type' THEN '2024-03-02' ELSE '2024-03-01' END AS day, true AS told_once
FROM ({_CODED}) WHERE code IS NOT NULL AND id IS NOT NULL""",
    "F1_extract": " UNION ALL ".join(
        f"SELECT '{name}' AS source, k, id, name, balance, k % 43 <> 0 AS has_geom FROM ({select_sql(name, columns)})"
        for name, columns in PARTY_SOURCES.items()),
    "F1_extract_together": " UNION ALL ".join(
        f"SELECT '{name}' AS source, k, id, name, balance, k % 43 <> 0 AS has_geom FROM ({select_sql(name, columns)})"
        for name, columns in PARTY_SOURCES.items()),
    "F2_standardize": f"""
SELECT CASE WHEN code IS NULL THEN 'valid' ELSE 'rejected' END AS side, id, name, CAST(p_amount AS VARCHAR) AS amount, code,
       written, quarantined FROM ({_COUNTED})""",
    "F3_deliver_outcomes": f"""
WITH a AS (
  SELECT c_custkey AS k, CASE WHEN r_name = 'ASIA' THEN CAST(n_nationkey AS VARCHAR) END AS nation, c_custkey % 11 = 0 AS lost, c_custkey % 5 = 0 AS refused
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), s AS (SELECT user_id, count(*) AS n FROM events WHERE event_id % 50 <> 0 GROUP BY user_id)
SELECT CAST(k AS VARCHAR) AS id, CASE WHEN lost THEN 'serialization' WHEN refused THEN 'upload' ELSE 'delivered' END AS stage,
       CASE WHEN lost THEN 'invalid_type' WHEN refused THEN 'dmd_rejected_asset' END AS error_code,
       CASE WHEN NOT lost THEN nation END AS nation, CASE WHEN NOT lost THEN coalesce(s.n, 0) END AS signals, 'failed' AS gate,
       count(*) FILTER (WHERE NOT lost AND NOT refused) OVER () AS written, count(*) FILTER (WHERE lost OR refused) OVER () AS quarantined
FROM a LEFT JOIN s ON s.user_id = k""",
    "F3_resumed_delivery": "SELECT CAST(c_custkey AS VARCHAR) AS id, 1 AS accepted, 1 AS sends_without_failures, count(*) OVER () AS written FROM customer",
    "F3_deliver": f"""
SELECT id AS source_id, concat('REF ', coalesce(p_amount_text, id)) AS code_reference, concat('PB - ', name) AS name,
       CASE WHEN k % 43 <> 0 THEN concat('[', k, '.0,', k, '.0]') END AS coordinates, written FROM ({_COUNTED}) WHERE code IS NULL""",
}
