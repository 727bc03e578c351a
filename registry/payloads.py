"""B, Q and K4: payload building, quarantine records, batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.text import characteristic_name, double_text, timestamp_text
from plumbline.operators.batches import assemble_batches, batch_rows, route_outcomes
from plumbline.operators.lookup import masterdata_index
from plumbline.operators.payload import (
    PayloadSettings, Template, build_payloads, code_reference, default_value, formatted_value, payload_characteristics,
)
from plumbline.operators.project import fill_name
from plumbline.operators.quarantine import (
    STANDARDIZATION, SERIALIZATION, batch_records, quarantine_records,
)
from plumbline.operators.validate import split
from plumbline.sources.quarantine import failure_day
from registry.checking import party_classified
from registry.inputs import NAMED_SQL, PARTY, PARTY_CHARACTERISTICS, PARTY_SOURCES, party_raw, party_sql, reject_sql, select_sql, table
from registry.lookups import tags
from registry.privacy import with_points
from registry.shaping import projected, unified

SETTINGS = PayloadSettings(
    name_prefix="PB - ", code_reference_prefix="REF ", origin_id=1, consumer_application_id=2, main_hierarchy_parent=123456,
    batch_size=100, hash_code="P_amount_text",
)
PAYLOAD = Template(id=42, code="PARTY", is_enabled=True, is_deleted=False, characteristics=(
    *PARTY_CHARACTERISTICS,
    {"code": "P_map", "name": "Hidden", "type": "iotsynoptic"},
    {"code": "P_signals", "name": "Signals", "type": "iotsignal"},
    {"code": "P_size", "name": "Size", "type": "double"},
))


def segment_index(spark, sf_dir):
    """Market segments as master data of the segment characteristic; ids are the lowest customer keys."""
    lowest = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.min("c_custkey").alias("id"))
    return masterdata_index(lowest.select(
        F.lit(0).alias("entry_pos"), F.lit("P_segment").alias("code"), F.lit("Segment").alias("name"),
        F.lit(0).alias("rel_pos"), F.col("c_mktsegment").alias("value"), "id",
    ))


def built(spark, sf_dir):
    standard = with_points(fill_name(unified(spark, sf_dir))).drop("_invalid_type_fields")
    named = tags(spark, sf_dir).withColumn("name", F.concat(F.lit("C"), F.col("name")))
    return build_payloads(standard, PAYLOAD, SETTINGS, segment_index(spark, sf_dir), named)


def names(spark, sf_dir):
    name = F.when(F.col("p_partkey") % 9 != 0, F.concat_ws(" - ", "p_name", "p_type"))
    kept = [c["code"] for c in payload_characteristics(PAYLOAD.characteristics)]
    return table(spark, sf_dir, "part").select(
        "p_partkey", characteristic_name(name).alias("name"), F.lit(",".join(kept)).alias("codes")
    )


def defaults(spark, sf_dir):
    kinds = ("double", "integer", "maindata", "date", "string", "boolean")
    return table(spark, sf_dir, "part").select(
        "p_partkey", *[F.to_json(default_value(k).cast("variant")).alias(f"{k}_default") for k in kinds]
    )


def characteristics(spark, sf_dir):
    rows = built(spark, sf_dir).select("k", "id", F.inline("payload.characteristics"))
    return rows.select("k", "id", "name", "code", "type", F.to_json("value").alias("value"))


def formatted(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr("CASE WHEN o_orderkey % 13 = 0 THEN CAST('NaN' AS DOUBLE) WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END").alias("price"),
        F.expr("CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate END").alias("day"),
        (F.col("o_orderkey") * 1048576.0).alias("large"), (F.col("o_orderkey") / 1073741824.0).alias("small"),
    )
    types = dict((f.name, f.dataType) for f in orders.schema.fields)
    return orders.select(
        "o_orderkey",
        formatted_value("double", "price", types["price"])[0].alias("double_text"),
        formatted_value("integer", "price", types["price"])[0].alias("integer_text"),
        formatted_value("date", "day", types["day"])[0].alias("date_text"),
        F.expr(double_text("large")).alias("large"), F.expr(double_text("small")).alias("small"),
    )


def assets(spark, sf_dir):
    p = F.col("payload")
    return built(spark, sf_dir).select(
        "k", p["templateId"].alias("template_id"), p["templateCode"].alias("template_code"), p["name"].alias("name"),
        p["isEnabled"].alias("is_enabled"), p["isDeleted"].alias("is_deleted"), p["originId"].alias("origin_id"),
        F.to_json(p["geometry"]).alias("geometry"), F.to_json(p["externalObjects"], {"ignoreNullFields": "false"}).alias("external"),
        p["mainHierarchyParent"].alias("parent"), p["codeReference"].alias("code_reference"),
        F.size(p["characteristics"]).alias("characteristics"),
    )


def references(spark, sf_dir):
    raw = party_raw(spark, sf_dir, "customer")
    return raw.select("k", code_reference(F.col("amount_text"), F.col("id"), "REF ").alias("with_hash"),
                      code_reference(None, F.col("id"), "REF ").alias("without_hash"))


def unbuildable(spark, sf_dir):
    raw = party_raw(spark, sf_dir, "customer").select("k", "id", "name", F.col("amount_text").alias("P_amount"))
    template = Template(id=1, code="RAW", characteristics=({"code": "P_amount", "name": "Amount", "type": "integer"},))
    done = build_payloads(raw, template, SETTINGS)
    value = F.to_json(F.col("payload.characteristics")[0]["value"])
    return done.select("k", F.col("reject.code").alias("code"), F.col("reject.message").alias("message"),
                       F.when(F.col("reject").isNull(), value).alias("value"))


def records(spark, sf_dir):
    _, rejected = split(party_classified(spark, sf_dir))
    slim = rejected.select("k", "id", "name", F.col("P_segment").alias("segment"), "reject")
    return quarantine_records(
        slim, "run-1", "DEV", "PARTY", STANDARDIZATION, "invalid_type", "Asset failed final validation."
    )


def record_rows(spark, sf_dir):
    return records(spark, sf_dir).select(
        "run_id", "environment", "template_code", "stage", "error_code", "error_message", "asset", "source_id",
        "code_reference", "field_name",
    )


def record_schema(spark, sf_dir):
    return records(spark, sf_dir).select(
        F.col("source_id"), F.length("quarantine_id").alias("id_length"), F.col("failed_at").isNotNull().alias("has_time")
    )


def default_reason(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("codeReference"))
    return quarantine_records(rows, "run-1", "DEV", "SUP", SERIALIZATION, "invalid_type", "no payload").select(
        "source_id", "code_reference", "stage", "error_code", "error_message", "asset", "field_name"
    )


def failure_days(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", failure_day(F.col("o_orderdate").cast("timestamp")).alias("day"))


def order_payloads(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("source_id"),
        F.concat(F.lit("REF "), F.col("o_orderkey")).alias("code_reference"),
        F.to_json(F.struct("o_orderkey", "o_orderstatus")).alias("payload"),
    )


def batches(spark, sf_dir):
    rows = assemble_batches(order_payloads(spark, sf_dir), 100).select(
        (F.col("size") == F.size("items")).alias("counted"), (F.col("size") <= 100).alias("fits"), F.explode("items").alias("item")
    )
    return rows.select("counted", "fits", "item.source_id", "item.code_reference", "item.payload")


def numbered_batches(spark, sf_dir):
    """Batches of at most 100 neighbouring orders, numbered by key so that they do not depend on the partitioning."""
    rows = order_payloads(spark, sf_dir).withColumn("batch_id", F.floor(F.col("source_id") / 100))
    item = F.struct(F.col("source_id").cast("string").alias("source_id"), "code_reference", "payload")
    return rows.groupBy("batch_id").agg(F.collect_list(item).alias("items"))


def answers(spark, sf_dir):
    batch = table(spark, sf_dir, "orders").select(F.expr("o_orderkey div 100").alias("batch_id")).distinct()
    status = F.expr("CASE batch_id % 5 WHEN 1 THEN 422 WHEN 2 THEN 500 WHEN 4 THEN 404 ELSE 200 END")
    return batch.filter("batch_id % 7 <> 0").select(
        "batch_id", status.alias("status"), F.concat(F.lit("answer "), F.col("batch_id")).alias("body")
    )


def routed(spark, sf_dir):
    return batch_rows(route_outcomes(numbered_batches(spark, sf_dir), answers(spark, sf_dir)))


def outcomes(spark, sf_dir):
    return routed(spark, sf_dir).select("batch_id", "source_id", "outcome", "answer")


def refused_records(spark, sf_dir):
    return batch_records(routed(spark, sf_dir).filter("outcome = 'rejected'"), "run-1", "DEV", "ORDER").select(
        "template_code", "stage", "error_code", "error_message", "asset", "source_id", "code_reference"
    )


QUERIES = {
    "B1_characteristic_names": names,
    "B2_default_values": defaults,
    "B3_characteristics": characteristics,
    "B4_formatted_values": formatted,
    "B5_asset_payload": assets,
    "B6_code_reference": references,
    "B7_unbuildable_rows": unbuildable,
    "Q1_quarantine_records": record_rows,
    "Q1_default_reason": default_reason,
    "Q2_batch_records": refused_records,
    "Q3_record_schema": record_schema,
    "Q5_failure_day": failure_days,
    "K4_batch_assembly": batches,
    "K4_outcome_routing": outcomes,
}

_RAW = select_sql("customer", PARTY_SOURCES["customer"])
_SIGNALS = """(SELECT concat('[', string_agg(concat('{"name":"', id, '","type":"SIGNAL","uid":"', event_id, '"}'), ',' ORDER BY event_id), ']')
 FROM events WHERE event_id % 50 <> 0 AND id = concat('C', user_id))"""
_VALUES = {
    "P_amount": ("Amount", "integer", "concat('\"', coalesce(CAST(p_amount AS VARCHAR), '0'), '\"')"),
    "P_amount_text": ("Amount_text", "string", "to_json(p_amount_text)"),
    "P_flag": ("Flag", "boolean", "p_flag"),
    "P_day": ("First_Day", "date", "to_json(p_day)"),
    "P_balance": ("Balance", "double", "concat('\"', CAST(p_balance AS VARCHAR), '\"')"),
    "P_segment": ("Market_Segment", "maindata",
                  "(SELECT CAST(min(c_custkey) AS VARCHAR) FROM customer WHERE c_mktsegment = p_segment)"),
    "P_zone": ("", "string", "to_json(p_zone)"),
    "P_later": ("Later", "date", "CAST(NULL AS VARCHAR)"),
    "P_signals": ("Signals", "iotsignal", f"coalesce({_SIGNALS}, '[]')"),
    "P_size": ("Size", "double", "'0.0'"),
}
_BATCH = "o_orderkey // 100"
_ROUTED = f"""
SELECT CAST({_BATCH} AS BIGINT) AS batch_id, CAST(o_orderkey AS VARCHAR) AS source_id, o_orderstatus,
       CASE WHEN {_BATCH} % 7 = 0 OR {_BATCH} % 5 = 2 THEN 'failed' WHEN {_BATCH} % 5 IN (1, 4) THEN 'rejected' ELSE 'written' END AS outcome,
       CASE WHEN {_BATCH} % 7 <> 0 THEN concat('answer ', {_BATCH}) END AS answer
FROM orders"""
_ORDER_PAYLOAD = """concat('{"o_orderkey":', source_id, ',"o_orderstatus":"', o_orderstatus, '"}')"""

ORACLES = {
    "B1_characteristic_names": f"""
SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN ''
                  ELSE replace(replace(concat(p_name, ' - ', p_type), ' ', '_'), '_-_', '_') END AS name,
       '{','.join(c for c in _VALUES)}' AS codes FROM part""",
    "B2_default_values": """
SELECT p_partkey, '0.0' AS double_default, '0' AS integer_default, CAST(NULL AS VARCHAR) AS maindata_default,
       CAST(NULL AS VARCHAR) AS date_default, '""' AS string_default, '""' AS boolean_default FROM part""",
    "B3_characteristics": " UNION ALL ".join(
        f"SELECT k, id, '{name}' AS name, '{code}' AS code, '{kind}' AS type, CAST({value} AS VARCHAR) AS value FROM ({NAMED_SQL})"
        for code, (name, kind, value) in _VALUES.items()),
    "B4_formatted_values": """
SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 7 = 0 THEN '0.0' ELSE CAST(o_totalprice AS VARCHAR) END AS double_text,
       CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 7 = 0 THEN '0' ELSE CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR) END AS integer_text,
       CASE WHEN o_orderkey % 5 <> 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS date_text,
       CAST(o_orderkey * CAST(1048576 AS DOUBLE) AS VARCHAR) AS large, CAST(o_orderkey / CAST(1073741824 AS DOUBLE) AS VARCHAR) AS small
FROM orders""",
    "B5_asset_payload": f"""
SELECT k, 42 AS template_id, 'PARTY' AS template_code, concat('PB - ', coalesce(name, 'None')) AS name, true AS is_enabled,
       false AS is_deleted, 1 AS origin_id,
       CASE WHEN k % 43 <> 0 THEN concat('{{"type":"Point","coordinates":[', k, '.0,', k, '.0]}}') END AS geometry,
       concat('[{{"externalId":', coalesce(to_json(id), 'null'), ',"consumerapplicationId":2}}]') AS external,
       123456 AS parent, concat('REF ', coalesce(p_amount_text, id, 'None')) AS code_reference, {len(_VALUES)} AS characteristics
FROM ({NAMED_SQL})""",
    "B6_code_reference": f"""
SELECT k, concat('REF ', coalesce(CASE WHEN trim(amount_text) <> '' THEN amount_text END, id, 'None')) AS with_hash,
       concat('REF ', coalesce(id, 'None')) AS without_hash FROM ({_RAW})""",
    "B7_unbuildable_rows": f"""
SELECT k, CASE WHEN wrong THEN 'invalid_type' END AS code,
       CASE WHEN wrong THEN 'Value of P_amount is no integer' END AS message,
       CASE WHEN NOT wrong THEN concat('"', amount_text, '"') END AS value
FROM (SELECT *, NOT regexp_full_match(amount_text, '[0-9]+') AS wrong FROM ({_RAW}))""",
    "Q1_quarantine_records": f"""
SELECT 'run-1' AS run_id, 'DEV' AS environment, 'PARTY' AS template_code, 'standardization' AS stage, code AS error_code,
       CASE code WHEN 'invalid_type' THEN 'One or more fields contain values with an invalid type.'
                 WHEN 'required_field_missing' THEN 'One or more mandatory fields contain null values.'
                 WHEN 'duplicated_id' THEN 'Duplicated ID found.' ELSE 'Geometry is invalid.' END AS error_message,
       CAST(json_object('k', k, 'id', id, 'name', name, 'segment', p_segment) AS VARCHAR) AS asset, id AS source_id,
       CAST(NULL AS VARCHAR) AS code_reference, field AS field_name
FROM ({reject_sql(NAMED_SQL)}) WHERE code IS NOT NULL""",
    "Q1_default_reason": """
SELECT CAST(s_suppkey AS VARCHAR) AS source_id, s_name AS code_reference, 'serialization' AS stage, 'invalid_type' AS error_code,
       'no payload' AS error_message, CAST(json_object('id', s_suppkey, 'codeReference', s_name) AS VARCHAR) AS asset,
       CAST(NULL AS VARCHAR) AS field_name FROM supplier""",
    "Q2_batch_records": f"""
SELECT 'ORDER' AS template_code, 'upload' AS stage, 'dmd_rejected_asset' AS error_code, answer AS error_message,
       {_ORDER_PAYLOAD} AS asset, CAST(NULL AS VARCHAR) AS source_id, concat('REF ', source_id) AS code_reference
FROM ({_ROUTED}) WHERE outcome = 'rejected'""",
    "Q3_record_schema": f"""
SELECT id AS source_id, 36 AS id_length, true AS has_time FROM ({reject_sql(NAMED_SQL)}) WHERE code IS NOT NULL""",
    "Q5_failure_day": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders",
    "K4_batch_assembly": f"""
SELECT true AS counted, true AS fits, source_id, concat('REF ', source_id) AS code_reference, {_ORDER_PAYLOAD} AS payload
FROM ({_ROUTED})""",
    "K4_outcome_routing": f"SELECT batch_id, source_id, outcome, answer FROM ({_ROUTED})",
}
