"""P and U: projection, casts, defaults, union, names."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.casting import blank_to_null, default_literal, safe_cast
from plumbline.functions.text import timestamp_text
from plumbline.operators.project import INVALID_FIELDS, fill_name, project_to_template, union_tables
from registry.inputs import (
    CUSTOMER, NAMED_SQL, PARTIES_SQL, PARTY_CHARACTERISTICS, PARTY_CORE, PARTY_MAPPING, dealt, party_raw, party_sql,
    select_sql, table,
)

TEXT = T.StringType()


def projected(spark, sf_dir, name, core=("k", *PARTY_CORE), codes=None):
    """One party table projected to the template, or to some of its characteristics."""
    wanted = [c for c in PARTY_CHARACTERISTICS if codes is None or c["code"] in codes]
    return project_to_template(party_raw(spark, sf_dir, name), core, wanted, PARTY_MAPPING)


def unified(spark, sf_dir):
    return union_tables([projected(spark, sf_dir, "customer"), projected(spark, sf_dir, "supplier")])


def shown(df):
    """Projected rows with text in place of nullable and nested values."""
    return df.select(
        "k", "id", "name", F.col("P_amount").cast("string").alias("p_amount"), F.col("P_amount_text").alias("p_amount_text"),
        F.col("P_flag").cast("string").alias("p_flag"), timestamp_text(F.col("P_day")).alias("p_day"),
        F.col("P_balance").alias("p_balance"), F.col("P_segment").alias("p_segment"), F.col("P_zone").alias("p_zone"),
        F.col("P_later").cast("string").alias("p_later"), F.concat_ws(",", INVALID_FIELDS).alias("invalid"),
    )


SHOWN_SQL = ("k, id, name, CAST(p_amount AS VARCHAR) AS p_amount, p_amount_text, p_flag, p_day, p_balance, p_segment, "
             "p_zone, p_later, invalid")


def template_projection(spark, sf_dir):
    return shown(projected(spark, sf_dir, "customer"))


WIDE_SOURCES, WIDE_KINDS = 60, [("integer", None), ("double", None), ("string", None), ("integer", 7), ("double", 0.5)]
_WIDE_TEXT = "CASE WHEN (c_custkey + {k}) % 11 = 0 THEN ' ' WHEN (c_custkey + {k}) % 7 = 0 THEN 'x' ELSE CAST(c_custkey + {k} AS {text}) END"


def wide_projection(spark, sf_dir):
    """A template of 300 characteristics: 60 source fields of digits, other text and blanks, each under five of them."""
    codes = [(f"w{n}_{k}", k, kind, default) for n, (kind, default) in enumerate(WIDE_KINDS) for k in range(WIDE_SOURCES)]
    raw = dealt(table(spark, sf_dir, "customer").select("c_custkey")).selectExpr("c_custkey AS id", *[f"{_WIDE_TEXT.format(k=k, text='string')} AS s{k}" for k in range(WIDE_SOURCES)])
    mapping = {code: {"field": f"s{k}", "default_value": default} for code, k, _, default in codes}
    wide = project_to_template(raw, ["id"], [{"code": code, "type": kind} for code, _, kind, _ in codes], mapping)
    values = F.concat_ws("|", *[F.coalesce(F.col(code).cast("string"), F.lit("-")) for code, *_ in codes])
    return wide.select("id", values.alias("told"), F.concat_ws(",", INVALID_FIELDS).alias("invalid"))


def wide_sql():
    told, invalid = [], []
    for n, (kind, default) in enumerate(WIDE_KINDS):
        for k in range(WIDE_SOURCES):
            text = f"({_WIDE_TEXT.format(k=k, text='VARCHAR')})"
            cast = f"nullif({text}, ' ')" if kind == "string" else f"TRY_CAST({text} AS {kind})"
            told.append(f"coalesce(CAST(CASE WHEN {text} = ' ' THEN {'NULL' if default is None else default} ELSE {cast} END AS VARCHAR), '-')")
            if kind != "string":
                invalid.append(f"CASE WHEN {text} = 'x' THEN 'w{n}_{k}' END")
    return f"SELECT c_custkey AS id, concat_ws('|', {', '.join(told)}) AS told, concat_ws(',', {', '.join(invalid)}) AS invalid FROM customer"


def safe_casts(spark, sf_dir):
    raw = party_raw(spark, sf_dir, "customer")
    day = timestamp_text(F.expr(safe_cast("day_text", TEXT, "date")))
    return raw.select("k", day.alias("as_date"), *[F.expr(e) for e in (
        f"CAST({safe_cast('amount_text', TEXT, 'integer')} AS string) AS as_integer",
        f"coalesce({safe_cast('amount_text', TEXT, 'double')}, -1D) AS as_double",
        f"CAST({safe_cast('flag_text', TEXT, 'boolean')} AS string) AS as_boolean",
        f"{safe_cast('k', T.LongType(), 'string')} AS as_string",
        f"CAST({safe_cast('balance', T.DoubleType(), 'integer')} AS string) AS cut",
    )])


def default_literals(spark, sf_dir):
    return party_raw(spark, sf_dir, "customer").select(
        "k",
        F.expr(default_literal(42, "integer")).alias("whole"),
        F.expr(default_literal(2.5, "double")).alias("number"),
        F.expr(default_literal("yes", "boolean")).cast("string").alias("flag"),
        timestamp_text(F.expr(default_literal("2022-01-01", "date"))).alias("day"),
        F.expr(default_literal(None, "maindata")).alias("none"),
        F.expr(default_literal(9, "string")).alias("text"),
    )


def blanks(spark, sf_dir):
    raw = party_raw(spark, sf_dir, "customer")
    return raw.select("k", F.expr(blank_to_null("name", TEXT)).alias("name"), F.expr(blank_to_null("flag_text")).alias("flag"))


def invalid_types(spark, sf_dir):
    df = unified(spark, sf_dir)
    return df.select("k", F.concat_ws(",", INVALID_FIELDS).alias("invalid"), F.size(INVALID_FIELDS).alias("n"))


def unmapped(spark, sf_dir):
    df = projected(spark, sf_dir, "customer", codes=["P_later"])
    return df.select("k", F.col("P_later").cast("string").alias("later"), F.typeof("P_later").alias("later_type"))


def absent_default(spark, sf_dir):
    df = projected(spark, sf_dir, "supplier", codes=["P_zone", "P_segment"])
    return df.select("k", F.col("P_zone").alias("zone"), F.col("P_segment").alias("segment"))


def default_fill(spark, sf_dir):
    df = projected(spark, sf_dir, "customer", codes=["P_amount", "P_flag"])
    return df.select("k", F.col("P_amount").cast("string").alias("amount"), F.col("P_flag").cast("string").alias("flag"))


def core_backfill(spark, sf_dir):
    df = projected(spark, sf_dir, "supplier", core=("k", "id", "name", "segment"), codes=[])
    return df.select("k", "id", "name", "segment")


def shared_source(spark, sf_dir):
    df = projected(spark, sf_dir, "customer", codes=["P_amount", "P_amount_text"])
    return df.select("k", F.col("P_amount").cast("string").alias("amount"), F.col("P_amount_text").alias("amount_text"))


def name_fill(spark, sf_dir):
    return fill_name(unified(spark, sf_dir)).select("k", "id", "name")


def union(spark, sf_dir):
    return shown(unified(spark, sf_dir))


QUERIES = {
    "P1_template_projection": template_projection,
    "P1_wide_template": wide_projection,
    "P3_safe_cast": safe_casts,
    "P4_default_literal": default_literals,
    "P5_blank_to_null": blanks,
    "P6_invalid_types": invalid_types,
    "P7_unmapped_characteristic": unmapped,
    "P8_absent_column_default": absent_default,
    "P9_default_fill": default_fill,
    "P10_core_backfill": core_backfill,
    "P11_shared_source": shared_source,
    "P12_name_fill": name_fill,
    "U1_union_tables": union,
}

_RAW = select_sql("customer", CUSTOMER)

ORACLES = {
    "P1_wide_template": wide_sql(),
    "P1_template_projection": f"SELECT {SHOWN_SQL} FROM ({party_sql('customer')})",
    "P3_safe_cast": f"""
SELECT k, CAST(TRY_CAST(regexp_extract(trim(amount_text), '^([+-]?[0-9]+)([.][0-9]*)?$', 1) AS INTEGER) AS VARCHAR) AS as_integer,
       coalesce(TRY_CAST(nullif(amount_text, '') AS DOUBLE), -1.0) AS as_double,
       CASE WHEN lower(flag_text) IN ('true', 'y') THEN 'true' WHEN lower(flag_text) = 'no' THEN 'false' END AS as_boolean,
       CASE WHEN day_text LIKE '2024%' THEN concat(day_text, 'T00:00:00') END AS as_date,
       CAST(k AS VARCHAR) AS as_string, CAST(CAST(trunc(balance) AS INTEGER) AS VARCHAR) AS cut
FROM ({_RAW})""",
    "P4_default_literal": """
SELECT c_custkey AS k, 42 AS whole, CAST(2.5 AS DOUBLE) AS number, 'true' AS flag, '2022-01-01T00:00:00' AS day,
       CAST(NULL AS VARCHAR) AS "none", '9' AS text FROM customer""",
    "P5_blank_to_null": f"""
SELECT k, CASE WHEN trim(name) <> '' THEN name END AS name, CASE WHEN trim(flag_text) <> '' THEN flag_text END AS flag
FROM ({_RAW})""",
    "P6_invalid_types": f"""
SELECT k, invalid, CAST(len(list_filter(string_split(invalid, ','), lambda x: x <> '')) AS INTEGER) AS n
FROM ({PARTIES_SQL})""",
    "P7_unmapped_characteristic":
        "SELECT c_custkey AS k, CAST(NULL AS VARCHAR) AS later, 'timestamp' AS later_type FROM customer",
    "P8_absent_column_default": "SELECT s_suppkey AS k, 'UTC' AS zone, 'none' AS segment FROM supplier",
    "P9_default_fill": f"""
SELECT k, CAST(p_amount AS VARCHAR) AS amount, p_flag AS flag FROM ({party_sql('customer')})""",
    "P10_core_backfill": f"SELECT k, id, name, CAST(NULL AS VARCHAR) AS segment FROM ({party_sql('supplier')})",
    "P11_shared_source": f"""
SELECT k, CAST(p_amount AS VARCHAR) AS amount, p_amount_text AS amount_text FROM ({party_sql('customer')})""",
    "P12_name_fill": f"SELECT k, id, name FROM ({NAMED_SQL})",
    "U1_union_tables": f"SELECT {SHOWN_SQL} FROM ({PARTIES_SQL})",
}
