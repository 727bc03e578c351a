"""V, J1, J2, AG, U2: validation rules, duplicate joins, counts and gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.text import is_usable
from plumbline.operators.metrics import failing_gate, outcome_counts, roll_up, roll_up_reasons, with_ratio
from plumbline.operators.project import INVALID_FIELDS, fill_name
from plumbline.operators.validate import (
    Rules, any_null, classify, duplicate_keys, has_invalid_types, mark_duplicates, null_fields, split,
)
from registry.inputs import NAMED_SQL, PARTIES_SQL, PARTY_RULES, dealt, reject_sql, rings, table
from registry.privacy import with_points
from registry.shaping import projected, unified

LINE_ID = "concat_ws('-', l_orderkey, l_linenumber)"


def lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(f"{LINE_ID} AS id", "l_partkey", "l_suppkey")


def party_classified(spark, sf_dir):
    return classify(with_points(fill_name(dealt(unified(spark, sf_dir)))), PARTY_RULES)


def reject_counts(spark, sf_dir):
    code = F.coalesce(F.col("reject.code"), F.lit("ok")).alias("code")
    return party_classified(spark, sf_dir).groupBy(code).agg(F.count(F.lit(1)).alias("n"))


def type_rule(spark, sf_dir):
    bad = unified(spark, sf_dir).filter(has_invalid_types())
    return bad.select("k", F.concat_ws(",", INVALID_FIELDS).alias("field"))


def mandatory_rule(spark, sf_dir):
    fields = ["id", "name"]
    return unified(spark, sf_dir).filter(any_null(fields)).select("k", F.expr(null_fields(fields)).alias("field"))


def duplicate_rule(spark, sf_dir):
    return mark_duplicates(lines(spark, sf_dir), "id")


def duplicate_rule_large(spark, sf_dir):
    """The way taken when the duplicated ids do not fit a broadcast."""
    return mark_duplicates(lines(spark, sf_dir), "id", max_bytes=-1)


def geometry_rule(spark, sf_dir):
    df = rings(spark, sf_dir).withColumnRenamed("p_partkey", "id")
    done = classify(df, Rules(core_fields=("id",), mandatory=(), id_column="id", geometry_column="geom"))
    return done.select("id", F.col("reject.code").alias("code"), F.col("reject.field").alias("field"))


def classification(spark, sf_dir):
    return party_classified(spark, sf_dir).select(
        "k", "id", "name", F.col("reject.code").alias("code"), F.col("reject.field").alias("field")
    )


def usable(spark, sf_dir):
    value = F.expr("CASE WHEN event_id % 13 = 0 THEN CAST('NaN' AS DOUBLE) WHEN event_id % 7 = 0 THEN NULL ELSE value END")
    return table(spark, sf_dir, "events").select("event_id", is_usable(value, floating=True).alias("usable"))


def dropped_internal(spark, sf_dir):
    valid, rejected = split(party_classified(spark, sf_dir))
    sides = []
    for name, side in (("valid", valid), ("rejected", rejected)):
        columns = ",".join(c for c in side.columns if c != "reject")
        sides.append(side.select("k", F.lit(name).alias("side"), F.lit(columns).alias("columns")))
    return sides[0].unionByName(sides[1])


def duplicate_side(spark, sf_dir):
    return duplicate_rule(spark, sf_dir).filter("is_duplicate").drop("is_duplicate")


def single_side(spark, sf_dir):
    return duplicate_rule(spark, sf_dir).filter("NOT is_duplicate").drop("is_duplicate")


def duplicate_groups(spark, sf_dir):
    return duplicate_keys(lines(spark, sf_dir), "id")


def template_counts(spark, sf_dir):
    """Written and quarantined rows of the two party tables as templates of their own."""
    frames = [
        classify(with_points(fill_name(projected(spark, sf_dir, name))), PARTY_RULES).withColumn("template", F.lit(name))
        for name in ("customer", "supplier")
    ]
    return outcome_counts(frames[0].unionByName(frames[1]), ["template"])


def ratios(spark, sf_dir):
    return with_ratio(template_counts(spark, sf_dir))


def gate(spark, sf_dir):
    return failing_gate(template_counts(spark, sf_dir), 0.1)


def run_summary(spark, sf_dir):
    return roll_up(template_counts(spark, sf_dir))


def reason_rollup(spark, sf_dir):
    """Reasons by kind of source (the first letter of the id stands for the template), with totals; ids that tell no source are under '-'."""
    template = F.when(F.col("id").rlike("^[CS][0-9]"), F.substring("id", 1, 1)).otherwise("-")
    return roll_up_reasons(party_classified(spark, sf_dir).withColumn("template", template))


def rejected_rows(spark, sf_dir):
    _, rejected = split(party_classified(spark, sf_dir))
    return rejected.select(
        "k", F.col("reject.code").alias("code"), F.col("reject.message").alias("message"), F.col("reject.field").alias("field")
    )


QUERIES = {
    "V1_type_rule": type_rule,
    "V2_mandatory_rule": mandatory_rule,
    "V3_duplicate_ids": duplicate_rule,
    "V3_duplicate_ids_beyond_broadcast": duplicate_rule_large,
    "V4_geometry_rule": geometry_rule,
    "V5_classification": classification,
    "V5_reject_counts": reject_counts,
    "V6_usable_value": usable,
    "P13_internal_column_dropped": dropped_internal,
    "J1_duplicate_rows": duplicate_side,
    "J2_single_rows": single_side,
    "AG1_duplicate_groups": duplicate_groups,
    "AG2_template_counts": template_counts,
    "AG3_quarantine_ratio": ratios,
    "AG4_quality_gate": gate,
    "AG5_run_summary": run_summary,
    "AG5_rollup": reason_rollup,
    "U2_rejected_rows": rejected_rows,
}

_LINES = f"SELECT {LINE_ID} AS id, l_partkey, l_suppkey, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem"
_CODED = reject_sql(NAMED_SQL)


def _one_template(name):
    rows = f"SELECT * FROM ({NAMED_SQL}) WHERE source = '{name}'"
    return f"SELECT source AS template, code FROM ({reject_sql(rows)})"


_COUNTS = f"""
SELECT template, count(*) FILTER (WHERE code IS NULL) AS written, count(*) FILTER (WHERE code IS NOT NULL) AS quarantined
FROM ({_one_template('customer')} UNION ALL {_one_template('supplier')}) GROUP BY template"""
_RATIOS = f"SELECT *, written + quarantined AS total, quarantined / (written + quarantined) AS quarantine_ratio FROM ({_COUNTS})"
_COLUMNS = "k,id,name,P_amount,P_amount_text,P_flag,P_day,P_balance,P_segment,P_zone,P_later,geom"

ORACLES = {
    "V1_type_rule": f"SELECT k, invalid AS field FROM ({PARTIES_SQL}) WHERE invalid <> ''",
    "V2_mandatory_rule": f"""
SELECT k, concat_ws(',', CASE WHEN id IS NULL THEN 'id' END, CASE WHEN name IS NULL THEN 'name' END) AS field
FROM ({PARTIES_SQL}) WHERE id IS NULL OR name IS NULL""",
    "V3_duplicate_ids": f"SELECT id, l_partkey, l_suppkey, n > 1 AS is_duplicate FROM ({_LINES})",
    "V3_duplicate_ids_beyond_broadcast": f"SELECT id, l_partkey, l_suppkey, n > 1 AS is_duplicate FROM ({_LINES})",
    "V4_geometry_rule": """
SELECT p_partkey AS id, CASE WHEN p_partkey % 7 = 0 OR p_partkey % 11 = 0 THEN 'invalid_geometry' END AS code,
       CASE WHEN p_partkey % 7 = 0 OR p_partkey % 11 = 0 THEN 'geom' END AS field FROM part""",
    "V5_classification": f"SELECT k, id, name, code, field FROM ({_CODED})",
    "V5_reject_counts": f"SELECT coalesce(code, 'ok') AS code, count(*) AS n FROM ({_CODED}) GROUP BY ALL",
    "V6_usable_value": """
SELECT event_id, event_id % 13 <> 0 AND event_id % 7 <> 0 AND value IS NOT NULL AND NOT isnan(value) AS usable FROM events""",
    "P13_internal_column_dropped": f"""
SELECT k, CASE WHEN code IS NULL THEN 'valid' ELSE 'rejected' END AS side, '{_COLUMNS}' AS columns FROM ({_CODED})""",
    "J1_duplicate_rows": f"SELECT id, l_partkey, l_suppkey FROM ({_LINES}) WHERE n > 1",
    "J2_single_rows": f"SELECT id, l_partkey, l_suppkey FROM ({_LINES}) WHERE n = 1",
    "AG1_duplicate_groups": f"SELECT {LINE_ID} AS id, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "AG2_template_counts": _COUNTS,
    "AG3_quarantine_ratio": _RATIOS,
    "AG4_quality_gate": f"SELECT * FROM ({_RATIOS}) WHERE quarantine_ratio > 0.1",
    "AG5_run_summary": f"""
SELECT *, written + quarantined AS total, written / (written + quarantined) AS success_rate
FROM (SELECT CAST(sum(written) AS BIGINT) AS written, CAST(sum(quarantined) AS BIGINT) AS quarantined FROM ({_COUNTS}))""",
    "AG5_rollup": f"""
SELECT template, code, CASE grouping_id(template, code) WHEN 0 THEN 'reason' WHEN 1 THEN 'template' ELSE 'all' END AS level, count(*) AS n
FROM (SELECT coalesce(code, 'ok') AS code, CASE WHEN regexp_matches(id, '^[CS][0-9]') THEN substr(id, 1, 1) ELSE '-' END AS template FROM ({_CODED}))
GROUP BY ROLLUP (template, code)""",
    "U2_rejected_rows": f"""
SELECT k, code, CASE code WHEN 'invalid_type' THEN 'One or more fields contain values with an invalid type.'
                          WHEN 'required_field_missing' THEN 'One or more mandatory fields contain null values.'
                          WHEN 'duplicated_id' THEN 'Duplicated ID found.' ELSE 'Geometry is invalid.' END AS message, field
FROM ({_CODED}) WHERE code IS NOT NULL""",
}
