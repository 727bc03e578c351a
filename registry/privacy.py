"""A: pseudonyms, hidden columns, and their place before validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.text import pseudonym
from plumbline.operators.privacy import pseudonymise
from plumbline.operators.project import fill_name
from plumbline.operators.validate import classify, split
from registry.inputs import CUSTOMER, NAMED_SQL, PARTY_RULES, PRIVACY, party_raw, points, reject_sql, select_sql
from registry.shaping import unified


def with_points(df):
    """Party rows with a point at (k, k), none for every 43rd."""
    from plumbline.functions.geometry import make_geometry

    xy = F.array(F.col("k").cast("double"), F.col("k").cast("double"))
    parts = F.when(F.col("k") % 43 != 0, F.array(F.array(F.array(xy))))
    return df.withColumn("geom", make_geometry("Point", parts))


def pseudonyms(spark, sf_dir):
    return party_raw(spark, sf_dir, "customer").select("k", pseudonym(F.col("name"), "pepper").alias("name"))


def hidden(spark, sf_dir):
    df = pseudonymise(with_points(fill_name(unified(spark, sf_dir))), PRIVACY)
    return df.select(
        "k", "id", "name", F.col("P_segment").alias("segment"),
        F.coalesce(F.col("geom.parts")[0][0][0][0], F.lit(-1.0)).alias("x"),
        F.coalesce(F.col("geom.parts")[0][0][0][1], F.lit(-1.0)).alias("y"),
    )


def hidden_rejects(spark, sf_dir):
    df = pseudonymise(with_points(fill_name(unified(spark, sf_dir))), PRIVACY)
    _, rejected = split(classify(df, PARTY_RULES))
    return rejected.select("k", F.col("reject.code").alias("code"), "name", F.col("P_segment").alias("segment"))


def moved_points(spark, sf_dir):
    """Every order, also those without a geometry."""
    moved = pseudonymise(points(spark, sf_dir), PRIVACY)
    point = F.col("geom.parts")[0][0][0]
    return moved.select("o_orderkey", point[0].alias("x"), point[1].alias("y"))


QUERIES = {
    "A1_pseudonym": pseudonyms,
    "A2_pseudonymise_columns": hidden,
    "A2_pseudonymise_geometry": moved_points,
    "A3_hidden_before_validation": hidden_rejects,
}


def _hash(column):
    return (f"CASE WHEN trim({column}) <> '' THEN concat('ANON_', substr(sha256(concat('pepper|', lower(trim({column})))), 1, 16)) "
            f"ELSE {column} END")


ORACLES = {
    "A1_pseudonym": f"SELECT k, {_hash('name')} AS name FROM ({select_sql('customer', CUSTOMER)})",
    "A2_pseudonymise_columns": f"""
SELECT k, id, {_hash('name')} AS name, {_hash('p_segment')} AS segment,
       CAST(CASE WHEN k % 43 <> 0 THEN k + 10 ELSE -1 END AS DOUBLE) AS x,
       CAST(CASE WHEN k % 43 <> 0 THEN k - 5 ELSE -1 END AS DOUBLE) AS y FROM ({NAMED_SQL})""",
    "A2_pseudonymise_geometry": """
SELECT o_orderkey, CASE WHEN o_orderkey % 43 <> 0 THEN CAST(o_custkey + 10 AS DOUBLE) END AS x,
       CASE WHEN o_orderkey % 43 <> 0 THEN CAST(o_orderkey - 5 AS DOUBLE) END AS y FROM orders""",
    "A3_hidden_before_validation": f"""
SELECT k, code, {_hash('name')} AS name, {_hash('p_segment')} AS segment FROM ({reject_sql(NAMED_SQL)}) WHERE code IS NOT NULL""",
}
