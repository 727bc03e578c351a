"""Inputs derived from the given tables.

The expressions are plain SQL that Spark and DuckDB read alike, so a query and its SQL twin start from the same rows.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.geometry import make_geometry
from plumbline.operators.payload import Template
from plumbline.operators.privacy import Privacy
from plumbline.operators.skew import shared_folder
from plumbline.operators.validate import Rules

_numbers = itertools.count()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame) -> DataFrame:
    """Narrow rows dealt out over the shuffle partitions, for work that is little to read and much to compute: a small file is one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh place in the shared folder for a query that writes."""
    return f"{shared_folder(spark)}/registry/{spark.sparkContext.applicationId}/{next(_numbers)}/{name}"


def selected(spark: SparkSession, sf_dir: str, name: str, columns: dict[str, str]) -> DataFrame:
    return table(spark, sf_dir, name).selectExpr(*[f"{sql} AS {alias}" for alias, sql in columns.items()])


def select_sql(name: str, columns: dict[str, str]) -> str:
    return f"SELECT {', '.join(f'{sql} AS {alias}' for alias, sql in columns.items())} FROM {name}"


def party_columns(letter: str, key: str, name: str, balance: str, extra: dict[str, str]) -> dict[str, str]:
    """A source table of the party template, with missing names and ids, duplicates and uncastable text."""
    return {
        "k": key,
        "id": f"CASE WHEN {key} % 41 = 0 THEN NULL WHEN {key} % 53 = 0 THEN 'dup' "
              f"ELSE concat('{letter}', CAST({key} AS STRING)) END",
        "name": f"CASE WHEN {key} % 17 = 0 THEN NULL WHEN {key} % 19 = 0 THEN '   ' ELSE {name} END",
        "amount_text": f"CASE WHEN {key} % 23 = 0 THEN 'n/a' WHEN {key} % 29 = 0 THEN '' WHEN {key} % 31 = 0 THEN '3.7' "
                       f"WHEN {key} % 37 = 0 THEN '3000000000' ELSE CAST({key} AS STRING) END",
        "flag_text": f"CASE WHEN {key} % 47 = 0 THEN 'maybe' WHEN {key} % 4 = 0 THEN 'true' WHEN {key} % 4 = 1 THEN 'no' "
                     f"WHEN {key} % 4 = 2 THEN 'Y' ELSE '  ' END",
        "day_text": f"CASE WHEN {key} % 59 = 0 THEN 'soon' WHEN {key} % 3 = 0 THEN NULL "
                    f"ELSE concat('2024-03-1', CAST({key} % 10 AS STRING)) END",
        "balance": balance,
        **extra,
    }


CUSTOMER = party_columns("C", "c_custkey", "c_name", "c_acctbal", {"segment": "c_mktsegment"})
SUPPLIER = party_columns("S", "s_suppkey", "s_name", "s_acctbal", {})
PARTY_SOURCES = {"customer": CUSTOMER, "supplier": SUPPLIER}

PARTY_CORE = ("id", "name")
PARTY_CHARACTERISTICS = (
    {"code": "P_amount", "name": "Amount", "type": "integer"},
    {"code": "P_amount_text", "name": "Amount - text", "type": "string"},
    {"code": "P_flag", "name": "Flag", "type": "boolean"},
    {"code": "P_day", "name": "First Day", "type": "date"},
    {"code": "P_balance", "name": "Balance", "type": "double"},
    {"code": "P_segment", "name": "Market Segment", "type": "maindata"},
    {"code": "P_zone", "name": None, "type": "string"},
    {"code": "P_later", "name": "Later", "type": "date"},
)
PARTY_MAPPING = {
    "P_amount": {"field": "amount_text", "default_value": 7},
    "P_amount_text": {"field": "amount_text", "default_value": None},
    "P_flag": {"field": "flag_text", "default_value": "no"},
    "P_day": {"field": "day_text", "default_value": None},
    "P_balance": {"field": "balance", "default_value": None},
    "P_segment": {"field": "segment", "default_value": "none"},
    "P_zone": {"field": "zone", "default_value": "UTC"},
}
PARTY = Template(id=42, code="PARTY", characteristics=PARTY_CHARACTERISTICS)
PARTY_RULES = Rules(core_fields=("id", "name", "geom"), mandatory=("id", "name"), id_column="id", geometry_column="geom")
PRIVACY = Privacy(salt="pepper", dx=10.0, dy=-5.0, text_columns=("name", "P_segment"), geometry_columns=("geom",))

_KNOWN_FLAG = "lower(flag_text) IN ('true', 'y', 'no')"


def party_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return selected(spark, sf_dir, name, PARTY_SOURCES[name])


def party_sql(name: str) -> str:
    """Standardised rows of one party table as SQL, with day and invalid codes as text."""
    raw = select_sql(name, PARTY_SOURCES[name])
    segment = "coalesce(segment, 'none')" if name == "customer" else "'none'"
    return f"""
SELECT k, id, name, '{name}' AS source,
       CASE WHEN trim(amount_text) = '' THEN 7 ELSE amount END AS p_amount,
       nullif(trim(amount_text), '') AS p_amount_text,
       CASE WHEN trim(flag_text) = '' THEN 'false' WHEN lower(flag_text) IN ('true', 'y') THEN 'true'
            WHEN lower(flag_text) = 'no' THEN 'false' END AS p_flag,
       CASE WHEN day_text LIKE '2024%' THEN concat(day_text, 'T00:00:00') END AS p_day,
       balance AS p_balance, {segment} AS p_segment, 'UTC' AS p_zone, CAST(NULL AS VARCHAR) AS p_later,
       concat_ws(',', CASE WHEN trim(amount_text) <> '' AND amount IS NULL THEN 'P_amount' END,
                      CASE WHEN trim(flag_text) <> '' AND NOT {_KNOWN_FLAG} THEN 'P_flag' END,
                      CASE WHEN day_text = 'soon' THEN 'P_day' END) AS invalid
FROM (SELECT *, TRY_CAST(regexp_extract(trim(amount_text), '^([+-]?[0-9]+)([.][0-9]*)?$', 1) AS INTEGER) AS amount
      FROM ({raw}))"""


PARTIES_SQL = f"{party_sql('customer')} UNION ALL {party_sql('supplier')}"
NAMED_SQL = f"SELECT * REPLACE (CASE WHEN trim(name) <> '' THEN name ELSE id END AS name) FROM ({PARTIES_SQL})"
POINT_SQL = "CASE WHEN k % 43 <> 0 THEN k END"


def reject_sql(rows: str, bad_geometry: str = "FALSE") -> str:
    """Reject code and field of standardised rows (columns id, name, invalid), rules in order."""
    return f"""
SELECT *, CASE WHEN invalid <> '' THEN 'invalid_type' WHEN id IS NULL OR name IS NULL THEN 'required_field_missing'
               WHEN n > 1 THEN 'duplicated_id' WHEN {bad_geometry} THEN 'invalid_geometry' END AS code,
       CASE WHEN invalid <> '' THEN invalid
            WHEN id IS NULL OR name IS NULL THEN concat_ws(',', CASE WHEN id IS NULL THEN 'id' END,
                                                                CASE WHEN name IS NULL THEN 'name' END)
            WHEN n > 1 THEN 'id' WHEN {bad_geometry} THEN 'geom' END AS field
FROM (SELECT *, sum(CASE WHEN invalid = '' AND id IS NOT NULL AND name IS NOT NULL THEN 1 ELSE 0 END)
                OVER (PARTITION BY id) AS n FROM ({rows}))"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point per order, without geometry for every 43rd."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    xy = F.array(F.col("o_custkey").cast("double"), F.col("o_orderkey").cast("double"))
    parts = F.when(F.col("o_orderkey") % 43 != 0, F.array(F.array(F.array(xy))))
    return orders.select("o_orderkey", "o_custkey", make_geometry("Point", parts).alias("geom"))


# Corner offsets: a unit square, a bow-tie for every 7th part; every 11th ring is left open.
_CORNERS = ((0, 0), (1, 0), (1, 1), (0, 1))
_BOW_TIE = ((0, 0), (1, 1), (1, 0), (0, 1))


def rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A polygon per part at (partkey, size)."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    x, y = F.col("p_partkey"), F.col("p_size")

    def ring(corners):
        return F.array(*[F.array((x + dx).cast("double"), (y + dy).cast("double")) for dx, dy in corners])

    corners = F.when(x % 7 == 0, ring(_BOW_TIE)).otherwise(ring(_CORNERS))
    closed = F.when(x % 11 == 0, corners).otherwise(F.concat(corners, F.slice(corners, 1, 1)))
    return part.select("p_partkey", "p_size", make_geometry("Polygon", F.array(F.array(closed))).alias("geom"))


RING_VERTICES_SQL = """
SELECT p_partkey, p_size, i, CAST(p_partkey + CASE WHEN p_partkey % 7 = 0 THEN [0, 1, 1, 0, 0][i]
                                      ELSE [0, 1, 1, 0, 0][i] END AS DOUBLE) AS x,
       CAST(p_size + CASE WHEN p_partkey % 7 = 0 THEN [0, 1, 0, 1, 0][i] ELSE [0, 0, 1, 1, 0][i] END AS DOUBLE) AS y
FROM part, (SELECT unnest([1, 2, 3, 4, 5]) AS i) WHERE i < 5 OR p_partkey % 11 <> 0"""
