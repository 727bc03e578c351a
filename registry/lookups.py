"""S7, S8, J3, J4: master-data and tag indexes and the joins that use them."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators.lookup import attach_signals, masterdata_id, masterdata_ids, masterdata_index, tag_index
from plumbline.sources.metadata import masterdata_relations, tag_catalogue
from registry.inputs import scratch, table


def part_relations(spark, sf_dir):
    """One master-data entry per part: found under brand and type, with the part as its only relation."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("entry_pos"), F.col("p_brand").alias("code"), F.col("p_type").alias("name"),
        F.when(F.col("p_partkey") % 5 != 0, F.lit(0)).alias("rel_pos"), F.col("p_name").alias("value"),
        F.col("p_partkey").alias("id"),
    )


def nation_relations(spark, sf_dir):
    """Regions as master-data entries, their nations as relations."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("r_regionkey").alias("entry_pos"), F.concat(F.lit("R"), F.col("r_regionkey")).alias("code"),
        F.col("r_name").alias("name"), F.col("n_nationkey").alias("rel_pos"), F.col("n_name").alias("value"),
        F.col("n_nationkey").cast("bigint").alias("id"),
    )


def tags(spark, sf_dir):
    """Event ids as tags of their users; every 50th has no uid."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("name"),
        F.when(F.col("event_id") % 50 != 0, F.col("event_id").cast("string")).alias("uid"), F.col("event_id").alias("pos"),
    )


def nation_of_customers(spark, sf_dir):
    """Customers with a nation name to look up, some unknown, unlisted or missing."""
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))  # 25 rows by definition
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", F.expr(
        "CASE WHEN c_custkey % 13 = 0 THEN 'Unknown' WHEN c_custkey % 11 = 0 THEN 'nowhere' "
        "WHEN c_custkey % 7 = 0 THEN NULL ELSE n_name END").alias("nation"))


def masterdata(spark, sf_dir):
    return masterdata_index(part_relations(spark, sf_dir))


def tag_lists(spark, sf_dir):
    return tag_index(tags(spark, sf_dir)).select("name", F.array_join("uids", "|").alias("uids"))


def nation_ids(spark, sf_dir, **bound):
    index = masterdata_index(nation_relations(spark, sf_dir), **bound)
    df = nation_of_customers(spark, sf_dir)
    for region in ("R1", "ASIA"):
        df = masterdata_id(df, "nation", index, region, region.lower(), F.xxhash64("c_custkey"), **bound)
    return df.select("c_custkey", "nation", F.col("r1").cast("string").alias("r1"), F.col("asia").cast("string").alias("asia"))


def signals(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    found = attach_signals(customer, tags(spark, sf_dir), "id")
    text = F.array_join(F.transform("signals", lambda s: F.concat_ws(":", s["type"], s["name"], s["uid"])), "|")
    return found.select("id", F.size("signals").alias("n"), text.alias("signals"))


def nation_ids_large(spark, sf_dir):
    """The way taken when an index does not fit a broadcast."""
    return nation_ids(spark, sf_dir, max_bytes=-1)


def signals_crowded(spark, sf_dir):
    """One customer owns a third of all tags and still gets one row with the whole list; the lists are too large to broadcast."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    crowded = tags(spark, sf_dir).withColumn("name", F.when(F.col("pos") % 3 == 0, F.lit("1")).otherwise(F.col("name")))
    return attach_signals(customer, crowded, "id", max_bytes=-1).select("id", F.array_join("signals.uid", "|").alias("uids"))


def nation_ids_columns(spark, sf_dir):
    """Two columns at once, beyond a broadcast: through the combinations of their values."""
    df = nation_of_customers(spark, sf_dir).withColumns({"R1": F.col("nation"), "ASIA": F.when(F.col("c_custkey") % 5 != 0, F.col("nation"))})
    found = masterdata_ids(df, {"R1": "id_r1", "ASIA": "id_asia"}, masterdata_index(nation_relations(spark, sf_dir)), max_bytes=-1)
    return found.select("c_custkey", "nation", F.col("id_r1").alias("r1"), F.col("id_asia").alias("asia"))


def tags_from_lines(spark, sf_dir):
    """The tags written as JSON Lines in the order of events and read back: positions are 0, 1, 2, ... again."""
    folder = scratch(spark, "tags")
    lines = tags(spark, sf_dir).orderBy("pos").select(F.to_json(F.struct("name", "uid")).alias("value"))
    lines.write.text(folder)
    return tag_catalogue(spark, folder, lines=True)


def masterdata_from_lines(spark, sf_dir):
    """The index of master data that were written as JSON Lines, an entry for each part, and read back."""
    folder = scratch(spark, "masterdata")
    own = F.array(F.struct(F.col("value").alias("name"), "id"))
    relations = F.when(F.col("rel_pos").isNotNull(), own).otherwise(F.filter(own, lambda _: F.lit(False)))
    entries = part_relations(spark, sf_dir).orderBy("entry_pos").select("code", "name", relations.alias("relations"))
    entries.select(F.to_json(F.struct("code", "name", "relations")).alias("value")).write.text(folder)
    return masterdata_index(masterdata_relations(spark, folder, lines=True))


QUERIES = {
    "S7_masterdata_index": masterdata,
    "S8_tag_index": tag_lists,
    "J3_masterdata_lookup": nation_ids,
    "J3_masterdata_lookup_beyond_broadcast": nation_ids_large,
    "J3_masterdata_columns_beyond_broadcast": nation_ids_columns,
    "S7_masterdata_lines": masterdata_from_lines,
    "S8_tag_lines": tags_from_lines,
    "J4_signal_lists": signals,
    "J4_signal_lists_crowded": signals_crowded,
}

_TAGS = "SELECT CAST(user_id AS VARCHAR) AS name, CAST(event_id AS VARCHAR) AS uid, event_id AS pos FROM events WHERE event_id % 50 <> 0"


def _nation_id(condition):
    return f"CAST((SELECT max(n_nationkey) FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_name = nation_name AND {condition}) AS VARCHAR)"


_NATION_IDS = f"""
SELECT c_custkey, nation_name AS nation, {_nation_id("r_regionkey = 1")} AS r1, {_nation_id("r_name = 'ASIA'")} AS asia
FROM (SELECT c_custkey, CASE WHEN c_custkey % 13 = 0 THEN 'Unknown' WHEN c_custkey % 11 = 0 THEN 'nowhere'
                             WHEN c_custkey % 7 = 0 THEN NULL ELSE n_name END AS nation_name
      FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

_INDEX = """
WITH keyed AS (SELECT p_brand AS key, * FROM part UNION SELECT p_type AS key, * FROM part)
SELECT key, p_name AS value, p_partkey AS id FROM keyed
QUALIFY p_partkey = max(p_partkey) OVER (PARTITION BY key) AND p_partkey % 5 <> 0"""

ORACLES = {
    "S7_masterdata_index": _INDEX,
    "S7_masterdata_lines": _INDEX,
    "S8_tag_lines": """
SELECT CAST(user_id AS VARCHAR) AS name, CASE WHEN event_id % 50 <> 0 THEN CAST(event_id AS VARCHAR) END AS uid,
       row_number() OVER (ORDER BY event_id) - 1 AS pos FROM events""",
    "J3_masterdata_columns_beyond_broadcast": """
SELECT c_custkey, v AS nation, CASE WHEN n_regionkey = 1 THEN CAST(n_nationkey AS BIGINT) END AS r1,
       CASE WHEN r_name = 'ASIA' AND c_custkey % 5 <> 0 THEN CAST(n_nationkey AS BIGINT) END AS asia
FROM (SELECT c_custkey, CASE WHEN c_custkey % 13 = 0 THEN 'Unknown' WHEN c_custkey % 11 = 0 THEN 'nowhere'
                             WHEN c_custkey % 7 = 0 THEN NULL ELSE n_name END AS v
      FROM customer JOIN nation ON c_nationkey = n_nationkey)
LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey) ON n_name = v""",
    "S8_tag_index": f"SELECT name, string_agg(uid, '|' ORDER BY pos) AS uids FROM ({_TAGS}) GROUP BY name",
    "J3_masterdata_lookup": _NATION_IDS,
    "J3_masterdata_lookup_beyond_broadcast": _NATION_IDS,
    "J4_signal_lists_crowded": f"""
SELECT c_custkey AS id, coalesce(string_agg(uid, '|' ORDER BY pos), '') AS uids
FROM customer LEFT JOIN (SELECT CASE WHEN pos % 3 = 0 THEN '1' ELSE name END AS name, uid, pos FROM ({_TAGS})) ON name = CAST(c_custkey AS VARCHAR)
GROUP BY c_custkey""",
    "J4_signal_lists": f"""
SELECT c_custkey AS id, CAST(count(uid) AS INTEGER) AS n,
       coalesce(string_agg(concat('SIGNAL:', name, ':', uid), '|' ORDER BY pos) FILTER (WHERE uid IS NOT NULL), '') AS signals
FROM customer LEFT JOIN ({_TAGS}) ON name = CAST(c_custkey AS VARCHAR) GROUP BY c_custkey""",
}
