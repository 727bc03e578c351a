"""Registered queries of the operators on embeddings, conversations and manifests, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import cover_tree, merkle, zfast_trie


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all documents, their roots and proofs, and whether each document, some of them altered, still leads to the root."""

    def digest(n_chars: Column) -> Column:
        return merkle.record_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))

    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    records = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", digest(F.col("n_chars")).alias("leaf"), F.when(altered, digest(F.col("n_chars").cast("decimal(20,0)") + 1)).alias("tampered"))
    found = merkle.manifest(records)
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["before"], s["after"])), "")
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof"))
    found = found.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of ASCII text, bit by bit."""
    byte = "list_reduce(list_prepend(xor(a, x), range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda s: CAST(ascii(s) AS BIGINT))), lambda a, x: {byte}), 4294967295)"


def _field_sql(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _record_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field_sql(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"


#: Levels of both trees by recursion (g NULL-safe as a name), then each leaf climbs: its path is folded level by level.
MERKLE_SQL = f"""
WITH RECURSIVE leaf AS (
  SELECT doc_id, coalesce('+' || lang, '') AS g, {_record_sql('n_chars')} AS h,
         CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {_record_sql('n_chars + 1')} END AS altered
  FROM documents
), placed AS (
  SELECT doc_id, g, h, coalesce(altered, h) AS shown, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaf
), level AS (
  SELECT 0 AS k, g, pos, n, h FROM placed
  UNION ALL
  SELECT k + 1, g, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM level WHERE n > 1 GROUP BY k, g, pos // 2, n
), subroot AS (SELECT g, h, k AS height FROM level WHERE n = 1),
ranked AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM subroot),
upper AS (
  SELECT 0 AS k, pos, n, h FROM ranked
  UNION ALL
  SELECT k + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM upper WHERE n > 1 GROUP BY k, pos // 2, n
), climb AS (
  SELECT doc_id, h AS leaf, g, 0 AS k, pos, n, shown AS folded, '' AS seen FROM placed
  UNION ALL
  SELECT c.doc_id, c.leaf, c.g, c.k + 1, c.pos // 2, (c.n + 1) // 2,
         sha256(CASE WHEN s.h IS NULL THEN c.folded WHEN c.pos % 2 = 1 THEN s.h || c.folded ELSE c.folded || s.h END), c.seen || coalesce(s.h, '')
  FROM climb c LEFT JOIN level s ON s.k = c.k AND s.g = c.g AND s.pos = xor(c.pos, 1) WHERE c.n > 1
), higher AS (
  SELECT c.doc_id, c.leaf, r.h AS subroot, 0 AS k, r.pos, r.n, c.folded, c.seen FROM climb c JOIN ranked r ON r.g = c.g WHERE c.n = 1
  UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, c.k + 1, c.pos // 2, (c.n + 1) // 2,
         sha256(CASE WHEN s.h IS NULL THEN c.folded WHEN c.pos % 2 = 1 THEN s.h || c.folded ELSE c.folded || s.h END), c.seen || coalesce(s.h, '')
  FROM higher c LEFT JOIN upper s ON s.k = c.k AND s.pos = xor(c.pos, 1) WHERE c.n > 1
)
SELECT doc_id, leaf, subroot, top.h AS root, sha256(seen) AS proof_sha256, folded AS folded_root, folded = top.h AS verified
FROM higher, (SELECT h FROM upper WHERE n = 1) top WHERE higher.n = 1
"""


#: Turns of a base conversation that a rebuilt one can begin with.
LONGEST_START = 8


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Each conversation c from the first h turns of conversation c - c % 5 and its own turns after its first h."""
    own = zfast_trie.turn_lists(conversations)
    starts = own.select(F.col("conv_id").alias("base"), F.slice("turns", 1, LONGEST_START).alias("start"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (LONGEST_START + 1)).cast("int")
    found = own.join(starts, F.col("conv_id") - F.col("conv_id") % 5 == F.col("base"), "left")
    begun = F.when(F.col("start").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("start", F.lit(1), h))
    return found.select("conv_id", F.concat(begun, F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    found = zfast_trie.trie(rebuilt(table(spark, sf_dir, "conversations")))
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


TRIE_SQL = f"""
WITH turned AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), marked AS (SELECT *, substr(sha256(CAST(strlen(role) AS VARCHAR) || ':' || role || text), 1, 32) AS digest FROM turned),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS k FROM marked),
conv AS (SELECT DISTINCT conv_id, {crc32_sql('CAST(conv_id AS VARCHAR)')} % 9 AS h FROM own),
joined AS (
  SELECT c.conv_id, o.k, o.digest, strlen(o.text) AS n FROM conv c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 5 AND o.k <= c.h
  UNION ALL
  SELECT c.conv_id, o.k, o.digest, strlen(o.text) FROM conv c JOIN own o ON o.conv_id = c.conv_id AND o.k > c.h
), step AS (SELECT conv_id, digest, n, row_number() OVER (PARTITION BY conv_id ORDER BY k) AS depth FROM joined),
walk AS (
  SELECT conv_id, depth, n, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM step
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM conv
), ended AS (SELECT conv_id, max(depth) AS last FROM walk GROUP BY conv_id),
node AS (
  SELECT path, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(n) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = last), '')) AS ends_sha256
  FROM walk JOIN ended USING (conv_id) GROUP BY path
), child AS (SELECT left(path, length(path) - 32) AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1),
above AS (SELECT path, saved, conv_id, unnest(range(0, depth + 1)) AS d FROM node),
below AS (
  SELECT left(a.path, a.d * 32) AS path, sum(a.saved) AS saved, count(*) FILTER (c.n IS NULL) AS n_leaves
  FROM above a LEFT JOIN child c ON c.path = a.path GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, b.n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM node n JOIN below b ON b.path = n.path LEFT JOIN child c ON c.path = n.path
LEFT JOIN node p ON n.depth > 0 AND p.path = left(n.path, length(n.path) - 32)
"""


def cover_tree_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of each vector, found by cosine whatever the labels."""
    found = cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


COVER_TREE_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_inner_product(a.v, b.v) >= 0.95 * a.norm * b.norm
), reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT r.vec_id, l.b FROM reach r JOIN link l ON l.a = r.other
), counted AS (SELECT a, count(*) AS n FROM link GROUP BY a),
named AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN named ON named.vec_id = e.vec_id LEFT JOIN counted ON counted.a = e.vec_id
"""


QUERIES = {
    "op11_cover_tree": cover_tree_classes,
    "op12_zfast_conversation_trie": conversation_trie,
    "op13_merkle_manifest": merkle_manifest,
}
ORACLES = {
    "op11_cover_tree": COVER_TREE_SQL,
    "op12_zfast_conversation_trie": TRIE_SQL,
    "op13_merkle_manifest": MERKLE_SQL,
}
