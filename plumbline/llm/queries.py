"""Registered queries of the operators, each over its whole tables with production parameters, and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import bag_minhash, decontaminate, index_queries, language, licenses, line_dedup, packing, quality, secrets, substring_dedup, suffix_dedup

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences among whole documents and whole lines of documents."""
    found = licenses.scan(table(spark, sf_dir, "documents"), licenses.built_in(spark))
    return found.select("doc_id", "digest", "license_id", F.array_join("notices", ",").alias("notices"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie inside an occurring window of the benchmark."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(names, 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


DECONTAMINATION_SQL = r"""
WITH lowered AS (
  SELECT 'd' AS side, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark
), listed AS (SELECT side, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
windows AS (
  SELECT DISTINCT id AS item_id, list_slice(w, k, least(k + 9, len(w))) AS win
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM listed WHERE side = 'b' AND len(w) > 0)
), sized AS (SELECT win, len(win) AS n, array_to_string(win, ' ') AS key, list(item_id) AS items FROM windows GROUP BY win),
lengths AS (SELECT DISTINCT n FROM sized),
starts AS (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM listed, lengths WHERE side = 'd' AND len(w) >= n),
hits AS (SELECT id, k, sized.n, items FROM starts JOIN sized ON sized.n = starts.n AND sized.key = array_to_string(list_slice(w, k, k + starts.n - 1), ' ')),
words_hit AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(k, k + n)) AS p FROM hits) GROUP BY id),
items_hit AS (
  SELECT id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT id, CAST(unnest(items) AS VARCHAR) AS name FROM hits) GROUP BY id
)
SELECT l.id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM listed l LEFT JOIN words_hit h ON h.id = l.id LEFT JOIN items_hit i ON i.id = l.id WHERE side = 'd'
"""


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document, learned from the labelled documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    content = language.fit(docs.where(~held_out).select("doc_id", "text", "lang"))
    found = language.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), content)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training sequences filled along the space-filling curve; the ids themselves are reduced to a checksum."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def automaton_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without the 50-word passages that an earlier document holds."""
    found = substring_dedup.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2(F.col("kept"), 256).alias("kept_sha256"))


SUBSTRING_SQL = r"""
WITH listed AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, k, array_to_string(list_slice(w, k, k + 49), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS k FROM listed WHERE len(w) >= 50)
), earliest AS (SELECT s, min(doc_id) AS d FROM win GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 50)) AS p FROM win JOIN earliest USING (s) WHERE d < doc_id),
word AS (SELECT doc_id, generate_subscripts(w, 1) AS p, unnest(w) AS word FROM listed),
left_over AS (
  SELECT word.doc_id, count(*) FILTER (gone.p IS NOT NULL) AS n_removed, string_agg(word, ' ' ORDER BY word.p) FILTER (gone.p IS NULL) AS kept
  FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.p = word.p GROUP BY word.doc_id
)
SELECT l.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM listed l LEFT JOIN left_over o ON o.doc_id = l.doc_id
"""


def transform_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without the 100-byte strings that stand earlier."""
    found = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of each document and the verdict of the cascade."""
    found = quality.judged(table(spark, sf_dir, "documents").select("doc_id", "text"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        failed.alias("base_failed"), (~failed & F.col("rejected_by").isNull()).alias("kept"))


QUALITY_SQL = r"""
WITH held AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
listed AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM held
), win AS (
  SELECT doc_id, k, array_to_string(list_slice(w, k, k + 4), ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS k FROM listed WHERE len(w) >= 5)
), again AS (SELECT doc_id, s FROM win GROUP BY ALL HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(k, k + 5)) AS p FROM win JOIN again USING (doc_id, s)) GROUP BY doc_id),
measure AS (
  SELECT l.doc_id, t, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM listed l LEFT JOIN covered c ON c.doc_id = l.doc_id
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines OR word_chars < 2 * n_words OR word_chars > 20 * n_words
         OR 5 * length(regexp_replace(t, '[^!]', '', 'g')) > n_words
         OR 2 * length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) > length(regexp_replace(t, '[^\p{L}]', '', 'g')) AS rejected
  FROM measure
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept FROM judged
"""


def trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and places of secrets in each document."""
    found = secrets.secrets(table(spark, sf_dir, "documents"))
    base = ("assign", "access", "hex")

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, base), F.sha2(written(F.filter("spans", lambda s: s["kind"].isin(*base))), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def _spans_sql(kind: str, rank: int, regex: str, group: int, least: int) -> str:
    return rf"""SELECT doc_id, {rank} AS rank, '{kind}' AS kind,
      list_sum(list_transform(list_slice(g, 1, k), lambda x: length(x))) + coalesce(list_sum(list_transform(list_slice(m, 1, k - 1), lambda x: length(x))), 0) AS s, length(m[k]) AS n
    FROM (SELECT doc_id, m, j, g, unnest(range(1, len(m) + 1)) AS k FROM (
      SELECT doc_id, regexp_extract_all(t, '{regex}') AS m, regexp_extract_all(t, '{regex}', {group}) AS j, string_split_regex(t, '{regex}') AS g FROM held))
    WHERE length(j[k]) >= {least}"""


SECRETS_SQL = "WITH held AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), span AS (" + " UNION ALL ".join(
    _spans_sql(r.kind, k, r.regex.replace("'", "''"), r.group, r.least) for k, r in enumerate(secrets.RULES)) + r"""), place AS (
  SELECT *, kind || ':' || CAST(CAST(s AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(s + n AS BIGINT) AS VARCHAR) AS name FROM span)
SELECT held.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(name, ',' ORDER BY s, rank) FILTER (rank < 3), '')) AS base_sha256, coalesce(string_agg(name, ',' ORDER BY s, rank), '') AS spans
FROM held LEFT JOIN place ON place.doc_id = held.doc_id GROUP BY held.doc_id"""


def neighbourhood_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without the lines that are alike an earlier one."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "text", "n_lines", "n_removed")


LINE_DEDUP_SQL = r"""
WITH place AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS k, unnest(parts) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)
), line AS (
  SELECT line, min({'d': doc_id, 'k': k}) AS earliest FROM place WHERE regexp_matches(line, '[^ \t\r\x0b\x0c]') GROUP BY line
), variant AS (
  SELECT line, earliest, p, left(line, p - 1) || substr(line, p + 1) AS v
  FROM (SELECT line, earliest, unnest(range(1, length(line) + 1)) AS p FROM line WHERE length(line) >= 20)
), near AS (
  SELECT a.line, b.earliest FROM variant a JOIN variant b ON a.v = b.v AND a.p = b.p
  UNION ALL SELECT a.line, b.earliest FROM variant a JOIN line b ON a.v = b.line AND length(b.line) >= 20
  UNION ALL SELECT b.line, a.earliest FROM variant a JOIN line b ON a.v = b.line AND length(b.line) >= 20
  UNION ALL SELECT line, earliest FROM line
), kept AS (SELECT line, min(earliest) AS earliest FROM near GROUP BY line),
judged AS (SELECT doc_id, k, place.line, coalesce({'d': doc_id, 'k': k} > earliest, false) AS gone, earliest IS NOT NULL AS counts FROM place LEFT JOIN kept ON kept.line = place.line)
SELECT d.doc_id, coalesce(string_agg(j.line, chr(10) ORDER BY k) FILTER (NOT gone), CASE WHEN d.text IS NOT NULL THEN '' END) AS text,
       count(*) FILTER (counts) AS n_lines, count(*) FILTER (gone) AS n_removed
FROM documents d LEFT JOIN judged j ON j.doc_id = d.doc_id GROUP BY d.doc_id, d.text
"""


def bag_minhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near-duplicates that each document belongs to; the document whose id names the class is the one to keep."""
    found = bag_minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


BAG_MINHASH_SQL = r"""
WITH RECURSIVE listed AS (
  SELECT doc_id, text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL
), shingle AS (
  SELECT doc_id, s, count(*) AS n FROM (
    SELECT doc_id, array_to_string(list_slice(w, k, k + 4), ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM listed WHERE len(w) > 0)
  ) GROUP BY ALL
), total AS (SELECT doc_id, sum(n) AS n FROM shingle GROUP BY doc_id),
both_have AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.n, b.n)) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM both_have h JOIN total x ON x.doc_id = a JOIN total y ON y.doc_id = b WHERE h.n >= 0.8 * (x.n + y.n - h.n)
  UNION
  SELECT a.doc_id, b.doc_id FROM listed a JOIN listed b ON a.text = b.text AND len(a.w) = 0 AND len(b.w) = 0 AND a.doc_id <> b.doc_id
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other
)
SELECT doc_id, min(other) AS class_id, doc_id = min(other) AS kept FROM reach GROUP BY doc_id
"""


QUERIES = {
    "op1_license_scan": license_scan,
    "op2_benchmark_decontamination": decontamination,
    "op3_language_id": language_id,
    "op4_curve_packing": curve_packing,
    "op5_automaton_substring_dedup": automaton_substring_dedup,
    "op6_quality_cascade": quality_cascade,
    "op7_line_neighbourhood_dedup": neighbourhood_line_dedup,
    "op8_transform_suffix_dedup": transform_suffix_dedup,
    "op9_trigram_secrets": trigram_secrets,
    "op10_bag_minhash": bag_minhash_classes,
} | index_queries.QUERIES
ORACLES = {
    "op2_benchmark_decontamination": DECONTAMINATION_SQL,
    "op5_automaton_substring_dedup": SUBSTRING_SQL,
    "op6_quality_cascade": QUALITY_SQL,
    "op7_line_neighbourhood_dedup": LINE_DEDUP_SQL,
    "op9_trigram_secrets": SECRETS_SQL,
    "op10_bag_minhash": BAG_MINHASH_SQL,
} | index_queries.ORACLES
