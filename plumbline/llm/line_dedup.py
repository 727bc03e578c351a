"""Line dedup by a deletion-neighbourhood join, in DataFrame operations alone.

Two lines are alike if one edit turns one into the other: then leaving out one character of each (or of the longer one) gives the same
text. Every such variant becomes a hashed key; lines that meet in a key are alike, and the earliest line of each key is found by a grouped
minimum, so that no group of lines is ever expanded to pairs. The edit distance to the line that was found is verified on the texts.

Most lines have no such neighbour, and a line has as many variants as characters. Of two lines one edit apart, the first or the last half is
the same in both; so halves are hashed first, and only lines that share a half with a different line emit variants, and only those that
leave out a character outside that half.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.filters import bit_table, where_bit
from plumbline.llm.shared import staged

#: Shorter lines are alike only if they are equal: one edit in fewer characters changes too much.
MIN_CHARS = 20

#: Keys of the halves of a line of n characters, as the shorter (n) or the longer (n - 1) of two lines; head, tail, head, tail.
HALVES = """CASE WHEN n >= {least} THEN array(
  xxhash64('head', n, left(line, n DIV 2)), xxhash64('tail', n, right(line, n DIV 2)),
  xxhash64('head', n - 1, left(line, (n - 1) DIV 2)), xxhash64('tail', n - 1, right(line, (n - 1) DIV 2)))
ELSE array() END"""

#: Hash of the line without its character p. A shared head leaves p behind it, a shared tail p before it.
VARIANTS = """transform(sequence(CASE WHEN head THEN 1 + CASE WHEN tail THEN 0 ELSE (n - 1) DIV 2 END ELSE 1 END, CASE WHEN tail AND NOT head THEN n - (n - 1) DIV 2 ELSE n END),
  p -> struct(p AS p, xxhash64(concat(left(line, p - 1), substr(line, p + 1))) AS v))"""


#: What a blank line is made of.
BLANKS = " \t\r\x0b\x0c"


def places(docs: DataFrame) -> DataFrame:
    """doc_id, line_no and text of every line that is not blank."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")).where(F.ltrim("line", F.lit(BLANKS)) != "")


def named(lines: DataFrame) -> DataFrame:
    """Length and 128-bit name of each line beside it."""
    return lines.select("doc_id", "line_no", "line", F.length("line").cast("int").alias("n"), F.xxhash64("line").alias("a"), F.xxhash64(F.lit("second"), "line").alias("b"))


def neighbours(lines: DataFrame, seen: DataFrame, firsts: DataFrame, min_chars: int) -> DataFrame:
    """For each different line (a, b): the earliest line one edit away, if any, as near struct<doc_id, line_no>."""
    keys = seen.select("a", F.posexplode("halves").alias("which", "key"))
    shared = keys.groupBy("key").agg(F.min("a").alias("x"), F.max("a").alias("y")).where("x <> y").select("key")
    sides = where_bit(keys, F.col("key"), bit_table(shared)).groupBy("a").agg(
        F.max(F.col("which") % 2 == 0).alias("head"), F.max(F.col("which") % 2 == 1).alias("tail"))
    #: Only the first place of a candidate line gives its text.
    sides = staged(firsts.join(sides, "a"), "line-candidates")
    wanted = where_bit(lines, F.xxhash64("doc_id", "line_no"), bit_table(sides.select(F.xxhash64("first.doc_id", "first.line_no").alias("at"))))
    wanted = named(wanted).where(F.col("n") >= min_chars).groupBy("a", "b", "doc_id", "line_no").agg(F.min("line").alias("line"))
    candidates = sides.join(wanted, ["a", "b"]).where("first.doc_id = doc_id AND first.line_no = line_no").select("a", "b", "first", "line", F.length("line").cast("int").alias("n"), "head", "tail")
    candidates = staged(candidates, "line-texts")
    rows = candidates.select("a", "b", "first", F.explode(F.concat(F.expr(VARIANTS), F.expr("array(struct(0 AS p, xxhash64(line) AS v))"))).alias("e")).select("a", "b", "first", "e.p", "e.v")
    rows = staged(rows, "line-variants")
    met = rows.groupBy("v").agg(F.min("a").alias("x"), F.max("a").alias("y")).where("x <> y").select("v")
    rows = staged(where_bit(rows, F.col("v"), bit_table(met)).join(met, "v"), "line-meetings")
    least = F.min(F.struct("first.doc_id", "first.line_no", "a", "b"))
    #: The same place left out of both: one was changed there. A whole line that equals a variant: one character was put in.
    changed = rows.where("p > 0").groupBy("v", "p").agg(least.alias("near"))
    longer = rows.where("p > 0").groupBy("v").agg(least.alias("near"))
    shorter = rows.where("p = 0").groupBy("v").agg(least.alias("near"))
    found = rows.where("p > 0").join(changed, ["v", "p"]).select("a", "b", "near")
    found = found.unionByName(rows.where("p > 0").join(shorter, "v").select("a", "b", "near")).unionByName(rows.where("p = 0").join(longer, "v").select("a", "b", "near"))
    best = found.where("a <> near.a OR b <> near.b").groupBy("a", "b").agg(F.min("near").alias("near"))
    texts = candidates.select("a", "b", "line")
    pair = best.join(texts, ["a", "b"]).join(texts.select(F.col("a").alias("na"), F.col("b").alias("nb"), F.col("line").alias("other")), F.expr("near.a = na AND near.b = nb"))
    return pair.where(F.levenshtein("line", "other", 1) >= 0).select("a", "b", F.struct("near.doc_id", "near.line_no").alias("near"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """`docs` with the lines left out that are alike an earlier line: text, and n_lines and n_removed (lines that are not blank) beside it.

    Lines are parted by newlines; earlier means a smaller doc_id, or the same document and an earlier line. Lines of at least `min_chars`
    characters are alike up to one edit (insertion, deletion or change of one character), shorter ones if they are equal; likeness is judged
    on the input and not carried on from line to line. Blank lines stay. NULL text stays NULL with 0 lines; a text of which every line goes is
    empty. A row without doc_id neither loses lines nor counts as earlier. Rows that share a doc_id count as one document and are judged
    alike, line number by line number. Columns n_lines and n_removed of `docs` are replaced; all other columns stay.
    """
    docs = docs.drop("n_lines", "n_removed")
    lines = places(docs.where("doc_id IS NOT NULL").select("doc_id", "text"))
    seen = staged(named(lines).select("doc_id", "line_no", "a", "b", F.expr(HALVES.format(least=max(2, min_chars))).alias("halves")), "lines")
    firsts = staged(seen.groupBy("a", "b").agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("places")), "first-lines")
    near = neighbours(lines, seen, firsts.drop("places"), min_chars)
    kept = firsts.join(near, ["a", "b"], "left").where("places > 1 OR near < first").select("a", "b", F.least("first", "near").alias("kept"))
    kept = staged(kept, "kept-lines")  # with a plain shuffle on both sides, Spark splits the places of a line that is everywhere
    gone = seen.select("doc_id", "line_no", "a", "b").join(kept, ["a", "b"]).where("struct(doc_id, line_no) > kept")
    gone = gone.groupBy("doc_id").agg(F.sort_array(F.collect_set("line_no")).alias("_gone"))
    joined = docs.join(gone.withColumnRenamed("doc_id", "_doc"), F.col("doc_id") == F.col("_doc"), "left")
    #: Rows that lose nothing keep their text as it is; in the others the parts are made once a row, not once a line.
    name = f"parts_{uuid.uuid4().hex}"
    lose, parts = F.col("_gone").isNotNull(), F.col(name)
    blank = F.size(F.filter(parts, lambda s: F.ltrim(s, F.lit(BLANKS)) == ""))
    left = F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_gone")), lambda k: F.get(parts, k)), "\n")
    joined = joined.withColumn(name, F.split("text", "\n", -1))
    return joined.select(
        *(F.when(lose, left).otherwise(F.col("text")).alias("text") if c == "text" else F.col(c) for c in docs.columns),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(parts) - blank).cast("long").alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"))
