"""Merkle manifest against a plain version: odd sizes, several tiers, other arities, NULLs, repeats, proofs that fail when a record changes."""

import hashlib

import pytest
from pyspark.sql import functions as F

from plumbline.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def climb(level, arity):
    """(root, siblings of each node from the bottom up)."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for k, p in enumerate(at):
            run = p // arity * arity
            paths[k].append(("".join(level[run:p]), "".join(level[p + 1 : run + arity])))
        level = [digest("".join(level[k : k + arity])) for k in range(0, len(level), arity)]
        at = [p // arity for p in at]
    return level[0], paths


def plain(rows, arity):
    """{(lang, doc_id, leaf): (subroot, root, proof)} of rows (doc_id, lang, leaf) without repeats."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([r[2] for r in sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, r[2]))], arity) for g in order}
    root, tops = climb([trees[g][0] for g in order], arity)
    found = {}
    for g, top in zip(order, tops):
        for r, path in zip(sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, r[2])), trees[g][1]):
            found[(r[1], r[0], r[2])] = (trees[g][0], root, [*path, *top])
    return found


@pytest.mark.parametrize("arity, depth", [(2, 2), (3, 1), (2, 8)])
def test_same_as_plain(spark, arity, depth):
    rows = [(k, lang, digest(f"{lang}{k}")) for lang, n in (("en", 37), ("de", 1), (None, 4), ("", 3), ("zé", 16)) for k in range(n)]
    rows += [(None, "en", digest("a")), (None, "en", digest("b")), (5, "en", digest("same id"))]
    df = spark.createDataFrame(rows, "doc_id long, lang string, leaf string").repartition(5).withColumn("at", F.lit("theirs")).withColumn("root", F.lit("theirs"))
    found = merkle.manifest(df, arity=arity, depth=depth).withColumn("folded", merkle.fold(F.col("leaf"), F.col("proof"))).collect()
    expected = plain(rows, arity)
    assert len(found) == len(rows)
    for r in found:
        assert (r["subroot"], r["root"], [(s["before"], s["after"]) for s in r["proof"]]) == expected[(r["lang"], r["doc_id"], r["leaf"])]
        assert r["folded"] == r["root"] and r["at"] == "theirs"


def test_a_changed_record_leads_elsewhere(spark):
    rows = [(k, "en", digest(str(k))) for k in range(9)]
    found = merkle.manifest(spark.createDataFrame(rows, "doc_id long, lang string, leaf string"))
    other = found.select((merkle.fold(F.sha2(F.concat(F.col("doc_id").cast("string"), F.lit("x")), 256), F.col("proof")) == F.col("root")).alias("same"))
    assert not any(r["same"] for r in other.collect())


def test_repeated_and_single_and_no_records(spark):
    schema = "doc_id long, lang string, leaf string"
    one = merkle.manifest(spark.createDataFrame([(1, "en", "aa")], schema)).first()
    assert (one["subroot"], one["root"], one["proof"]) == ("aa", "aa", [])
    twice = merkle.manifest(spark.createDataFrame([(1, "en", "a" * 64)] * 3, schema)).collect()
    assert len(twice) == 3 and len({r["root"] for r in twice}) == 1
    assert merkle.manifest(spark.createDataFrame([], schema)).count() == 0


def test_record_digest_tells_null_empty_and_borders_apart(spark):
    rows = [("ab", "c"), ("a", "bc"), (None, "c"), ("", "c"), ("-", "c"), ("é", "c"), ("x" * 2_000_000, "c")]
    found = [r[0] for r in spark.createDataFrame(rows, "a string, b string").select(merkle.record_digest(F.col("a"), F.col("b"))).collect()]
    assert len(set(found)) == len(rows)
    assert found[2] == digest("-1:c") and found[5] == digest("2:é1:c")
