"""Registered queries against their SQL twins, and the pipeline end to end."""

import random
import re
import zlib
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from plumbline.llm import queries
from tests.compare import compare


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    assert compare(spark, sf_dir, name, queries.QUERIES[name], queries.ORACLES[name]) is None


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, docs
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, kept = kept, stage(spark, kept, sf_dir).persist()
        if number < 4:
            assert kept.columns == columns, name
            assert kept.count() == kept.select("doc_id").distinct().count()
            assert kept.join(before, "doc_id", "left_anti").count() == 0
        if name == "line dedup":
            assert kept.count() == before.count()
    pieces = kept.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert all(r[1] == r[2] for r in pieces) and len(pieces) > 0.7 * docs.count()
    assert {r[0] for r in pieces} == {r[0] for r in corpus_pipeline.run(spark, sf_dir).select("doc_id").distinct().collect()}


def test_pipeline_result_holds_the_sequences(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20)
    rows = corpus_pipeline.pack(spark, docs, sf_dir).collect()
    assert rows and all(len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)
    assert {"doc_id", "start", "doc_tokens", "sequence_id", "offset"} <= set(rows[0].asDict())


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_force_classes(texts):
    """The class of each text by all pairs of five-word multisets, NULL apart."""
    bags = []
    for text in texts:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
        bags.append(Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else None)
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            a, b = bags[i], bags[j]
            alike = texts[i] == texts[j] and texts[i] is not None if a is None or b is None else (a & b).total() >= 0.8 * (a | b).total()
            if alike and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def test_near_duplicate_stage_against_brute_force(spark, sf_dir):
    rng = random.Random(4)
    a, b, c = (" ".join(f"{p}{rng.randrange(300)}" for _ in range(60)) for p in "abc")
    rows = [(1, a), (9, a), (9, b), (20, c), (20, c), (None, c + " one more"), (None, "other words here"), (None, None), (5, None), (5, None), (6, ""), (7, ""), (8, "..."), (3, b + " tail"), (30, "x y"), (31, "x y")]
    docs = spark.createDataFrame([(k, t, "en", "web", k) for k, t in rows], SCHEMA).repartition(3)
    kept = corpus_pipeline.keep_one_of_each_class(spark, docs, sf_dir)
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    label, expected = brute_force_classes([t for _, t in rows]), Counter()
    for name in set(label):
        members = [rows[k] for k in range(len(rows)) if label[k] == name]
        expected[min(members, key=lambda m: (m[0] is None, m[0] or 0))] += 1
    ids = Counter(k for k, _ in got.elements()), Counter(k for k, _ in expected.elements())
    assert kept.columns == docs.columns and ids[0] == ids[1]
    assert got[(1, a)] == 1 and got[(3, b + " tail")] == 1 and got[(20, c)] == 1 and got[(5, None)] == 2 and got[(9, b)] == 0
    assert corpus_pipeline.keep_one_of_each_class(spark, docs.limit(0), sf_dir).count() == 0


def test_other_texts_under_the_id_of_a_copy_stay(spark, sf_dir):
    a, b = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    docs = spark.createDataFrame([(1, a, "en", "w", 1), (9, a, "en", "w", 1), (9, b, "en", "w", 1)], SCHEMA)
    assert {(r["doc_id"], r["text"]) for r in corpus_pipeline.keep_one_of_each_class(spark, docs, sf_dir).collect()} == {(1, a), (9, b)}
