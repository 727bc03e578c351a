"""FM-index search against plain search, and the defined results of odd rows."""

import random

import numpy as np
import pytest

import corpus_pipeline
from plumbline.llm import decontaminate
from plumbline.llm.decontaminate import FMIndex, contamination, suffix_array, without_spans


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array(seed):
    rnd = np.random.default_rng(seed)
    text = rnd.integers(0, [2, 3, 50, 2000, 1 << 20, 1][seed], 400)
    text = np.concatenate((text, text[:150]))
    assert suffix_array(text).tolist() == sorted(range(len(text)), key=lambda k: text[k:].tolist())


def test_ranks_and_location():
    rnd = np.random.default_rng(3)
    text = np.append(rnd.integers(1, 6, 500), 0)
    text[100] = 0
    index = FMIndex(text, sample=8)
    rows = np.arange(len(text))
    assert index.locate(rows).tolist() == suffix_array(text).tolist()
    transform = text[suffix_array(text) - 1]
    for code in range(6):
        expected = [int((transform[:k] == code).sum()) for k in range(len(text) + 1)]
        assert index.rank(np.full(len(text) + 1, code), np.arange(len(text) + 1)).tolist() == expected


def plain(docs, items, window):
    import re

    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(len(w) - window, 0) + 1) if w else ():
            wins.setdefault(tuple(w[k : k + window]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for p, ids in wins.items():
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k : k + len(p)]) == p:
                    hit.update(range(k, k + len(p)))
                    found |= ids
        out.append((d, len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("block_words", [1 << 22, 20])
def test_contamination(spark, documents, block_words):
    rnd = random.Random(5)
    letters = ["a", "b", "c", "É", "9x"]
    items = [(k, " ".join(rnd.choice(letters) for _ in range(rnd.randint(1, 14)))) for k in range(12)] + [(50, None), (51, " .. "), (52, "A b, c")]
    docs = [(k, " ".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60)))) for k in range(30)]
    docs += [(40, None), (41, ""), (42, "..."), (43, items[0][1].upper() + "! " + (items[1][1] or "")), (43, "other a b c words"), (None, "a b c")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(documents(docs), benchmark, window=5, shard_words=200, block_words=block_words).collect()
    seen = sorted(((r["doc_id"] if r["doc_id"] is not None else -1), r["n_words"], sum(s["last"] - s["first"] + 1 for s in r["spans"]), list(r["items"])) for r in got)
    assert seen == sorted((d if d is not None else -1, n, h, i) for d, n, h, i in plain(docs, items, 5))
    for r in got:
        assert all(a["last"] + 1 < b["first"] for a, b in zip(r["spans"], r["spans"][1:]))


def test_clean_documents_stay(spark, documents):
    docs = documents([(1, "x one two three four five"), (2, "one two"), (None, "nothing"), (3, None)])
    found = contamination(docs, spark.createDataFrame([(7, "one two three")], "item_id long, text string"), window=3)
    kept = without_spans(docs, found)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {2, 3, None}


def test_answers_do_not_depend_on_blocks(spark, documents):
    items = [(1, f"w{k} x{k} y{k}") for k in range(20)] + [(1, "w1 x1 y1")] * 20 + [(2, "a b c"), (3, "c d e")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = documents([(None, "a b c d"), (None, "n o n e"), (None, "q a b c"), (5, "a b c d e"), (5, "a b c d e"), (5, "w3 x3 y3 c d"), (6, None), (6, None), (7, "w1 x1 y1 w2 x2 y2")])
    one, many = (sorted(map(str, contamination(docs, benchmark, window=3, block_words=n).collect())) for n in (1 << 22, 30))
    assert len(one) == 9 and one == many
    blocks = [b.collect() for b in decontaminate._blocks(benchmark, 30)]
    assert len(blocks) > 5 and max(map(len, blocks)) < 12 and sum(map(len, blocks)) == 22


@pytest.mark.parametrize("block_words", [1 << 22, 3])
@pytest.mark.parametrize("shard_words", [1 << 19, 4])
def test_rows_are_judged_by_themselves(spark, documents, tmp_path, block_words, shard_words):
    leak, other = "x one two three four five", "seven EIGHT, nine"
    rows = [(None, leak), (None, "nothing"), (None, None), (1, leak), (1, "clean of 1"), (1, "clean of 1"), (2, other), (2, ""), (None, other), (3, "one two")]
    benchmark = spark.createDataFrame([(7, "one two three"), (8, "seven eight nine")], "item_id long, text string")
    docs = documents(rows).repartition(2)
    kept = decontaminate.clean(docs, benchmark, window=3, block_words=block_words, shard_words=shard_words)
    assert kept.dtypes == docs.dtypes
    expected = [r for r in rows if r[1] not in (leak, other)]
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(map(str, expected))
    assert {r["spans"] for r in kept.collect()} == {"theirs"}


def test_pipeline_keeps_clean_rows(spark, tmp_path):
    leak = "one two three four five six seven eight nine ten eleven"
    spark.createDataFrame([(7, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(None, leak), (None, "clean without id"), (1, leak), (1, "clean of 1")], "doc_id long, text string")
    assert sorted(r["text"] for r in corpus_pipeline.remove_leaks(spark, docs, str(tmp_path)).collect()) == ["clean of 1", "clean without id"]


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(documents([]), none).count() == 0
    assert [r["spans"] for r in contamination(documents([(1, "a b")]), none).collect()] == [[]]
    assert decontaminate.WINDOW == 10
