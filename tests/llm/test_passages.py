"""The two operators on repeated passages against brute force, with and without the way for hot anchors."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import passages, substring_dedup, suffix_dedup
from plumbline.llm.arrays import BYTE_VALUES
from plumbline.llm.filters import xxhash_longs
from plumbline.llm.passages import runs_of


def corpus(seed, sep):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(300)] + ["é", "日本"]
    passage = [rnd.choice(words) for _ in range(40)]
    base = [rnd.choice(words) for _ in range(150)]
    rows = []
    for k in range(60):
        own = [rnd.choice(words) for _ in range(rnd.randrange(0, 60))]
        if k % 3 == 0:
            own[len(own) // 2 : len(own) // 2] = passage
        if k % 5 == 1:
            own = list(base)
            for _ in range(rnd.randrange(3)):
                own[rnd.randrange(150)] = rnd.choice(words)
        if k % 7 == 2:
            own = own + own
        rows.append((k, sep.join(own)))
    return [*rows, (70, None), (71, ""), (72, " "), (73, "a " * 300), (74, "b a " * 200), (75, "a " * 90)]


def words_left(rows, window):
    first, out = {}, {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        w = (t or "").encode().split()
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), d)
    for d, t in rows:
        w = (t or "").encode().split()
        gone = {p for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < d for p in range(k, k + window)}
        out[d] = (len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode())
    return out


def bytes_left(rows, window):
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - window + 1):
            if b[k : k + window] in seen:
                gone[k : k + window] = True
            seen.add(b[k : k + window])
        out[d] = (len(b), int(gone.sum()), np.frombuffer(b, np.uint8)[~gone].tobytes())
    return out


@pytest.mark.parametrize("hot,shard_bytes", [(512, 1 << 18), (4, 2000)])
def test_words(spark, documents, hot, shard_bytes):
    rows = corpus(1, " ")
    found = substring_dedup.without_repeats(documents(rows), window=12, hot=hot, shard_bytes=shard_bytes).collect()
    assert {r["doc_id"]: (r["n_words"], sum(s["last"] - s["first"] + 1 for s in r["spans"]), r["kept"]) for r in found} == words_left(rows, 12)


@pytest.mark.parametrize("hot,shard_bytes", [(512, 1 << 18), (4, 2000)])
def test_bytes(spark, documents, hot, shard_bytes):
    rows = corpus(2, ", ")
    found = suffix_dedup.without_repeats(documents(rows), window=40, hot=hot, shard_bytes=shard_bytes).collect()
    assert {r["doc_id"]: (r["n_bytes"], sum(s["last"] - s["first"] + 1 for s in r["spans"]), bytes(r["kept"])) for r in found} == bytes_left(rows, 40)
    assert all(a["last"] + 1 < b["first"] for r in found for a, b in zip(r["spans"], r["spans"][1:]))


@pytest.mark.parametrize("operator,left,window,sep", [(substring_dedup, words_left, 12, " "), (suffix_dedup, bytes_left, 40, ", ")])
def test_windows_of_a_common_passage_are_named_in_stretches(spark, documents, monkeypatch, operator, left, window, sep):
    rnd = random.Random(5)
    common = [f"common{k}" for k in range(60)]
    rows = [(k, sep.join([f"x{rnd.randrange(10**6)}", *common[rnd.randrange(2) :], f"y{rnd.randrange(10**6)}"])) for k in range(60)]
    made = {}

    def counted(df, name, staged=passages.staged):
        out = staged(df, name)
        made[name] = out.count()
        return out

    monkeypatch.setattr(passages, "staged", counted)
    found = operator.without_repeats(documents(rows), window=window, hot=4).collect()
    assert {r["doc_id"]: bytes(r["kept"]) if operator is suffix_dedup else r["kept"] for r in found} == {d: x[2] for d, x in left(rows, window).items()}
    assert 0 < made["hot-windows"] <= 8 * made["hot-contents"]  # up to window - gram + 1 (33 bytes) for each content before


def test_only_shared_rows_go_through_all_rounds(monkeypatch):
    rnd = np.random.default_rng(2)
    texts = [np.append(rnd.integers(1, 200, 400), 255).astype(np.uint8) for _ in range(4)]
    texts[2][100:160] = texts[0][30:90]
    blocks, sorted_rows = [suffix_dedup.Block(t) for t in texts], []
    argsort = np.argsort
    monkeypatch.setattr(np, "argsort", lambda a, **b: (sorted_rows.append(len(a)), argsort(a, **b))[1])
    rows, _, common = suffix_dedup.merged(blocks, 50)
    assert sorted(rows.tolist()) == list(range(1604)) and (common == 50).sum() == 12  # the first place, and 11 windows that stand twice
    assert sum(sorted_rows) < 10 * 1604  # 50 times before


@pytest.mark.parametrize("operator,left,window,sep", [(substring_dedup, words_left, 24, " "), (suffix_dedup, bytes_left, 100, ", ")])
def test_only_stretches_with_a_shared_core_are_cut(spark, documents, monkeypatch, operator, left, window, sep):
    """Copies that differ in one word each, which nothing else has: few of their windows are in doubt."""
    rnd = random.Random(8)
    base = [f"base{k:04}" for k in range(30)]
    rows = [(0, sep.join(base))]
    for k in range(1, 120):
        at = rnd.randrange(30)
        rows.append((k, sep.join([*base[:at], f"x{rnd.randrange(10**7):07}", *base[at + 1 :]])))
    made = {}

    def counted(df, name, staged=passages.staged):
        out = staged(df, name)
        made[name] = made.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(passages, "staged", counted)
    found = operator.without_repeats(documents(rows), window=window, hot=4).collect()
    assert {r["doc_id"]: bytes(r["kept"]) if operator is suffix_dedup else r["kept"] for r in found} == {d: x[2] for d, x in left(rows, window).items()}
    assert made["hot-contents"] > 100
    assert made["hot-stretches"] + made["hot-windows"] < 8 * made["hot-contents"], made


def test_only_rows_that_a_window_reaches_are_merged(monkeypatch):
    rnd = np.random.default_rng(3)
    common = bytes(rnd.integers(1, 200, 110, dtype=np.uint8))
    texts = [bytes(rnd.integers(1, 200, 29, dtype=np.uint8)) + bytes([k + 1]) + common for k in range(20)]
    sorted_rows, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda a, **b: (sorted_rows.append(len(a)), argsort(a, **b))[1])
    flags = suffix_dedup.repeats(texts, list(range(20)), [0] * 20, 100, block_bytes=500)
    assert [np.flatnonzero(f).tolist() for f in flags] == [[]] + [list(range(30, 41))] * 19
    assert max(sorted_rows) == 20 * 41 and sum(sorted_rows) < 100 * 20 * 41  # 20 * 141 rows before


@pytest.mark.parametrize("operator", [substring_dedup, suffix_dedup])
def test_odd_rows(spark, documents, operator):
    text = " ".join(f"word{k}" for k in range(80))
    found = operator.without_repeats(documents([(2, text), (None, text), (1, text), (1, text), (3, None)])).collect()
    left = sorted((str(r["doc_id"]), len(r["spans"])) for r in found)
    assert left == [("1", 0), ("1", 0), ("2", 1), ("3", 0), ("None", 0)]
    assert operator.without_repeats(documents([])).count() == 0


def test_a_long_document_is_cut_without_harm(monkeypatch):
    """Runs of stretches cover the same windows as runs of the whole."""
    rnd = np.random.default_rng(1)
    units = BYTE_VALUES[rnd.integers(0, 4, 3000)]
    whole = runs_of(units, np.array([0, 3000]), 40, 8)
    assert whole.windows.sum() == 3000 - 39 and (whole.start[1:] == whole.start[:-1] + whole.windows[:-1]).all()
    anchors = np.repeat(whole.anchor, whole.windows)
    for s in range(0, 2961, 700):
        part = runs_of(units[s : s + 739], np.array([0, len(units[s : s + 739])]), 40, 8)
        assert (np.repeat(part.anchor, part.windows) == anchors[s : s + 700]).all()


def test_hash_of_two_longs_is_that_of_spark(spark):
    rows = [(1, 2), (-5, 1 << 40), (0, 0)]
    df = spark.createDataFrame(rows, "a long, b long").select(F.xxhash64("a", "b"))
    got = xxhash_longs(np.array([r[0] for r in rows]), np.array([r[1] for r in rows])).view(np.int64).tolist()
    assert got == [r[0] for r in df.collect()]


def test_automaton_finds_first_documents():
    rnd = random.Random(3)
    texts = [[rnd.choice("ab") for _ in range(40)] for _ in range(8)]
    automaton = substring_dedup.SuffixAutomaton()
    for k, t in enumerate(texts):
        automaton.add(t, k)
    for t in [*texts, list("abba") * 8]:
        wins = ["".join(t[k : k + 6]) for k in range(len(t) - 5)]
        assert automaton.first_documents(t, 6) == [next((k for k, x in enumerate(texts) if w in "".join(x)), -1) for w in wins]


def test_merged_transforms_are_sorted_and_know_common_prefixes():
    rnd = np.random.default_rng(5)
    texts = [np.append(rnd.integers(97, 99, 60), 255).astype(np.uint8) for _ in range(3)]
    rows, interval, common = suffix_dedup.merged([suffix_dedup.Block(t) for t in texts], 10)
    offset = np.cumsum([0] + [len(t) for t in texts])
    rings = [np.concatenate((t, t)).tobytes() for t in texts]
    prefix = []
    for r in rows:
        k = int(np.searchsorted(offset, r, side="right")) - 1
        p = int(suffix_dedup.Block(texts[k]).order[r - offset[k]])
        prefix.append(rings[k][p : p + 10])
    assert prefix == sorted(prefix)
    for k in range(1, len(prefix)):
        same = next((i for i in range(10) if prefix[k][i] != prefix[k - 1][i]), 10)
        assert common[k] == same and (interval[k] == interval[k - 1]) == (same == 10)
