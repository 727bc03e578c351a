"""Classes against all pairs by brute force, unbiased signatures, hot groups, and odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from plumbline.llm import bag_minhash
from plumbline.llm.bag_minhash import near_duplicates, signatures
from plumbline.llm.components import components


def brute_force(rows, threshold=0.8):
    bags, root = {}, {}
    for d, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        bags[d] = Counter(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))) if w else Counter({("bytes", t): 1})
        root[d] = d

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(bags)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = sum((bags[a] & bags[b]).values())
            if both and both >= threshold * sum((bags[a] | bags[b]).values()):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {d: top(d) for d in ids}


@pytest.mark.parametrize("weights", [((1, 1, 1, 1), (1, 1, 1, 0)), ((5, 3, 9, 2), (2, 3, 12, 0)), ((100, 7, 1, 1), (60, 7, 3, 1))])
def test_signatures_are_unbiased(weights):
    rnd = np.random.default_rng(1)
    a, b = (np.resize(np.array(w), 40) for w in weights)
    agree = []
    for _ in range(40):
        ids = rnd.integers(0, 1 << 50, 40).astype(np.uint64)
        weight = np.concatenate((a, b))
        some = weight > 0
        s = signatures(np.repeat([0, 1], 40)[some], np.concatenate((ids, ids))[some], weight[some], 2, 256)
        agree.append((s[0] == s[1]).mean())
    assert abs(np.mean(agree) - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.02


def varied(rnd, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
    return " ".join(words)


def test_classes(spark, documents):
    rnd = random.Random(7)
    rows, base = [], [[f"w{rnd.randrange(400)}" for _ in range(rnd.randrange(60, 200))] for _ in range(12)]
    for k in range(160):
        rows.append((k, varied(rnd, base[k % 12], rnd.randrange(0, 6))))
    chain = [f"c{k}" for k in range(200)]  # a chain whose ends are not alike
    rows += [(300 + k, " ".join(chain[4 * k : 4 * k + 100])) for k in range(12)]
    rows += [(400, "a a a a a a a a a"), (401, "a a a a a a a a a a"), (402, "A a"), (403, "a, a"), (404, "..."), (405, "..."), (406, "!"), (407, ""), (408, "")]
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(documents(rows)).collect()}
    assert got == brute_force(rows)


def test_hot_groups_and_several_rounds(spark, documents, monkeypatch):
    """A third are exact copies, a third near copies, and many share a passage without being alike; few pivots force many rounds."""
    monkeypatch.setattr(bag_minhash, "PIVOTS", 2)
    rnd = random.Random(2)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(120)]
    rows = [(k, " ".join(base)) for k in range(60)] + [(100 + k, varied(rnd, base, 2)) for k in range(60)]
    rows += [(200 + k, " ".join([*base[:80], *(f"x{rnd.randrange(10**6)}" for _ in range(40))])) for k in range(40)]
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(documents(rows), bands=100, band_rows=3).collect()}
    assert got == brute_force(rows)


def test_odd_rows(spark, documents):
    rows = [(1, None), (2, None), (None, "one two three four five six"), (3, "one two three four five six"), (4, "One two three, four five six"),
            (4, "One two three, four five six"), (5, "long word " * 40000), (6, "long word " * 40000)]
    got = sorted(((r["doc_id"], r["class_id"]) for r in near_duplicates(documents(rows)).collect()), key=str)
    assert got == sorted([(1, 1), (2, 2), (None, None), (3, 3), (4, 3), (4, 3), (5, 5), (6, 5)], key=str)
    assert near_duplicates(documents([])).count() == 0
    #: One doc_id with two texts ties their classes together.
    two = near_duplicates(documents([(1, "a b c d e f"), (9, "a b c d e f"), (9, "u v w x y z"), (12, "u v w x y z")])).collect()
    assert {r["class_id"] for r in two} == {1}


def test_components(spark):
    edges = [(k + 1, k) for k in range(40)] + [(100, 50), (100, 60), (60, 100), (70, 70)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {50: 50, 60: 50, 100: 50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signatures_in_stretches(monkeypatch):
    """Names, keys and sketches don't depend on how texts are cut for hashing, and no array is longer than a stretch needs."""
    texts = [" ".join(f"w{(k * j) % 97}" for j in range(k % 60)) + " é!" * (k % 3) for k in range(300)] + ["", " ", "...", None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["doc_id", "text"])

    class Batches:
        def mapInArrow(self, sign, schema):
            return pa.Table.from_batches(sign(iter([batch]))).to_pylist()

    whole, longest, words_of = bag_minhash.signed(Batches(), 12, 2), [], bag_minhash.words_of
    monkeypatch.setattr(bag_minhash, "HASHED_BYTES", 700)
    monkeypatch.setattr(bag_minhash, "words_of", lambda data, bounds: (longest.append(len(data)), words_of(data, bounds))[1])
    assert bag_minhash.signed(Batches(), 12, 2) == whole
    assert max(longest) <= 700 and len({(r["name_a"], r["name_b"]) for r in whole[-4:]}) == 3
