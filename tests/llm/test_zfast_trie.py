"""Z-fast trie against a plain trie: shared starts, ends inside edges, copies, long conversations, NULLs."""

import hashlib
import random

from pyspark.sql import functions as F

from plumbline.llm import index_queries, zfast_trie


def plain(conversations):
    """{(conv_id, depth): ...} of {conv_id: [(role, text), ...]}."""
    nodes = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    found = {}
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        ends = sorted(c for c in members if len(conversations[c]) == len(path))
        found[(min(members), len(path))] = (
            min(nodes[path[:-1]]) if path else None, len(members), sum(len(q) == len(path) + 1 for q in below), len(leaves),
            sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
    return found


def held(df):
    return {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in df.collect()}


def table(spark, conversations):
    rows = [(c, k, role, text) for c, turns in conversations.items() for k, (role, text) in enumerate(turns)]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("path", F.lit("theirs")).withColumn("depth", F.lit(9))


def test_same_as_plain(spark):
    rng = random.Random(5)
    made = {}
    for c in range(60):
        start = rng.choice(list(made.values()) or [[]])
        made[c * 7 - 50] = [*start[: rng.randrange(len(start) + 1)], *[(rng.choice(["user", "tool"]), rng.choice(["a", "bé", ""])) for _ in range(rng.randrange(1, 6))]]
    made[9999], made[10000] = list(made[-50]), [("user", "a")] * 40
    made[10001] = made[10000][:23]
    df = zfast_trie.trie(zfast_trie.turn_lists(table(spark, made)))
    assert held(df) == plain(made)


def test_search_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(zfast_trie, "BROADCAST_BYTES", 0)
    made = {c: [("u", "hot"), *[("u", str(c >> k)) for k in range(c % 4)]] for c in range(30)}
    assert held(zfast_trie.trie(zfast_trie.turn_lists(table(spark, made)))) == plain(made)


def test_order_nulls_and_repeats(spark):
    rows = [(1, 1, None, "b"), (1, None, "user", None), (1, 1, None, "b"), (2, 0, "user", ""), (None, 0, "user", "x"), (3, 5, "user", "x" * 1_000_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = {1: [("user", ""), ("", "b"), ("", "b")], 2: [("user", "")], 3: [("user", "x" * 1_000_000)]}
    assert held(zfast_trie.trie(zfast_trie.turn_lists(df))) == plain(made)
    assert zfast_trie.trie(zfast_trie.turn_lists(df.limit(0))).count() == 0


def test_conversations_without_turns_end_at_the_root(spark):
    turns = spark.createDataFrame([(7, []), (8, [])], "conv_id long, turns array<struct<turn:long,digest:binary,n_bytes:long>>")
    assert held(zfast_trie.trie(turns)) == plain({7: [], 8: []})


def test_ids_of_a_node_span_stretches_in_order(spark):
    made = {c: [("u", "same")] for c in (-3000, -1025, -1, 0, 5, 10, 1023, 1024, 99_999)}
    assert held(zfast_trie.trie(zfast_trie.turn_lists(table(spark, made)))) == plain(made)


def test_rebuilt_takes_the_start_of_the_base(spark):
    import zlib

    made = {c: [("u", f"{c}-{k}") for k in range(1 + c % 9)] for c in (5, 6, 7, 8, 9, 13, 27)}
    found = {r["conv_id"]: [t["n_bytes"] for t in r["turns"]] for r in index_queries.rebuilt(table(spark, made)).collect()}
    for c, own in made.items():
        h = zlib.crc32(str(c).encode()) % 9
        expected = made.get(c - c % 5, [])[:h] + own[h:]
        assert found[c] == [len(t) for _, t in expected]
