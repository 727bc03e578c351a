"""Z-fast trie of conversations: a compacted trie whose nodes are found by hash.

A prefix of d turns is known by a 128-bit chained digest, and a conversation carries the digests of all its prefixes as one binary. A compacted
node stands for the turns lo+1 .. hi below its parent; its handle is the prefix at the two-fattest depth in (lo, hi], the number with most trailing
zeros there. Probing handles from the fattest depth downwards finds, in about log2(turns) lookups, the deepest node that a conversation passes; one
more lookup by the first turn below it gives the edge it leaves by (the exit node).

Conversations are inserted in batches. In each round all conversations that are not in the trie yet look for their exit; edges are split at every
depth at which some of them leave, and of those that go on with the same next turn one, drawn by hash, becomes the new leaf. The others go on from
where they were. As the drawn one is random, about half of those that it holds back part from it nearer to the root, so rounds grow with the
logarithm of the largest crowd, not with its size or depth.

Sums over subtrees reach the ancestors, whose lists come from the parents by pointer doubling. Nodes on an edge have the same members, so only
compacted nodes are counted, and edges are expanded to one row for each depth at the end.

A conversation is one row of 24 bytes a turn; texts are only hashed, never moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import staged

WIDTH = 16
ROOT = bytes(WIDTH)
#: A lookup table of at most so many bytes, as counted, is broadcast; a larger one is joined by shuffle.
BROADCAST_BYTES = 32 << 20
#: Conversation ids of one node are put together in stretches of 2 ** STRETCH ids before they are hashed.
STRETCH = 10


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation as (turn, digest, n_bytes), by turn (NULL first; equal ones by digest).

    NULL role or text counts as empty. Rows without conv_id belong to no conversation and are left out; other columns don't matter.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct("turn", F.substring(F.unhex(F.sha2(whole, 256)), 1, WIDTH).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    return conversations.where("conv_id IS NOT NULL").select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix digests and running bytes of each conversation."""
    for batch in batches:
        keys, depths, paths, sums = [], [], [], []
        for turns in batch.column("turns"):
            digest, total, path, running = ROOT, 0, [], [0]
            for turn in turns:
                digest = hashlib.blake2b(digest + turn["digest"].as_py(), digest_size=WIDTH).digest()
                total += turn["n_bytes"].as_py()
                path.append(digest)
                running.append(total)
            keys.append(digest)
            depths.append(len(path))
            paths.append(b"".join(path))
            sums.append(running)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(keys, pa.binary()), pa.array(depths, pa.int32()), pa.array(paths, pa.binary()), pa.array(sums, pa.list_(pa.int64()))],
            ["conv_id", "key", "depth", "path", "bytes"])


def _joined_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (key, ids) that come sorted, the digest of each key's ids; one key's ids stream through, however many they are."""
    key, state = None, None
    for batch in batches:
        done = []
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if k != key:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["key", "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["key", "ends_sha256"])


def prefix(path: Column, depth: Column, lo: Column | None = None) -> Column:
    """Digest of the first `depth` turns out of the digests of depths lo+1 and on."""
    return F.substring(path, (depth - 1 - (F.lit(0) if lo is None else lo)) * WIDTH + 1, F.lit(WIDTH))


def two_fattest(lo: Column, hi: Column) -> Column:
    """The number in (lo, hi] with most trailing zeros."""
    zeros = F.length(F.bin(lo.bitwiseXOR(hi))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", hi, zeros), zeros)


def _lookup(df: DataFrame, table: DataFrame, on: Column, small: bool) -> DataFrame:
    return df.join(F.broadcast(table) if small else table, on, "left")


def _exits(asking: DataFrame, nodes: DataFrame, longest: int, small: bool) -> DataFrame:
    """Where each of `asking` (key, depth, path, bytes, at) leaves the trie: `met` turns are in it, `exit` is the node below whose parent it
    leaves (NULL: none), exit_hi that node's depth. `at` is the depth of a node that the conversation passes, `longest` the most turns below."""
    handle = prefix(F.col("edge"), two_fattest(F.col("lo"), F.col("hi")), F.col("lo"))
    handles = nodes.select(handle.alias("handle"), F.col("hi").alias("to"), F.col("node").alias("extent"))
    found = asking.select("key", "depth", "path", "bytes", F.col("at").alias("left"), F.col("depth").alias("right"))
    for _ in range(longest.bit_length()):
        searching = F.col("left") < F.col("right")
        # a conversation that has ended its search asks for its own digest, which no other one asks for, and takes no answer
        found = found.withColumn("f", F.when(searching, two_fattest(F.col("left"), F.col("right")))).withColumn("probe", F.coalesce(prefix(F.col("path"), F.col("f")), F.col("key")))
        found = _lookup(found, handles, F.col("probe") == F.col("handle"), small)
        hit = searching & F.col("handle").isNotNull()
        passed = hit & (F.col("to") <= F.col("depth")) & (prefix(F.col("path"), F.col("to")) == F.col("extent"))
        left = F.when(passed, F.col("to")).otherwise(F.col("left"))
        right = F.when(~searching | passed, F.col("right")).when(hit, F.col("left")).otherwise(F.col("f") - 1)
        found = found.select("key", "depth", "path", "bytes", left.alias("left"), right.alias("right"))
    heads = nodes.select(F.substring("edge", 1, WIDTH).alias("head"), F.col("node").alias("exit"), F.col("hi").alias("exit_hi"), F.col("edge").alias("exit_edge"))
    below = F.col("left") < F.col("depth")
    found = found.withColumn("next", F.when(below, prefix(F.col("path"), F.col("left") + 1)).otherwise(F.col("key")))
    found = _lookup(found, heads, (F.col("next") == F.col("head")) & below, small)
    shared = F.filter(F.sequence(F.col("left") + 1, F.least("exit_hi", "depth")), lambda d: prefix(F.col("path"), d) == prefix(F.col("exit_edge"), d, F.col("left")))
    met = F.col("left") + F.when(F.col("exit").isNull(), F.lit(0)).otherwise(F.size(shared))
    return found.select("key", "depth", "path", "bytes", met.cast("int").alias("met"), "exit", "exit_hi")


def _split(nodes: DataFrame, cuts: DataFrame, small: bool) -> DataFrame:
    """The nodes, each edge cut at the depths that `cuts` (exit, met) name for it."""
    depths = cuts.groupBy("exit").agg(F.array_sort(F.collect_set("met")).alias("depths"))  # at most the turns of one edge
    marked = _lookup(nodes, depths, F.col("node") == F.col("exit"), small)
    bounds = F.concat(F.array("lo"), F.coalesce("depths", F.array().cast("array<int>")), F.array("hi"))
    marked = marked.select("edge", "bytes", "parent", F.col("lo").alias("low"), F.posexplode(F.arrays_zip(F.slice(bounds, F.lit(1), F.size(bounds) - 1).alias("lo"), F.slice(bounds, F.lit(2), F.size(bounds) - 1).alias("hi"))).alias("piece", "b"))
    lo, hi, low, edge = F.col("b.lo"), F.col("b.hi"), F.col("low"), F.col("edge")
    return marked.select(
        prefix(edge, hi, low).alias("node"), F.when(F.col("piece") == 0, F.col("parent")).otherwise(prefix(edge, lo, low)).alias("parent"), lo.alias("lo"), hi.alias("hi"),
        F.substring(edge, (lo - low) * WIDTH + 1, (hi - lo) * WIDTH).alias("edge"), F.slice("bytes", lo - low + 1, hi - lo + 1).alias("bytes"))


def compacted(sequences: DataFrame) -> DataFrame:
    """The compacted trie of distinct `sequences` (key, depth, path, bytes): (node, parent, lo, hi, edge, bytes), without the root.

    node is the digest of the prefix at depth hi, parent that at depth lo (ROOT at 0), edge the digests of the depths lo+1 .. hi, bytes the running
    bytes at the depths lo .. hi. Every sequence ends at a node.
    """
    spark = sequences.sparkSession
    nodes = staged(spark.createDataFrame([], "node binary, parent binary, lo int, hi int, edge binary, bytes array<bigint>"), "trie")
    asking, small = sequences.where("depth > 0").withColumn("at", F.lit(0)), True
    longest = asking.agg(F.max(F.col("depth") - F.col("at"))).first()[0]
    while longest:
        left = staged(_exits(asking, nodes, longest, small), "trie-exits")
        leaving = F.col("exit").isNull() | (F.col("met") < F.col("exit_hi"))
        going_on = left.where("met < depth").withColumn("next", prefix(F.col("path"), F.col("met") + 1))
        drawn = going_on.where(leaving).groupBy("next").agg(F.min_by(F.struct("key", "depth", "path", "bytes", "met"), F.xxhash64("key")).alias("d"))
        drawn = staged(drawn, "trie-drawn")
        lo, path = F.col("d.met"), F.col("d.path")
        leaves = drawn.select(
            F.col("d.key").alias("node"), F.when(lo == 0, F.lit(ROOT)).otherwise(prefix(path, lo)).alias("parent"), lo.alias("lo"), F.col("d.depth").alias("hi"),
            F.substring(path, lo * WIDTH + 1, (F.col("d.depth") - lo) * WIDTH).alias("edge"), F.slice("d.bytes", lo + 1, F.col("d.depth") - lo + 1).alias("bytes"))
        cuts = left.where(F.col("exit").isNotNull() & leaving).select("exit", "met")
        nodes = staged(_split(nodes, cuts, small).unionByName(leaves), "trie")
        n, width = nodes.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("edge")), F.lit(0))).first()
        small = 160 * n + width <= BROADCAST_BYTES
        winners = drawn.select(F.col("d.key").alias("winner"))
        rest = going_on.join(F.broadcast(winners) if small else winners, F.col("key") == F.col("winner"), "left_anti")
        asking = staged(rest.select("key", "depth", "path", "bytes", F.col("met").alias("at")), "trie-asking")
        longest = asking.agg(F.max(F.col("depth") - F.col("at"))).first()[0]
    return nodes


def _with_ancestors(nodes: DataFrame, small: bool) -> DataFrame:
    """(node, above): all ancestors of each node, nearest first and the root last, by pointer doubling."""
    root = F.lit(ROOT)
    done = None
    rows = nodes.select("node", F.array("parent").alias("above"), F.when(F.col("parent") != root, F.col("parent")).alias("tip"))
    rows = staged(rows, "trie-above")
    while True:
        closed = rows.where("tip IS NULL").select("node", "above")
        done = closed if done is None else done.unionByName(closed)
        further = rows.where("tip IS NOT NULL")
        if further.isEmpty():
            return done
        # a list that is complete stays in the table of lists, as others' tips point to it
        lists = done.withColumn("tip", F.lit(None).cast("binary")).unionByName(further).select(F.col("node").alias("other"), F.col("above").alias("others"), F.col("tip").alias("last"))
        rows = staged(further.join(F.broadcast(lists) if small else lists, F.col("tip") == F.col("other")).select("node", F.concat("above", "others").alias("above"), F.col("last").alias("tip")), "trie-above")


def trie(turns: DataFrame) -> DataFrame:
    """All nodes of the trie of `turns` (conv_id, turns), as turn_lists gives them; conv_id must be distinct and not NULL.

    Each distinct sequence of the first d turns of some conversation, by role and text, is a node of depth d; the root has depth 0. Returns for
    each node: prefix (its digest, zeros for the root), depth, conv_id (smallest member), parent_conv_id (smallest member of its parent), n_convs
    (members), n_children, n_leaves (childless nodes in its subtree, itself included), saved_tokens (over its subtree, each node's members less one
    times the bytes of its last text) and ends_sha256 (of the ids of members that end here, ascending, joined by commas). A conversation without
    turns ends at the root. Empty input gives no nodes.
    """
    walks = staged(turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turns").mapInArrow(_chained, "conv_id long, key binary, depth int, path binary, bytes array<bigint>"), "trie-walks")
    stretch = F.shiftright("conv_id", STRETCH).alias("stretch")
    ids = walks.groupBy("key", stretch).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    ends = ids.repartition("key").sortWithinPartitions("key", "stretch").select("key", "ids").mapInArrow(_joined_digests, "key binary, ends_sha256 string")
    sequences = walks.groupBy("key").agg(F.first("depth").alias("depth"), F.first("path").alias("path"), F.first("bytes").alias("bytes"), F.count("*").alias("n"), F.min("conv_id").alias("least"))
    sequences = staged(sequences, "trie-sequences")

    nodes = compacted(sequences.select("key", "depth", "path", "bytes"))
    root = walks.limit(1).select(F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(-1).alias("lo"), F.lit(0).alias("hi"), F.lit(ROOT).alias("edge"), F.array(F.lit(0), F.lit(0)).cast("array<bigint>").alias("bytes"))
    children = nodes.groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "node")
    held = nodes.unionByName(root).join(sequences.select(F.col("key").alias("node"), "n", "least"), "node", "left").join(children, "node", "left")
    held = staged(held.fillna(0, ["n", "n_children"]), "trie-held")
    size = held.agg(F.count("*"), F.coalesce(F.sum(F.col("hi") - F.col("lo")), F.lit(0))).first()
    small = 160 * size[0] + 64 * size[1] <= BROADCAST_BYTES

    above = _with_ancestors(nodes, small).unionByName(root.select("node", F.array().cast("array<binary>").alias("above")))
    first, last = F.col("bytes")[0], F.element_at("bytes", -1)
    parts = held.join(above, "node").select(
        F.explode(F.concat(F.array("node"), "above")).alias("node"), "n", "least", (F.col("n_children") == 0).cast("long").alias("leaf"), (F.col("n") * last).alias("ended"), (last - first).alias("own"))
    sums = parts.groupBy("node").agg(F.sum("n").alias("n_convs"), F.min("least").alias("conv_id"), F.sum("leaf").alias("n_leaves"), F.sum("ended").alias("ended"), F.sum("own").alias("owned"))
    sums = staged(sums, "trie-sums")

    named = sums.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_id"))
    full = held.join(sums, "node").join(F.broadcast(named) if small else named, "parent", "left").join(ends.withColumnRenamed("key", "node"), "node", "left")
    full = full.select("*", F.explode(F.sequence(F.col("lo") + 1, F.col("hi"))).alias("depth"))
    inner, top = F.col("depth") < F.col("hi"), F.col("depth") == F.col("lo") + 1
    # members' bytes below this node, less once each node's bytes below it: what its strict descendants save
    below = (F.col("ended") - F.col("n_convs") * last) - (F.col("owned") - (last - first))
    on_edge = (F.col("n_convs") - 1) * (last - F.col("bytes")[F.col("depth") - F.col("lo") - 1])
    nothing = hashlib.sha256().hexdigest()
    return full.select(
        prefix(F.col("edge"), F.col("depth"), F.col("lo")).alias("prefix"), F.col("depth").cast("long").alias("depth"), "conv_id",
        F.when(top, F.col("parent_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"), "n_convs", F.when(inner, F.lit(1).cast("long")).otherwise(F.col("n_children")).alias("n_children"),
        "n_leaves", (below + on_edge).alias("saved_tokens"), F.when(inner, F.lit(nothing)).otherwise(F.coalesce("ends_sha256", F.lit(nothing))).alias("ends_sha256"))
