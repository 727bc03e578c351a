"""Merkle manifest of a dataset: one tree for each group of records, and a tree over the groups' roots.

Concatenated-level strings: an aligned block of ARITY ** DEPTH neighbouring nodes keeps each level of its subtree as one string of 64-digit
digests. The next level is hashed from fixed-width substrings of it, and the siblings of a node are the substrings that flank it in its run,
so a whole block climbs DEPTH levels in one row, without a join. The roots of the blocks are the nodes of the next tier, and so on until one
block is left in each group; the roots of the groups then climb in the same way.

Positions are gapless within a group: records are sorted by range over all tasks and numbered inside each task, and sums of the tasks' counts
say where each task begins. A group with most of the records is spread over as many tasks as its size asks for; texts are hashed where they are
scanned and never travel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import staged

DIGITS = 64
ARITY = 2
#: Levels that a block climbs; with ARITY 2 a block has 256 nodes and its lowest level 16 KB.
DEPTH = 8


def record_digest(*values: Column) -> Column:
    """Digest of a record: each value as its length in bytes, a colon and its text, or a dash where it is NULL; lengths make it unambiguous."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold(digest: Column, proof: Column) -> Column:
    """The root that a leaf's digest leads to with the siblings of its proof."""
    return F.aggregate(proof, digest, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def _numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Nodes (g, `order`, digest, ...) with `at`, their gapless place within g, and `total`, the nodes of g."""
    keys = ["g", *order]
    dealt = nodes.withColumn("scanned", F.monotonically_increasing_id())  # equal records are dealt out by where they were read
    dealt = dealt.repartitionByRange(*keys, "scanned").sortWithinPartitions(*keys, "scanned").drop("scanned")
    dealt = staged(dealt.withColumn("place", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("place", 33).alias("part")
    counts = dealt.groupBy("g", part).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    # one row for each task that holds records of the group
    whole, before = "PARTITION BY g", "PARTITION BY g ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    counts = staged(counts.select("g", "part", (F.coalesce(F.expr(f"sum(n) OVER ({before})"), F.lit(0)) - F.col("first")).alias("shift"),
                                  F.expr(f"sum(n) OVER ({whole})").alias("total")), "merkle-counts")
    return dealt.withColumn("part", part).join(counts, ["g", "part"]).withColumn("at", F.col("place") + F.col("shift")).drop("place", "part", "shift")


def _parents(level: Column, arity: int) -> Column:
    width = DIGITS * arity
    runs = F.sequence(F.lit(0), F.ceil(F.octet_length(level) / width).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(level, i * width + 1, F.lit(width)), 256)), "").cast("binary")


def _blocks(nodes: DataFrame, arity: int, depth: int) -> DataFrame:
    """One row for each aligned block of nodes (g, at, total, digest, row): its nodes, and its levels from the nodes to the block's root."""
    size = arity**depth
    block = F.floor(F.col("at") / size).alias("block")
    item = F.struct((F.col("at") % size).cast("int").alias("at"), "digest", "row")
    grouped = nodes.groupBy("g", block).agg(F.first("total").alias("total"), F.array_sort(F.collect_list(item)).alias("items"))
    climbed = F.size(F.filter(F.sequence(F.lit(0), F.lit(depth - 1)), lambda k: F.pow(F.lit(arity), k) < F.col("total")))
    bottom = F.array(F.array_join(F.col("items.digest"), "").cast("binary"))
    levels = F.aggregate(F.slice(F.sequence(F.lit(1), F.lit(depth)), F.lit(1), climbed), bottom,
                         lambda found, _: F.concat(found, F.array(_parents(F.element_at(found, -1), arity))))
    return grouped.select("g", "block", "total", "items", levels.alias("levels"))


def _steps(levels: Column, at: Column, arity: int, depth: int) -> Column:
    """The digests that flank the node at `at` in its run, level by level up to the block's root."""

    def step(k: Column) -> Column:
        level = F.element_at(levels, k + 1)
        own = F.floor(at / F.pow(F.lit(arity), k)).cast("int")
        run = own - own % arity
        before = F.substring(level, run * DIGITS + 1, (own - run) * DIGITS)
        after = F.substring(level, (own + 1) * DIGITS + 1, (run + (arity - 1) - own) * DIGITS)
        return F.struct(before.cast("string").alias("before"), after.cast("string").alias("after"))

    return F.transform(F.slice(F.sequence(F.lit(0), F.lit(depth - 1)), F.lit(1), F.size(levels) - 1), step)


def _tiers(nodes: DataFrame, arity: int, depth: int) -> list[DataFrame]:
    """Blocks of the nodes, blocks of their roots, and so on until each g has one block."""
    tiers = []
    while True:
        blocks = staged(_blocks(nodes, arity, depth), "merkle-blocks")
        tiers.append(blocks)
        if blocks.where(F.col("total") > arity**depth).isEmpty():
            return tiers
        above = F.ceil(F.col("total") / arity**depth).alias("total")
        nodes = blocks.select("g", F.col("block").alias("at"), above, F.element_at("levels", -1).cast("string").alias("digest"), F.lit(None).cast("string").alias("row"))


def _descended(tiers: list[DataFrame], above: DataFrame, arity: int, depth: int) -> DataFrame:
    """From (g, block, steps, ...) of the last tier down to the nodes of the first: (row, g, digest, steps, ...), steps from the node up."""
    further = [c for c in above.columns if c not in ("g", "block", "steps")]
    for number, blocks in reversed(list(enumerate(tiers))):
        own = F.explode(F.transform("items", lambda i: F.struct(i["at"].alias("at"), i["digest"].alias("digest"), i["row"].alias("row"),
                                                               _steps(F.col("levels"), i["at"], arity, depth).alias("own"))))
        found = blocks.join(above, ["g", "block"]).select("g", "block", "steps", *further, own.alias("i"))
        steps = F.concat("i.own", "steps").alias("steps")
        if number:
            above = found.select("g", (F.col("block") * arity**depth + F.col("i.at")).alias("block"), steps, *further)
        else:
            above = found.select("g", "i.row", "i.digest", steps, *further)
    return above


def manifest(records: DataFrame, digest: str = "leaf", group: str = "lang", key: str = "doc_id", arity: int = ARITY, depth: int = DEPTH) -> DataFrame:
    """The records, all columns of theirs, with subroot (of their group's tree), root (of all) and proof.

    The leaves of a group ascend by `key` (NULL first; equal keys by digest); while a level has more than one node, runs of `arity` nodes (the
    last may be shorter, even one) become the digest of their concatenated hex digests. Roots of groups, ordered by `group` (NULL first,
    bytewise), likewise become the root. proof: for each level from the leaf up to the root, the digests of its run before and after the node's
    own, each as one string (both empty where the node was alone). A record whose `digest` is NULL counts as the digest of nothing. Repeated
    records are leaves of their own. No records give no rows. Columns named subroot, root or proof are replaced; columns must be sortable.
    """
    records = records.drop("subroot", "root", "proof")
    named = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))  # NULL before all names, the empty one included
    known = F.coalesce(F.col(digest), F.sha2(F.lit(""), 256))
    row = F.struct(*[F.col(c) for c in records.columns])
    leaves = records.select(named.alias("g"), F.col(key).alias("rank"), known.alias("digest"), row.alias("row"))
    tiers = _tiers(_numbered(leaves, ["rank", "digest"]), arity, depth)
    subroots = tiers[-1].select(F.lit("").alias("g"), F.col("g").alias("row"), F.element_at("levels", -1).cast("string").alias("digest"))
    upper = _tiers(_numbered(subroots, ["row"]), arity, depth)
    nothing = F.array().cast("array<struct<before:string,after:string>>")
    top = upper[-1].select("g", "block", nothing.alias("steps"), F.element_at("levels", -1).cast("string").alias("root"))
    groups = staged(_descended(upper, top, arity, depth), "merkle-groups")
    groups = groups.select(F.col("row").alias("g"), F.lit(0).cast("long").alias("block"), "steps", F.col("digest").alias("subroot"), "root")
    found = _descended(tiers, groups, arity, depth)
    return found.select("row.*", "subroot", "root", F.col("steps").alias("proof"))
