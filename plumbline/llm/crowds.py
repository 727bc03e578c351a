"""Pairs that can be alike within a crowd of documents that have much in common, without meeting in pairs.

Documents are sets of units. Against any common set, the ground, each document x is known by its differences D(x): units that only one of the
two has. Two documents differ in |D(x)| + |D(y)| - 2 |D(x) & D(y)| units, and their similarity reaches t if that is at most (|x| + |y|) r with
r = (1 - t) / (1 + t). With the slack s(x) = |D(x)| - r |x| this says 2 |D(x) & D(y)| >= s(x) + s(y). Hence

* where s(x) + s(y) <= 0 both are alike the document of least slack, the hub: one comparison each joins them;
* any other link needs (s(x) + s(y)) / 2 shared differences, so with the differences of each document ordered from the rarest on, a shared
  one lies in a prefix of both that leaves out so many less one of the most frequent.

The ground is what most of the crowd has, so no difference belongs to more than half of it. Nothing is estimated here and nothing dropped:
a pair that is not returned is below t or joined with the hub already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.filters import has_hash, member_bits, xxhash_longs
from plumbline.llm.shared import staged

#: Rounding of the slack, far below the sixth of a unit by which slacks that matter differ for any usual t.
EPS = 1e-6
#: Differing units of one packet, before those that members of a batch share are counted.
PACKET_UNITS = 1 << 14


def references(rows: DataFrame, least: int) -> DataFrame:
    """bucket and ref, the largest component among its members, for each bucket of more than `least` of the `rows` (bucket, root)."""
    sizes = rows.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    found = sizes.groupBy("bucket").agg(F.sum("n").alias("members"), F.max(F.struct("n", (-F.col("root")).alias("least"))).alias("m"))
    return found.where(F.col("members") > least).select("bucket", (-F.col("m.least")).alias("ref"))


def packed(differing: DataFrame, packets: int) -> DataFrame:
    """The units of `differing` dealt out to packets by ref and unit: lists of refs, units, and in how many members of a batch each differs."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column(1)
            unit = units.flatten().to_numpy()
            ref = np.repeat(batch.column(0).to_numpy(), pc.list_value_length(units).to_numpy())
            ref, unit, c = _counted(ref, unit, np.ones(len(unit), np.int64))
            packet = (xxhash_longs(ref, unit) % np.uint64(packets)).astype(np.int64)
            order = np.argsort(packet, kind="stable")
            own, at = np.unique(packet[order], return_index=True)
            bounds = pa.array(np.append(at, len(packet)), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(own), *(pa.ListArray.from_arrays(bounds, pa.array(x[order])) for x in (ref, unit, c))], ["packet", "refs", "units", "counts"])

    return differing.select("ref", "units").mapInArrow(pack, "packet long, refs array<long>, units array<long>, counts array<long>")


def _counted(ref: np.ndarray, unit: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each ref and unit once, with the sum of its counts."""
    order = np.lexsort((unit, ref))
    ref, unit, c = ref[order], unit[order], c[order]
    new = np.ones(len(unit), bool)
    new[1:] = (unit[1:] != unit[:-1]) | (ref[1:] != ref[:-1])
    at = np.flatnonzero(new)
    return ref[at], unit[at], np.add.reduceat(c, at) if len(at) else c


def tallied(differing: DataFrame) -> DataFrame:
    """ref, unit and c, in how many members it differs, where that is more than one. What members of a batch share is counted there, and
    what goes on travels in packets of bounded size: a difference that only one member has is never a row."""
    packets = max(1, -(-(differing.agg(F.sum(F.size("units"))).first()[0] or 0) // PACKET_UNITS))

    def add(table: pa.Table) -> pa.Table:
        ref, unit, c = _counted(*(pc.list_flatten(table.column(k)).to_numpy() for k in ("refs", "units", "counts")))
        return pa.table({"ref": ref[c > 1], "unit": unit[c > 1], "c": c[c > 1]})

    return packed(differing, packets).groupBy("packet").applyInArrow(add, "ref long, unit long, c long")


def grounded(differing: DataFrame) -> DataFrame:
    """`differing` (ref, id, n, units) with the units against the ground of each crowd instead of against `ref`: d, sorted keys, each of how
    many members have the difference (twice its binary logarithm, 7 bits) and the unit (56 bits), so the rarest come first."""
    counts = tallied(differing).join(differing.groupBy("ref").agg(F.count("*").alias("m")), "ref")
    #: A unit in which more than half differ from ref stands on the other side in the ground.
    rank = "shiftleft(CAST(floor(2 * log2(greatest(1, CASE WHEN 2 * c > m THEN m - c ELSE c END))) AS bigint), 56)"
    keys = staged(counts.select("ref", "unit", F.expr("2 * c > m").alias("turned"), F.expr(f"{rank} | (unit & {(1 << 56) - 1})").alias("key")), "crowd-units")
    turned = keys.where("turned").groupBy("ref").agg(F.collect_list(F.struct("unit", "key")).alias("t"))  # fewer than twice the units of a member on average
    turned = turned.select("ref", F.col("t.unit").alias("there"), F.col("t.key").alias("back"))
    plain = keys.where("NOT turned")
    shared = member_bits(plain.where(f"key >= {1 << 56}").select(F.xxhash64("ref", "unit").alias("at")), hashed=True)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        for batch in batches:
            asked, known = [], []
            for ref, own, there, back in zip(batch.column(0).to_pylist(), *batch.columns[3:]):
                own = own.values.to_numpy()
                known.append(np.zeros(0, np.int64))
                if there.is_valid:
                    there, back = there.values.to_numpy(), back.values.to_numpy()
                    known[-1], own = back[~np.isin(there, own)], own[~np.isin(own, there)]
                may = has_hash(shared.value, xxhash_longs(np.full(len(own), ref), own))
                asked.append(own[may])
                known[-1] = np.append(known[-1], own[~may] & ((1 << 56) - 1))  # only this member has them: the rarest
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(asked, kind), pa.array(known, kind)], ["ref", "id", "n", "asked", "known"])

    held = differing.join(turned, "ref", "left").select("ref", "id", "n", "units", "there", "back").mapInArrow(turn, "ref long, id long, n long, asked array<long>, known array<long>")
    held = staged(held, "crowd-differences")
    #: Differences that most members have, or only one, are no rows of their own.
    own = held.select("ref", "id", F.explode("asked").alias("unit")).join(plain.select("ref", "unit", "key"), ["ref", "unit"]).groupBy("ref", "id").agg(F.collect_list("key").alias("keys"))
    return held.join(own, ["ref", "id"], "left").select("ref", "id", "n", F.sort_array(F.concat(F.coalesce("keys", F.array().cast("array<bigint>")), "known")).alias("d"))


def _shared(slack: str) -> str:
    """How many differences two documents share at least whose slacks add up to that, if they are alike."""
    return f"greatest(1, CAST(ceil(({slack}) / 2 - {EPS}) AS int))"


def candidates(differing: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of ids to be compared: all pairs of one crowd that reach the threshold are among them, or joined by those with the hub.

    `differing` holds ref, id, n (units of the document) and units (in which it differs from ref), `members` holds ref, id and root. Pairs of
    one root are left out. Without rows there are no pairs.
    """
    r = (1 - threshold) / (1 + threshold)
    docs = grounded(differing).join(members, ["ref", "id"]).select("ref", "id", "root", "d", F.size("d").alias("size"), (F.size("d") - r * F.col("n")).alias("s"))
    docs = staged(docs, "crowd-members")
    hubs = docs.groupBy("ref").agg(F.min(F.struct("s", "id", "root")).alias("hub"))
    docs = docs.join(hubs, "ref").withColumn("near", F.expr(f"s + hub.s <= {EPS} OR root = hub.root"))
    joined = docs.where("near AND root <> hub.root").select("id", F.col("hub.id").alias("other"))
    outside = docs.where("NOT near").groupBy("ref").agg(F.min("s").alias("least"))
    docs = docs.join(outside, "ref").withColumn("short", F.expr(f"size - {_shared('s + least')} + 1")).withColumn("long", F.expr(f"CASE WHEN near THEN short ELSE size - {_shared('s + hub.s')} + 1 END"))
    #: A difference that only one has joins nothing; these come first.
    docs = docs.withColumn("lone", F.expr(f"size(filter(d, k -> k < {1 << 56}))"))
    rows = docs.select("ref", "id", "root", "near", "s", "size", "short", "lone", F.posexplode(F.expr("slice(d, lone + 1, greatest(0, long - lone))")).alias("at", "key"))
    rows = staged(rows.withColumn("at", F.expr("at + lone")).drop("lone"), "crowd-prefixes")
    x, y = rows.where("NOT near").alias("x"), rows.where("at < short").alias("y")
    enough = f"(x.s + y.s) / 2 - {EPS} <= least(x.size - x.at, y.size - y.at)"
    same = F.expr("x.ref = y.ref AND x.key = y.key AND x.root <> y.root AND (y.near OR (x.at < x.short AND x.id < y.id))")
    met = x.join(y, same & F.expr(enough)).select(F.col("x.id").alias("id"), F.col("y.id").alias("other"))
    return met.unionByName(joined).select(F.greatest("id", "other").alias("a"), F.least("id", "other").alias("b")).distinct()
