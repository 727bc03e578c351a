"""Near-duplicates by BagMinHash: signatures of weighted word shingles, banding, and verified multiset overlap.

A document is the multiset of its five-word shingles. For every shingle, weights are cut into the dyadic intervals (0,1], (1,2], (2,4], ...;
each interval carries a Poisson process of points (time, register, weight level) that depends on the shingle and the interval alone, and a
point counts for a document if its level does not exceed the shingle's multiplicity there. The earliest time in each register is the
signature; two documents agree in a register with the probability of their weighted Jaccard similarity. Points later than a bound that
all registers meet with high probability are never made; a document with an empty register is done again with twice the bound.

Before texts are compared, sketches of one bit a register rule out pairs that are clearly less alike. Documents with equal multisets are one
representative from the start. Representatives that share a band are compared with one pivot of the bucket, and pairs that hold are joined to
components. A bucket that then still holds many members of different components is keyed anew (`crowds.py`): by what tells its members from
their common ground, so that only members meet that share as rare a difference as a link needs. In the other buckets, which are small, members
of different components meet further pivots. So every pair of a bucket is compared, ruled out exactly, or already in one class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.arrays import Rolling, mixed, row_slices, text_buffers, words_of
from plumbline.llm.components import SMALL, components, narrow, sent
from plumbline.llm.crowds import candidates, references
from plumbline.llm.filters import bit_table, where_bit
from plumbline.llm.shared import staged

SHINGLE = 5
THRESHOLD = 0.8
#: Eight registers a band keep documents apart that share a passage only: at a similarity of 0.4 two meet in a band with probability 0.0007.
BANDS, BAND_ROWS = 72, 8
#: Rows of one slice, so that row and shingle hash fit into one 64-bit sort key.
ROW_BITS = 12
HASH_BITS = 64 - ROW_BITS
#: Bytes of text that points are drawn for at once, and that are hashed at once; signatures that keys are made of at once.
DRAWN_BYTES = 1 << 20
HASHED_BYTES = 1 << 16
KEYED_ROWS = 256
#: Buckets with more open members after the first round are crowds.
CROWD = 16
#: Most pivots of another bucket in a round: four after the first round, then as many as it has members.
PIVOTS = 16


def shingles(data: np.ndarray, bounds: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, shingle (52-bit hash) and multiplicity, ordered by row and shingle. A text of fewer words, but not none, is one shingle."""
    hashes, _, _, at = words_of(data, bounds)
    roll = Rolling(hashes)
    counts = np.diff(at)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    rows = np.repeat(np.arange(len(n)), n)
    start = at[rows] + np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
    own = roll.of(start, np.minimum(start + size, at[rows + 1]))
    key = np.sort((rows.astype(np.uint64) << np.uint64(HASH_BITS)) | (own >> np.uint64(ROW_BITS)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    weight = np.diff(np.append(at, len(key)))
    key = key[at]
    return (key >> np.uint64(HASH_BITS)).astype(np.int64), key & np.uint64((1 << HASH_BITS) - 1), weight


def bags(bounds: np.ndarray, data: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """First row, bounds and `shingles` of stretches of rows: as long as points are best drawn for at once, hashed in shorter ones, so that
    numbers are held for each shingle of a stretch but for each byte of a few texts only."""
    for a, b in row_slices(bounds, DRAWN_BYTES):
        for a in range(a, b, 1 << ROW_BITS):
            own = bounds[a : min(b, a + (1 << ROW_BITS)) + 1]
            found = []
            for x, y in row_slices(own, HASHED_BYTES):
                rows, shingle, weight = shingles(data[own[x] : own[y]], own[x : y + 1] - own[x])
                found.append((rows + x, shingle, weight))
            yield a, own, *(np.concatenate(x) for x in zip(*found))


def _uniform(x: np.ndarray) -> np.ndarray:
    """(0, 1] from the top 53 bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def _arrivals(out: np.ndarray, registers: int, row: np.ndarray, seed: np.ndarray, limit: np.ndarray, weights: tuple[np.ndarray, ...] | None = None) -> None:
    """Put the points of each process before its limit into `out`. `weights` are multiplicity, lower end and length of the interval; without
    them it is (0,1], which every multiplicity covers."""
    time = np.zeros(len(row))
    while len(row):
        seed = seed + np.uint64(0xD1342543DE82EF95)
        a = mixed(seed)
        step = -np.log(_uniform(a))
        time = time + (step if weights is None else step / weights[2])
        live = np.flatnonzero(time < limit)
        row, seed, time, limit, b = row[live], seed[live], time[live], limit[live], mixed(a[live] ^ np.uint64(0xA24BAED4963EE407))
        at = row * registers + ((b & np.uint64(0xFFFFFFFF)).astype(np.int64) * registers >> 32)
        if weights is None:
            np.minimum.at(out, at, time)
            continue
        weights = tuple(x[live] for x in weights)
        #: The level of a point inside its interval: each binary digit sends it to one half of what is left.
        level = weights[1] + 1 + (((b >> np.uint64(32)).astype(np.int64) * weights[2]) >> 32)
        counts = level <= weights[0]
        np.minimum.at(out, at[counts], time[counts])


def signatures(rows: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_rows: int, registers: int) -> np.ndarray:
    """Earliest times, one line for each row; infinite where a row has no shingle."""
    total = np.bincount(rows, weights=weight, minlength=n_rows)
    out = np.full(n_rows * registers, np.inf)
    todo = np.flatnonzero(total > 0)
    slack = 3.0
    while len(todo):
        bound = np.zeros(n_rows)
        bound[todo] = (np.log(registers) + slack) * registers / total[todo]
        use = bound[rows] > 0
        r, s, w = rows[use], shingle[use] * np.uint64(64), weight[use]
        _arrivals(out, registers, r, mixed(s), bound[r])
        more = w > 1
        r, s, w = r[more], s[more], w[more]
        pieces = np.ceil(np.log2(w)).astype(np.int64)
        which = np.repeat(np.arange(len(r)), pieces)
        low = np.int64(1) << (np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        r, w = r[which], w[which]
        _arrivals(out, registers, r, mixed(s[which] + low.astype(np.uint64) + np.uint64(1 << 58)), bound[r], (w, low, low))
        empty = np.isinf(out.reshape(n_rows, registers)[todo]).any(axis=1)
        todo = todo[empty]
        out.reshape(n_rows, registers)[todo] = np.inf
        slack *= 2
    return out.reshape(n_rows, registers)


def band_keys(signature: np.ndarray, bands: int, band_rows: int) -> np.ndarray:
    bits = signature.view(np.uint64).reshape(len(signature), bands, band_rows)
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), (len(signature), 1))
    for k in range(band_rows):
        key = mixed(key + bits[:, :, k])
    return key.view(np.int64)


def sketches(signature: np.ndarray) -> np.ndarray:
    """One bit of each register, packed into 64-bit numbers: they agree in a bit with probability (1 + similarity) / 2."""
    bits = np.packbits(mixed(signature.view(np.uint64)) >> np.uint64(63) == 1, axis=1)
    return np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8))).view(np.int64)


def may_be_alike(one: str, other: str, registers: int, threshold: float) -> str:
    """SQL condition on two sketches; a pair at the threshold fails it with probability 3e-7 (five standard deviations)."""
    agree = (1 + threshold) / 2
    most = registers * (1 - agree) + 5 * (registers * agree * (1 - agree)) ** 0.5
    return " + ".join(f"bit_count({one}[{k}] ^ {other}[{k}])" for k in range(-(-registers // 64))) + f" <= {most}"


def signed(docs: DataFrame, bands: int, band_rows: int) -> DataFrame:
    """doc_id, a 128-bit name of the multiset (or of the text, where it has no words), the band keys (none without words) and the sketch."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_buffers(batch.column(1))
            for a, own, rows, shingle, weight in bags(bounds, data):
                n = len(own) - 1
                edges = np.searchsorted(rows, np.arange(n + 1))
                unit = mixed(shingle * np.uint64(0x2545F4914F6CDD1D) + weight.astype(np.uint64))
                names = [Rolling(unit, salt).of(edges[:-1], edges[1:]) for salt in (1, 2)]
                bare = edges[1:] == edges[:-1]
                for k in np.flatnonzero(bare):
                    plain = data[own[k] : own[k + 1]].astype(np.uint64)
                    for name, salt in zip(names, (3, 5)):
                        name[k : k + 1] = Rolling(plain + np.uint64(salt)).of(np.array([0]), np.array([len(plain)]))
                signature = signatures(rows, shingle, weight, n, bands * band_rows)
                parts = [signature[k : k + KEYED_ROWS] for k in range(0, n, KEYED_ROWS)]
                keys, sketch = np.concatenate([band_keys(x, bands, band_rows) for x in parts]), np.concatenate([sketches(x) for x in parts])
                bits = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * sketch.shape[1], pa.int32()), pa.array(sketch.ravel()))
                full = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.where(bare, 0, bands))), pa.int32()), pa.array(keys[~bare].ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), *(pa.array(x.view(np.int64)) for x in names), full, bits], ["doc_id", "name_a", "name_b", "bands", "sketch"])

    return docs.mapInArrow(sign, "doc_id long, name_a long, name_b long, bands array<long>, sketch array<long>")


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets (sorted shingles, multiplicities)."""
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    both = int(np.minimum(a[1], b[1][at])[b[0][at] == a[0]].sum())
    return both / (int(a[1].sum()) + int(b[1].sum()) - both)


def multisets(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Shingles (sorted) and multiplicities of each text."""
    found = []
    data, bounds = text_buffers(column)
    for _, own, rows, shingle, weight in bags(bounds, data):
        edges = np.searchsorted(rows, np.arange(len(own)))
        found.extend((shingle[x:y], weight[x:y]) for x, y in zip(edges[:-1], edges[1:]))
    return found


def with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b and their texts; the last shuffle is by b, so an `a` that many pairs hold is not in one task."""
    held = pairs.join(texts.withColumnsRenamed({"doc_id": "a", "text": "text_a"}), "a").join(texts.withColumnsRenamed({"doc_id": "b", "text": "text_b"}), "b")
    return held.select("a", "b", "text_a", "text_b")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of document ids whose multisets overlap enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                kept = [overlap(x, y) >= threshold for x, y in zip(multisets(part.column(2)), multisets(part.column(3)))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return with_texts(pairs, texts).mapInArrow(compare, "a long, b long")


def units(bag: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The multiset as a set of 64-bit hashes: one for each copy of each shingle."""
    shingle, weight = bag
    copy = np.arange(int(weight.sum())) - np.repeat(np.cumsum(weight) - weight, weight)
    return mixed(mixed(np.repeat(shingle, weight)) + copy.astype(np.uint64))


def differences(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """For each pair (a, b): the units that only one of the two has, and the number of units of b."""

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                own = [units(x) for x in multisets(part.column(3))]
                found = [np.setxor1d(units(x), y).view(np.int64) for x, y in zip(multisets(part.column(2)), own)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(x) for x in own], pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["ref", "id", "n", "units"])

    return with_texts(pairs, texts).mapInArrow(differ, "ref long, id long, n long, units array<long>")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, band_rows: int = BAND_ROWS) -> DataFrame:
    """doc_id and class_id for each row of `docs` (doc_id, text): class_id is the smallest doc_id among the documents linked to it.

    Two documents are linked if the weighted Jaccard similarity of their five-word shingles is `threshold` or more; classes are the connected
    components. A text of one to four words is one shingle. A text without words is linked with texts of exactly the same bytes alone. NULL
    text and NULL doc_id: a class of its own, named by the doc_id. Rows that share a doc_id share a class; of different texts under one doc_id
    the smallest text is compared. Other columns are ignored. With 72 bands of 8 registers a pair at 0.8 is missed with probability 2e-6.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    judged = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    signs = staged(signed(judged, bands, band_rows), "signed")
    reps = staged(signs.groupBy("name_a", "name_b").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "sets")
    rows = reps.select(F.col("rep").alias("id"), F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).where("pivot < last").select("bucket", "pivot")
    members = rows.join(shared, "bucket").groupBy("id").agg(F.collect_list(F.struct("bucket", "pivot")).alias("held"))  # a document is in `bands` buckets at most
    members = staged(members.join(reps.select(F.col("rep").alias("id"), "sketch"), "id").select("id", "sketch", F.inline("held")), "buckets")
    alike = may_be_alike("sketch", "p.sketch", bands * band_rows, threshold)
    first = members.where("id = pivot").select("bucket", F.struct("id", "sketch").alias("p"))
    pairs = members.where("id <> pivot").join(first, "bucket").where(alike).select(F.col("id").alias("a"), F.col("p.id").alias("b")).distinct()
    asked = members.select("id").distinct()
    texts = where_bit(judged, F.xxhash64("doc_id"), bit_table(asked.select(F.xxhash64("id").alias("id"))))
    texts = texts.join(asked, F.col("doc_id") == F.col("id"), "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    texts = staged(texts, "texts")  # of documents that share a band, once for all rounds
    links = staged(verified(pairs, texts, threshold), "links")
    #: Rows whose doc_id repeats may stand in several sets: those are one document.
    same = signs.join(reps.drop("bands", "sketch"), ["name_a", "name_b"]).where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    open_ = members.where("id <> pivot").select("bucket", "id", "sketch")
    roots, turn, rows = components(links), 0, None
    while True:
        #: Once the open rows are few, what is made of them is broadcast.
        small = rows is not None and rows <= SMALL
        known = sent(roots.withColumnRenamed("node", "id"), roots.count() <= SMALL)
        labelled = narrow(open_, small).join(known, "id", "left").select("bucket", "id", "sketch", F.coalesce("root", "id").alias("root"))
        split = labelled.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("bucket")
        open_ = staged(narrow(labelled.join(sent(split, small), "bucket"), small), "open")
        rows = open_.count()
        if not rows:
            break
        turn, small = turn + 1, rows <= SMALL
        if turn == 1 and not (crowds := staged(references(open_, CROWD), "crowds")).isEmpty():
            crowded = staged(open_.join(crowds, "bucket").select("ref", "id", "root").distinct(), "crowded")
            differing = staged(differences(crowded.select(F.col("ref").alias("a"), F.col("id").alias("b")), texts), "differences")
            pairs = candidates(differing, crowded, threshold)
            sides = [open_.select(F.col("id").alias(x), F.col("sketch").alias(f"sketch_{x}")).dropDuplicates([x]) for x in "ab"]
            pairs = pairs.join(sides[0], "a").join(sides[1], "b").where(may_be_alike("sketch_a", "sketch_b", bands * band_rows, threshold))
            fresh = staged(verified(pairs.select("a", "b"), texts, threshold), "links")
            roots = components(fresh.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
            open_ = open_.join(crowds, "bucket", "left_anti").select("bucket", "id", "sketch")
            continue
        held = narrow(open_, small)
        pivots = held.groupBy("bucket", F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(min(PIVOTS, 4**turn))).alias("slot")).agg(F.min(F.struct("id", "root", "sketch")).alias("p")).select("bucket", "p")
        pivots = staged(narrow(pivots, small), "pivots")
        pairs = held.join(sent(pivots, small), "bucket").where("id <> p.id AND root <> p.root").where(alike).select(F.greatest("id", "p.id").alias("a"), F.least("id", "p.id").alias("b")).distinct()
        fresh = staged(verified(pairs, texts, threshold), "links")
        if not fresh.isEmpty():
            roots = components(fresh.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
        done = pivots.select("bucket", F.col("p.id").alias("id"))
        open_ = held.join(sent(done, small), ["bucket", "id"], "left_anti").select("bucket", "id", "sketch")
    if not signs.groupBy("doc_id").agg(F.min("name_a").alias("x"), F.max("name_a").alias("y")).where("x <> y").isEmpty():
        roots = components(same.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    named = signs.select("doc_id", "name_a", "name_b").join(reps.drop("bands", "sketch"), ["name_a", "name_b"])
    named = named.join(roots.withColumnRenamed("node", "rep"), "rep", "left").groupBy("doc_id").agg(F.min(F.coalesce("root", "rep")).alias("class_id"))
    return docs.select("doc_id").join(named, "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
