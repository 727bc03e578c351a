"""Finding the places where a repeated window of text may stand, by content alone: shared by the two operators on repeated passages.

A window is `window` units (words or bytes). Its anchor is the stretch of `gram` units in it with the smallest hash, the first such if hashes
are equal; equal windows have equal anchors at the same place in them. Neighbouring windows of a document with the same anchor are a run.
Whatever stands in two places stands in runs of the same anchor. So:

1. count anchors over all documents (partial sums before the shuffle) and keep a fixed-size bitmap of those that occur twice;
2. name the runs of such anchors by a hash of their content, and find the first place of each content: every later place of the same
   content is repeated as a whole;
3. where an anchor has several contents, only the first place of each has to be compared with the others, window by window. Those contents
   travel, grouped by anchor, to shards of bounded size. There windows go whose longer side around the anchor stands in no other content of
   it (what a short common line is surrounded by is different in each document), and the rest meets in the operator's own text index.

An anchor with more than HOT contents (a common passage with varied text around it) is not given to one shard: its windows, without those that
go in the same way, are named by 128-bit hashes in stretches of neighbouring ones, and first places are grouped minima. A stretch that stands
nowhere earlier as a whole is cut into shorter ones, down to single windows, but only if what all windows of it have in common stands in another
such stretch: else none of its windows stands elsewhere.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.arrays import Rolling, mixed, row_slices, text_buffers
from plumbline.llm.filters import has_hash, member_bits, xxhash_longs
from plumbline.llm.shared import staged

PLACE_BITS = 28
#: Bytes of one slice: its arrays of 64-bit numbers stay in a core's cache.
SLICE_BYTES = 1 << 16
#: Contents of one anchor beyond which it is not compared in one shard.
HOT = 512
#: Neighbouring windows of such an anchor that are named together: first, then within what has to be cut, and so on.
STRETCHES = (8, 2, 1)
#: Bytes of contents in one shard.
SHARD_BYTES = 1 << 18


@dataclass
class Kind:
    """What a unit is: `units` gives hashes of the units of a slice, the byte each starts and ends at, and the row bounds in units."""

    units: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray | None, np.ndarray | None, np.ndarray]]
    window: int
    gram: int


@dataclass
class Runs:
    row: np.ndarray
    start: np.ndarray  # first window, in units of its document
    windows: np.ndarray
    anchor: np.ndarray
    name: np.ndarray
    at: np.ndarray  # first unit, in the slice


def runs_of(units: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> Runs:
    """All runs of the rows, in order."""
    wide = window - gram + 1
    n = len(units) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return Runs(none, none, none, none.view(np.uint64), none.view(np.uint64), none)
    roll = Rolling(units)
    grams = mixed((roll.sums[gram:] - roll.sums[:-gram]) * roll.down[: len(units) - gram + 1])
    keys = (grams & ~np.uint64((1 << PLACE_BITS) - 1)) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while span * 2 <= wide:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    keys = np.minimum(keys[:n], keys[wide - span : wide - span + n]) if span < wide else keys[:n]
    place = (keys & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    sizes = np.diff(bounds)
    inside = np.zeros(n + 1, np.int64)
    long = sizes >= window
    np.add.at(inside, bounds[:-1][long], 1)
    np.add.at(inside, np.minimum(bounds[1:][long] - window + 1, n), -1)
    inside = np.cumsum(inside)[:n] > 0
    new = inside.copy()
    new[1:] &= (place[1:] != place[:-1]) | ~inside[:-1]
    edges = bounds[:-1][long]
    new[edges] = True
    first = np.flatnonzero(new)
    if not len(first):
        return Runs(none, none, none, none.view(np.uint64), none.view(np.uint64), none)
    last = np.maximum.reduceat(np.where(inside, np.arange(n), -1), first)
    row = np.searchsorted(bounds, first, side="right") - 1
    return Runs(row, first - bounds[row], last - first + 1, grams[place[first]], roll.of(first, last + window), first)


def slices(batch: pa.RecordBatch, kind: Kind) -> Iterator[tuple]:
    """Runs of a batch (doc_id, text) slice by slice: doc_ids, runs with document starts, bytes, and the byte bounds of each unit.

    A long document is cut into stretches of windows: a run that is cut is two runs, which changes no result.
    """
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    data, bounds = text_buffers(batch.column(1))
    for a, b in row_slices(bounds, SLICE_BYTES):
        own = bounds[a : b + 1]
        text = data[own[0] : own[-1]]
        units, starts, ends, at = kind.units(text, own - own[0])
        if b - a > 1 or len(units) <= 2 * SLICE_BYTES:
            yield ids[a:b], runs_of(units, at, kind.window, kind.gram), text, starts, ends
            continue
        for s in range(0, max(1, len(units) - kind.window + 1), SLICE_BYTES):
            e = min(len(units), s + SLICE_BYTES + kind.window - 1)
            found = runs_of(units[s:e], np.array([0, e - s]), kind.window, kind.gram)
            found.start, found.at = found.start + s, found.at + s
            yield ids[a:b], found, text, starts, ends


def _anchor_counts(docs: DataFrame, kind: Kind) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, found, *_ in slices(batch, kind):
                anchors, n = np.unique(found.anchor, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(anchors.view(np.int64)), pa.array(np.minimum(n, 2).astype(np.int8))], ["anchor", "n"])

    return docs.mapInArrow(count, "anchor long, n byte").groupBy("anchor").agg(F.sum("n").alias("n"))


def _runs(docs: DataFrame, kind: Kind, shared: Broadcast) -> DataFrame:
    """Runs of anchors that may stand twice. A run that follows itself at once, as in text of one repeated word, is one row with a count."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, found, *_ in slices(batch, kind):
                k = np.flatnonzero(has_hash(shared.value, found.anchor))
                anchor, name, row, start, windows = found.anchor[k], found.name[k], found.row[k], found.start[k], found.windows[k]
                new = np.ones(len(k), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (name[1:] != name[:-1]) | (row[1:] != row[:-1]) | (start[1:] != start[:-1] + windows[:-1]) | (windows[1:] != windows[:-1])
                at = np.flatnonzero(new)
                repeats = np.diff(np.append(at, len(k)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (anchor[at].view(np.int64), name[at].view(np.int64), ids[row[at]], start[at], windows[at].astype(np.int32), repeats.astype(np.int32))],
                    ["anchor", "name", "doc_id", "start", "windows", "repeats"])

    return docs.mapInArrow(emit, "anchor long, name long, doc_id long, start long, windows int, repeats int")


def _contents(docs: DataFrame, kind: Kind, shared: Broadcast, wanted: Broadcast) -> DataFrame:
    """Bytes of the runs whose place may be wanted."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, found, text, starts, ends in slices(batch, kind):
                k = np.flatnonzero(has_hash(shared.value, found.anchor) & has_hash(wanted.value, xxhash_longs(ids[found.row], found.start)) if len(found.row) else found.row)
                first, last = found.at[k], found.at[k] + found.windows[k] + kind.window - 1
                if starts is not None:
                    first, last = starts[first], ends[last - 1]
                content = [text[a:b].tobytes() for a, b in zip(first.tolist(), last.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (found.anchor[k].view(np.int64), found.name[k].view(np.int64), ids[found.row[k]], found.start[k])] + [pa.array(content, pa.binary())],
                    ["anchor", "name", "doc_id", "start", "content"])

    return docs.mapInArrow(emit, "anchor long, name long, doc_id long, start long, content binary")


GONE = "anchor long, name long, gone array<struct<first:int,last:int>>"


def gone_rows(keys: list[tuple[int, int]], flags: list[np.ndarray]) -> pa.RecordBatch:
    """Runs with windows that also stand earlier, as stretches of windows."""
    anchors, names, gone = [], [], []
    for (anchor, name), f in zip(keys, flags):
        if f.any():
            edge = np.flatnonzero(np.diff(np.concatenate(([False], f, [False])).astype(np.int8)))
            anchors.append(anchor)
            names.append(name)
            gone.append([{"first": int(a), "last": int(b) - 1} for a, b in zip(edge[::2], edge[1::2])])
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    return pa.RecordBatch.from_arrays([pa.array(anchors, pa.int64()), pa.array(names, pa.int64()), pa.array(gone, kind)], ["anchor", "name", "gone"])


def _anchored(content: list[bytes], anchor: np.ndarray, kind: Kind) -> tuple:
    """Of contents and their anchors: hashes over all units, the byte each starts and ends at, bounds in units, and the unit that each anchor begins at."""
    bounds = np.append(0, np.cumsum([len(c) for c in content]))
    units, starts, ends, at = kind.units(np.frombuffer(b"".join(content), np.uint8), bounds)
    roll = Rolling(units)
    grams = mixed((roll.sums[kind.gram :] - roll.sums[: -kind.gram]) * roll.down[: len(units) - kind.gram + 1])
    anchors = np.repeat(anchor.view(np.uint64), np.diff(at))[: len(grams)]
    found = np.where(grams == anchors, np.arange(len(grams)), len(units))
    return units, starts, ends, at, np.minimum.reduceat(found, at[:-1])


def _parts(batch: pa.RecordBatch, kind: Kind) -> Iterator[tuple]:
    """Of runs with their contents (anchor, name, doc_id, start, content): rows, and what `_anchored` tells of them."""
    content = batch.column(4).to_pylist()
    for k in range(0, batch.num_rows, 4096):
        part = content[k : k + 4096]
        own = batch.slice(k, len(part))
        yield own, *_anchored(part, own.column(0).to_numpy(), kind)


def _windows_between(head: np.ndarray, tail: np.ndarray, at: np.ndarray, place: np.ndarray, half: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """First window of each content, and the one behind the last, without those whose longer side is before the anchor (unless `head`) or
    behind it (unless `tail`)."""
    n = np.diff(at) - window + 1
    by_head = np.clip(place - half - at[:-1] + 1, 0, n)
    return np.where(head, 0, by_head), np.where(tail, n, by_head)


def _sides(rows: DataFrame, kind: Kind) -> DataFrame:
    """(anchor, name, head, tail): of a window, the units before its anchor or those behind it make up half of the rest. So only windows
    whose longer side stands in another content of the same anchor can stand there as a whole."""
    half = (kind.window - kind.gram) // 2

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, units, _, _, at, place in _parts(batch, kind):
                roll = Rolling(units, 7)
                for tail in (0, 1):
                    first, last = (place - half, place + kind.gram) if not tail else (place, place + kind.gram + half)
                    row = np.flatnonzero((first >= at[:-1]) & (last <= at[1:]))
                    keys = roll.of(first[row], last[row]).view(np.int64)
                    take = [own.column(c).take(pa.array(row)) for c in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*take, pa.array(np.full(len(row), tail, np.int8)), pa.array(keys)], ["anchor", "name", "tail", "key"])

    sides = staged(rows.select("anchor", "name", "doc_id", "start", "content").mapInArrow(emit, "anchor long, name long, tail byte, key long"), "sides")
    shared = sides.groupBy("anchor", "tail", "key").agg(F.min("name").alias("x"), F.max("name").alias("y")).where("x <> y").drop("x", "y")
    return sides.join(shared, ["anchor", "tail", "key"], "left_semi").groupBy("anchor", "name").agg(F.max(F.col("tail") == 0).alias("head"), F.max(F.col("tail") == 1).alias("tail"))


def repeatable(content: list[bytes], anchor: np.ndarray, kind: Kind) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Of all contents of some anchors: those with windows that can stand in another content as a whole (see `_sides`), the first such window
    and the content from it to the last such window. Two texts that share a key by chance are kept as well."""
    units, starts, ends, at, place = _anchored(content, anchor, kind)
    roll, whole = Rolling(units), b"".join(content)
    half = (kind.window - kind.gram) // 2
    sides = []
    for first, last in ((place - half, place + kind.gram), (place, place + kind.gram + half)):
        row = np.flatnonzero((first >= at[:-1]) & (last <= at[1:]))
        _, which, times = np.unique(mixed(roll.of(first[row], last[row]) + mixed(anchor[row].view(np.uint64))), return_inverse=True, return_counts=True)
        sides.append(np.zeros(len(content), bool))
        sides[-1][row] = times[which] > 1
    first, last = _windows_between(*sides, at, place, half, kind.window)
    kept = np.flatnonzero(first < last)
    a, b = at[:-1][kept] + first[kept], at[:-1][kept] + last[kept] + kind.window - 1
    if starts is not None:
        a, b = starts[a], ends[b - 1]
    return kept, first[kept], [whole[x:y] for x, y in zip(a.tolist(), b.tolist())]


def _stretches(rows: DataFrame, kind: Kind, width: int) -> DataFrame:
    """The windows of `rows` (anchor, name, doc_id, start, content, head, tail, base) in stretches of `width`, counted from the anchor: 128-bit
    name (x, y), first and last window, what they cover, and a hash of what all windows of a full stretch there have in common (core). `base`
    is added to the windows; of those with the longer side before (behind) the anchor, none are made where `head` (`tail`) is false. Equal
    stretches of an anchor are at the same distance from it."""
    half = (kind.window - kind.gram) // 2

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, units, starts, ends, at, place in _parts(batch, kind):
                head, tail, base = (own.column(c).to_numpy(zero_copy_only=False) for c in (5, 6, 7))
                low, high = _windows_between(head, tail, at, place, half, kind.window)
                before = place - at[:-1]  # units before the anchor
                top = (before - low) // width
                n = np.where(low < high, top - (before - high + 1) // width + 1, 0)
                row = np.repeat(np.arange(own.num_rows), n)
                step = top[row] - np.arange(len(row)) + np.repeat(np.cumsum(n) - n, n)
                first = np.maximum(low[row], before[row] - (step + 1) * width + 1)
                last = np.minimum(high[row] - 1, before[row] - step * width)
                a, b = at[row] + first, at[row] + last + kind.window
                names = [Rolling(units, salt).of(a, b).view(np.int64) for salt in (1, 2)]
                farthest = np.minimum((step + 1) * width - 1, kind.window - kind.gram)
                core = Rolling(units, 3).of(place[row] - step * width, place[row] - farthest + kind.window).view(np.int64)
                if starts is not None:
                    a, b = starts[a], ends[b - 1]
                data = own.column(4).to_pylist() if width > 1 else None
                whole = b"".join(data) if data else b""
                content = pa.array([whole[x:y] for x, y in zip(a.tolist(), b.tolist())] if data else [None] * len(row), pa.binary())
                take = [own.column(c).take(pa.array(row)) for c in range(4)]
                shifts = [pa.array((base[row] + x).astype(np.int32)) for x in (first, last)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, names), *take, *shifts, content, pa.array(core)], ["x", "y", "anchor", "name", "doc_id", "start", "first", "last", "content", "core"])

    return rows.select("anchor", "name", "doc_id", "start", "content", "head", "tail", "base").mapInArrow(
        emit, "x long, y long, anchor long, name long, doc_id long, start long, first int, last int, content binary, core long")


def _hot_windows(rows: DataFrame, kind: Kind, by_document: bool, widths: tuple[int, ...] = STRETCHES) -> DataFrame:
    """The same answer for anchors with very many contents: first places by grouped minima, of stretches of windows, then of shorter ones
    within those that stand nowhere earlier as a whole and whose core another one of them has, too. The last of `widths` is 1."""
    place = F.struct("doc_id") if by_document else F.struct("doc_id", (F.col("start") + F.col("first")).alias("at"))
    rows = staged(rows.select("anchor", "name", "doc_id", "start", "content"), "hot-contents")
    rows, gone = rows.join(_sides(rows, kind), ["anchor", "name"]).withColumn("base", F.lit(0)), []
    for width in widths:
        parts = staged(_stretches(rows, kind, width), "hot-stretches" if width > 1 else "hot-windows")
        earliest = parts.groupBy("x", "y").agg(F.min(place).alias("least"))
        parts = parts.join(earliest, ["x", "y"]).withColumn("later", F.col("least") < place).drop("x", "y", "least")
        if width > 1:
            parts = staged(parts, "hot-judged")
            fresh = parts.where("NOT later")
            cores = fresh.groupBy("anchor", "core").agg(F.min("name").alias("a"), F.max("name").alias("b")).where("a <> b").select("anchor", "core")
            rows = fresh.join(cores, ["anchor", "core"], "left_semi").select("anchor", "name", "doc_id", "start", "content", F.lit(True).alias("head"), F.lit(True).alias("tail"), F.col("first").alias("base"))
        gone.append(parts.where("later").select("anchor", "name", F.struct("first", "last").alias("g")))
    return reduce(DataFrame.unionByName, gone).groupBy("anchor", "name").agg(F.sort_array(F.collect_set("g")).alias("gone"))


def repeated_spans(docs: DataFrame, kind: Kind, compare: Callable[[list[bytes], list[int], list[int]], list[np.ndarray]], by_document: bool, hot: int = HOT, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id and spans (array of first and last unit, not yet merged) of the windows that also stand earlier.

    `compare` takes contents, doc_ids and starts of one shard and answers, for each, which of its windows stand in another one of a smaller
    doc_id (or, unless `by_document`, of the same one at an earlier place). `docs` is (doc_id, text) without NULLs.
    """
    counts = _anchor_counts(docs, kind)
    shared = member_bits(counts.where("n > 1").select("anchor"), hashed=True)
    runs = staged(_runs(docs, kind, shared), "runs")
    firsts = runs.groupBy("anchor", "name").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.sum("repeats").alias("places"), F.min("doc_id").alias("x"), F.max("doc_id").alias("y"))
    firsts = staged(firsts, "first-runs")
    crowd = firsts.groupBy("anchor").agg(F.count("*").alias("contents"), F.min("x").alias("x"), F.max("y").alias("y")).where("contents > 1" + (" AND x < y" if by_document else ""))
    contested = firsts.join(crowd.select("anchor", "contents"), "anchor").select("anchor", "name", "contents", F.col("first.doc_id").alias("doc_id"), F.col("first.start").alias("start"))
    contested = staged(contested, "contested-runs")
    wanted = member_bits(contested.select(F.xxhash64("doc_id", "start").alias("at")), hashed=True)
    texts = staged(_contents(docs, kind, shared, wanted).join(contested, ["anchor", "name", "doc_id", "start"]).dropDuplicates(["anchor", "name"]), "contents")
    size = texts.where(F.col("contents") <= hot).agg(F.coalesce(F.sum(F.octet_length("content")), F.lit(0))).first()[0]
    shards = max(1, -(-int(size) // shard_bytes))

    def answer(table: pa.Table) -> pa.Table:
        anchor, name, ids, starts = (table.column(c).to_numpy() for c in ("anchor", "name", "doc_id", "start"))
        kept, first, content = repeatable(table.column("content").to_pylist(), anchor, kind)
        flags = compare(content, ids[kept].tolist(), (starts[kept] + first).tolist()) if content else []
        flags = [np.append(np.zeros(skip, bool), f) for skip, f in zip(first, flags)]
        return pa.Table.from_batches([gone_rows(list(zip(anchor[kept].tolist(), name[kept].tolist())), flags)])

    cool = texts.where(F.col("contents") <= hot).withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    gone = cool.select("shard", "anchor", "name", "doc_id", "start", "content").groupBy("shard").applyInArrow(answer, GONE)
    gone = gone.unionByName(_hot_windows(texts.where(F.col("contents") > hot), kind, by_document))
    judged = firsts.join(gone, ["anchor", "name"], "left").where("places > 1 OR gone IS NOT NULL").select("anchor", "name", "first", "gone")
    judged = staged(judged, "judged-runs")  # with a plain shuffle on both sides, Spark splits the places of a content that is everywhere
    found = runs.join(judged, ["anchor", "name"])
    is_first = F.col("doc_id") == F.col("first.doc_id")
    if not by_document:
        is_first &= F.col("start") == F.col("first.start")
    def stretch(first: Column, last: Column) -> Column:
        return F.array(F.struct(first.cast("int").alias("first"), last.cast("int").alias("last")))

    none = F.expr("array()").cast("array<struct<first:int,last:int>>")
    own, end = F.coalesce("gone", none), F.col("windows") * F.col("repeats") - 1
    if by_document:  # each repetition in the first document is judged as the first one
        own = F.flatten(F.transform(F.sequence(F.lit(0), F.col("repeats") - 1), lambda k: F.transform(own, lambda g: F.struct((g["first"] + k * F.col("windows")).alias("first"), (g["last"] + k * F.col("windows")).alias("last")))))
    else:  # the second and later repetitions stand later than the first one
        own = F.concat(own, F.when(F.col("repeats") > 1, stretch(F.col("windows"), end)).otherwise(none))
    found = found.select("doc_id", "start", F.explode(F.when(is_first, own).otherwise(stretch(F.lit(0), end))).alias("g"))
    span = F.struct((F.col("start") + F.col("g.first")).alias("first"), (F.col("start") + F.col("g.last") + (kind.window - 1)).alias("last"))
    return found.groupBy("doc_id").agg(F.collect_list(span).alias("spans"))
