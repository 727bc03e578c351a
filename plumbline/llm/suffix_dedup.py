"""Suffix-array dedup of bytes: Burrows-Wheeler transforms of blocks are merged by iterative interleave refinement.

A shard (see `passages`: what can repeat at all, dealt out by anchor) is cut into blocks. Each block has its suffixes sorted once, which gives
its transform and the row each row steps back to. All blocks are then merged together: starting from the rows where windows end, one block
after another, each round puts the rows in the order of their preceding byte, stably, and steps back; after round t the rows of all blocks are
interleaved by their first t bytes. After as many rounds as a window has bytes, the rows stand where windows start, and those that were never
parted are the repeated intervals. No suffix is compared with another or sorted again. A row that is alone in its interval stays alone, and so
do the rows that step back to it; rounds deal with the other rows only, and with no row that no window reaches in that round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.arrays import BYTE_VALUES, joined_ranges, text_buffers, union_length
from plumbline.llm.decontaminate import suffix_array
from plumbline.llm.passages import HOT, SHARD_BYTES, Kind, repeated_spans

WINDOW = 100
GRAM = 32
BLOCK_BYTES = 1 << 16
#: Ends each text of a block; UTF-8 never holds it.
END = 0xFF

RESULT = "doc_id long, n_bytes long, spans array<struct<first:long,last:long>>, kept binary"


class Block:
    """The transform of some texts: for each row, the byte before it, the row of the suffix one byte longer, and its text position; and the
    row of each position."""

    def __init__(self, text: np.ndarray):
        self.order = suffix_array(text.astype(np.int64) + 1)
        self.row = np.empty(len(text), np.int64)
        self.row[self.order] = np.arange(len(text))
        self.before = text[self.order - 1]
        self.back = self.row[self.order - 1]


def merged(blocks: list[Block], depth: int, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of all blocks (numbered one block after another) in the order of their first `depth` bytes, the number of the interval of equal
    prefixes each lies in, and the bytes each has in common with the one before it (at most `depth`). With `ends`, only rows `depth` steps
    back from these, and of them only those that share all these bytes with another one; the first of an interval then has no bytes in common."""
    offset = np.cumsum([0] + [len(b.order) for b in blocks])
    n = int(offset[-1])
    whole = np.int32 if n < 1 << 23 else np.int64  # holds an interval and a byte
    before = np.concatenate([b.before for b in blocks])
    back = np.concatenate([b.back + o for b, o in zip(blocks, offset)]).astype(whole)
    if ends is not None:
        own, group = _reached(before, back, ends.astype(whole), depth)
        return own, group, np.where(np.diff(group, prepend=-1) == 0, depth, 0)
    own = np.arange(n, dtype=whole)
    rows, common = np.arange(n), np.full(n, depth, np.int32)
    #: Rows that share their first k bytes with another one, the places they fill, and the intervals of the rows that step back to them.
    shared, place, group = np.ones(n, bool), rows.copy(), np.zeros(n, whole)
    for k in range(depth):
        stepped = back[own]
        keep = np.flatnonzero(shared[stepped])
        byte = before[own[keep]]
        order = np.argsort(byte, kind="stable")
        keep = keep[order]
        own, key = stepped[keep], (group[keep] << 8) | byte[order]
        parted = np.ones(len(own) + 1, bool)
        parted[1:-1] = key[1:] != key[:-1]
        edge = place[parted[:-1]]
        common[edge] = np.minimum(common[edge], k)  # boundaries never move: a place once parted stays parted
        alone = parted[:-1] & parted[1:]
        rows[place[alone]] = own[alone]
        shared[own[alone]] = False
        place, group = place[~alone], np.cumsum(parted[:-1], dtype=whole)
        if not len(place):
            break
    rows[place] = own[shared[own]]
    common[:1] = depth
    return rows, np.cumsum(common < depth, dtype=np.int32), common


def _reached(before: np.ndarray, back: np.ndarray, own: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """`depth` rounds over the rows that are stepped back to from the rows `own`: those never alone, and the interval of each."""
    group = np.zeros_like(own)
    for _ in range(depth):
        if not len(own):
            break
        byte = before[own]
        order = np.argsort(byte, kind="stable")
        own, key = back[own[order]], (group[order] << 8) | byte[order]
        parted = np.ones(len(own) + 1, bool)
        np.not_equal(key[1:], key[:-1], out=parted[1:-1])
        shared = ~(parted[:-1] & parted[1:])
        own, group = own[shared], np.cumsum(parted[:-1], dtype=own.dtype)[shared]
    return own, group


def repeats(contents: list[bytes], ids: list[int], starts: list[int], window: int, block_bytes: int = BLOCK_BYTES) -> list[np.ndarray]:
    """Which windows of each text also stand at an earlier place (smaller document, or the same and an earlier start)."""
    sizes = np.array([len(c) for c in contents], np.int64)
    at = np.cumsum(np.append(0, sizes + 1))
    whole = np.frombuffer(b"".join(c + bytes([END]) for c in contents), np.uint8)
    cuts = [0]
    for k in range(len(contents)):
        if at[k + 1] - at[cuts[-1]] >= block_bytes or k + 1 == len(contents):
            cuts.append(k + 1)
    blocks = [Block(whole[at[a] : at[b]]) for a, b in zip(cuts[:-1], cuts[1:])]
    windows = np.maximum(0, sizes - window + 1)
    ends = joined_ranges(at[:-1] + window, windows)
    rows, group, _ = merged(blocks, window, np.concatenate([b.row + at[a] for b, a in zip(blocks, cuts)])[ends])
    position = np.concatenate([b.order + at[a] for b, a in zip(blocks, cuts)])[rows]
    text = np.searchsorted(at, position, side="right") - 1
    shift = position - at[text]
    bounds = np.cumsum(np.append(0, windows))
    flags = np.zeros(bounds[-1], bool)
    if len(text):
        doc, place = np.asarray(ids)[text], np.asarray(starts)[text] + shift
        order = np.lexsort((place, doc, group))
        text, shift, group, doc, place = (x[order] for x in (text, shift, group, doc, place))
        head = np.maximum.accumulate(np.where(np.diff(group, prepend=-1) != 0, np.arange(len(group)), 0))
        late = (doc != doc[head]) | (place != place[head])
        flags[bounds[text[late]] + shift[late]] = True
    return [flags[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def _bytes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, None, None, np.ndarray]:
    return BYTE_VALUES[data], None, None, bounds


def without_repeats(docs: DataFrame, window: int = WINDOW, hot: int = HOT, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, spans of removed bytes (maximal, first and last byte) and kept (the other bytes, joined) of each row.

    A byte of the UTF-8 text goes if it lies in `window` bytes that also start earlier: in a document of a smaller doc_id, or in the same one
    further left; such places may overlap, and all is judged on the input. NULL and empty text have no bytes. A text shorter than a window is
    kept whole; what is kept need not be valid UTF-8. A row without doc_id keeps all its bytes and is no earlier place. Rows that share a
    doc_id count as one document that starts at the same place in each: a span found in one is removed from each that is long enough. Other
    columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = Kind(_bytes, window, min(GRAM, window))
    found = repeated_spans(docs.where("doc_id IS NOT NULL AND text IS NOT NULL"), kind, lambda c, i, s: repeats(c, i, s, window), False, hot, shard_bytes)
    joined = docs.join(found.withColumnRenamed("doc_id", "_doc"), F.col("doc_id") == F.col("_doc"), "left").select("doc_id", "text", "spans")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        for batch in batches:
            data, bounds = text_buffers(batch.column(1))
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                removed, kept = [], []
                for row, spans in enumerate(part.column(2)):
                    text = data[bounds[k + row] : bounds[k + row + 1]]
                    s = spans.as_py() or []
                    first, end = union_length(np.array([x["first"] for x in s], np.int64), np.array([x["last"] + 1 for x in s], np.int64))
                    first, end = first[first < len(text)], np.minimum(end[first < len(text)], len(text))
                    kept.append(b"".join(text[x:y].tobytes() for x, y in zip(np.append(0, end), np.append(first, len(text)))))
                    removed.append([{"first": x, "last": y - 1} for x, y in zip(first.tolist(), end.tolist())])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(bounds[k : k + part.num_rows + 1])), pa.array(removed, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    return joined.mapInArrow(keep, RESULT)
