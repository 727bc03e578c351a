"""Packing along a space-filling curve: documents with like words become neighbours, and neighbours fill the same training sequences.

Every document becomes a hashed word vector, projected to three dimensions; the place of that point on a Hilbert curve is its sort key. A
range shuffle by (key, doc_id) deals out the curve, and each partition fills its sequences in curve order, cutting documents freely. Only
the last sequence of a partition is not full; it is cut into sequences whose lengths are powers of two, so no sequence needs padding.

Texts are encoded after the shuffle, once; what the range sampling reads a second time is the cheap vector pass. The doc_id in the key
splits copies, which share a key, over partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.arrays import BYTE_VALUES, Rolling, row_slices, rows_of, stretches, text_buffers
from plumbline.llm.bpe import Encoder, texts_of

SEQUENCE = 2048
END_ID = 1
BUCKETS = 256
DIMS = 3
BITS = 10

NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, *range(9, 14)]] = False

RESULT = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def projection() -> np.ndarray:
    """The fixed random directions."""
    return np.random.default_rng(20).standard_normal((BUCKETS, DIMS))


def points(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Three whole coordinates of each text: signed counts of hashed words, damped, scaled to length one, and projected."""
    starts, ends = stretches(NOT_SPACE[data], bounds)
    rows, hashes = rows_of(starts, bounds), Rolling(BYTE_VALUES[data]).of(starts, ends)
    sign = np.where(hashes >> np.uint64(63), 1.0, -1.0)
    n = len(bounds) - 1
    vectors = np.bincount(rows * BUCKETS + (hashes & np.uint64(BUCKETS - 1)).astype(np.int64), weights=sign, minlength=n * BUCKETS).reshape(n, BUCKETS)
    vectors = np.sign(vectors) * np.sqrt(np.abs(vectors))
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    place = np.clip(vectors @ projection(), -3, 3)
    return np.rint((place + 3) / 6 * ((1 << BITS) - 1)).astype(np.int64)


def hilbert(coordinates: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place of whole points on the Hilbert curve (bits of each coordinate, transposed by Gray-code steps)."""
    x = coordinates.T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    key = np.zeros_like(flip)
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | (((x[i] ^ flip) >> bit) & 1)
    return key


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id and text with the place on the curve."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_buffers(batch.column(1))
            keys = [np.zeros(0, np.int64)]
            for a, b in row_slices(bounds):
                own = bounds[a : b + 1]
                keys.append(hilbert(points(data[own[0] : own[-1]], own - own[0])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(keys), pa.int64())], ["doc_id", "text", "place"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(place, "doc_id long, text string, place long")


class Packer:
    """Fills sequences one after another; `rows` takes (doc_id, start, length, ids, doc_tokens, sequence_id, offset)."""

    def __init__(self, sequence: int, first_id: int):
        self.sequence, self.id = sequence, first_id
        self.open: list[tuple] = []
        self.filled = 0
        self.rows: list[tuple] = []

    def _close(self) -> None:
        offset = 0
        for doc_id, start, ids, total in self.open:
            self.rows.append((doc_id, start, len(ids), ids.astype("<u4").tobytes(), total, self.id, offset))
            offset += len(ids)
        self.id, self.open, self.filled = self.id + 1, [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        start = 0
        while start < len(ids):
            piece = ids[start : start + self.sequence - self.filled]
            self.open.append((doc_id, start, piece, len(ids)))
            start += len(piece)
            self.filled += len(piece)
            if self.filled == self.sequence:
                self._close()

    def finish(self) -> None:
        """Cut what is left into sequences of falling powers of two."""
        rest, left, self.open = self.open, self.filled, []
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            while room:
                doc_id, start, ids, total = rest.pop(0)
                self.open.append((doc_id, start, ids[:room], total))
                if len(ids) > room:
                    rest.insert(0, (doc_id, start + room, ids[room:], total))
                room -= min(room, len(ids))
            self._close()


def pack(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start and length in the document's ids, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    A document's ids are those of its whole text and then `end_id`; NULL or empty text is `end_id` alone. Every id of every row of `docs` lies
    in exactly one piece, repeated rows and NULL doc_ids included. Sequences hold `sequence` ids; the last ones of a partition hold smaller
    powers of two. Equal keys are ordered by doc_id, then by text. `tokenizer_path` must name the same file on every executor.
    """
    places = keyed(docs)
    parts = places.repartitionByRange(F.col("place"), F.col("doc_id")).sortWithinPartitions("place", "doc_id", F.xxhash64("text"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        packer = Packer(sequence, TaskContext.get().partitionId() << 33)
        for batch in batches:
            _, bounds = text_buffers(batch.column(1))
            for a, b in row_slices(bounds):
                ids = encoder.of(texts_of(batch.column(1).slice(a, b - a)))
                for doc_id, own in zip(batch.column(0).slice(a, b - a).to_pylist(), ids):
                    packer.add(doc_id, np.append(own, np.uint32(end_id)))
                yield _rows(packer)
        packer.finish()
        yield _rows(packer)

    return parts.drop("place").mapInArrow(fill, RESULT)


def _rows(packer: Packer) -> pa.RecordBatch:
    columns = list(zip(*packer.rows)) or [()] * 7
    packer.rows = []
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
