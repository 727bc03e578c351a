"""Benchmark decontamination: an FM-index for each shard of the training text.

A task gathers documents into shards of about SHARD_WORDS words, sorts the suffixes of a shard, keeps the Burrows-Wheeler transform as a
wavelet matrix with rank counts and the suffix positions at every SAMPLE-th word, and searches all test phrases backwards at once. Rows of
the index that match are walked back to the next sampled position, which gives the occurrences; the spans of one document are merged.

Nothing is shuffled: documents stay in the partition they were scanned in. Test phrases are broadcast in blocks of at most BLOCK_WORDS
words of phrases; a larger benchmark takes one pass over the documents for each block, and the passes are merged for each row.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.llm.arrays import joined_ranges, row_slices, text_buffers, union_length, words_of
from plumbline.llm.shared import staged

WINDOW = 10
SHARD_WORDS = 1 << 19
SAMPLE = 16
BLOCK_WORDS = 1 << 22

FOUND = "n_words long, spans array<struct<first:long,last:long>>, items array<long>"
RESULT = f"doc_id long, {FOUND}"


class Phrases:
    """The windows of some test items over an alphabet of their own words; code 0 parts documents, code 1 is any other word."""

    def __init__(self, item_ids: list[int], texts: list[str | None], window: int):
        data, bounds = text_buffers(pa.array(texts, pa.string()))
        hashes, _, _, at = words_of(data, bounds - bounds[0])
        self.alphabet, codes = np.unique(hashes, return_inverse=True)
        codes = codes.astype(np.int64) + 2
        found: dict[bytes, list[int]] = {}
        for item, a, b in zip(item_ids, at[:-1], at[1:]):
            for k in range(a, max(b - window, a) + 1 if b > a else a):
                found.setdefault(codes[k : min(k + window, b)].tobytes(), []).append(item)
        self.windows = [np.frombuffer(w, np.int64) for w in found]
        self.items = [sorted(set(x)) for x in found.values()]
        self.length = np.array([len(w) for w in self.windows], np.int64)
        self.longest = int(self.length.max(initial=1))
        #: Right-aligned, so that step k of every backward search is column -k - 1.
        self.table = np.zeros((len(self.windows), self.longest), np.int64)
        for row, w in zip(self.table, self.windows):
            row[self.longest - len(w) :] = w

    def coded(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.alphabet):
            return np.ones(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.alphabet, hashes), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == hashes, at + 2, 1)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order by prefix doubling: each round sorts packed (rank, next rank, position) values of what is not yet settled."""
    n = len(text)
    bits = max(1, int(n).bit_length())
    each = int(text.max(initial=0) + 1).bit_length()
    depth = max(1, min(n, (63 - bits) // each))
    key = np.zeros(n, np.uint64)
    for k in range(depth):
        key <<= np.uint64(each)
        key[: n - k] |= text[k:].astype(np.uint64) + np.uint64(1)  # 0 is the end of the text
    low = np.uint64((1 << bits) - 1)
    packed = np.sort((key << np.uint64(bits)) | np.arange(n, dtype=np.uint64))
    order = (packed & low).astype(np.int64)
    packed >>= np.uint64(bits)
    head = np.ones(n, bool)  # where a group of equal prefixes begins
    head[1:] = packed[1:] != packed[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    while True:
        single = head & np.append(head[1:], True)
        rows = np.flatnonzero(~single)
        if not len(rows):
            return order
        at = order[rows]
        after = at + depth
        following = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        group = np.cumsum(head[rows]) - 1
        if 2 * bits + int(group[-1]).bit_length() <= 64:
            value = (((group.astype(np.uint64) << np.uint64(bits)) | following.astype(np.uint64)) << np.uint64(bits)) | at.astype(np.uint64)
            value = np.sort(value)
            order[rows] = (value & low).astype(np.int64)
            value >>= np.uint64(bits)
        else:
            by = np.lexsort((at, following, group))
            order[rows] = at[by]
            value = group[by].astype(np.uint64) << np.uint64(bits) | following[by].astype(np.uint64)
        fresh = np.ones(len(rows), bool)
        fresh[1:] = value[1:] != value[:-1]
        head[rows] = fresh
        rank[order[rows]] = rows[np.maximum.accumulate(np.where(fresh, np.arange(len(rows)), 0))]
        depth *= 2


class Ranks:
    """Bits with rank counts for every 64 of them."""

    def __init__(self, bits: np.ndarray):
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        packed = np.packbits(bits, bitorder="little")
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        block = at >> 6
        return self.before[block] + np.bitwise_count(self.words[block] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class FMIndex:
    """Backward search and location over one shard. Codes are small whole numbers; 0 ends each document."""

    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        order = suffix_array(text)
        n = self.n = len(text)
        self.bits = max(1, int(text.max(initial=0)).bit_length())
        self.smaller = np.zeros((1 << self.bits) + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=1 << self.bits), out=self.smaller[1:])
        transform = text[order - 1]  # the position before the first is the last: the text is taken as a ring
        sampled = (order % sample == 0) | (transform == 0)  # also each document's first word: no walk leaves its document
        self.marks, self.samples = Ranks(sampled), order[sampled]
        self.levels = []
        for bit in range(self.bits - 1, -1, -1):
            ones = (transform >> bit) & 1 == 1
            self.levels.append((Ranks(ones), n - int(ones.sum())))
            transform = np.concatenate((transform[~ones], transform[ones]))

    def rank(self, code: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each code stands in the transform before each position."""
        low = np.zeros(len(at), np.int64)
        for level, (ranks, zeros) in enumerate(self.levels):
            one = (code >> (self.bits - 1 - level)) & 1 == 1
            a, b = ranks.ones(low), ranks.ones(at)
            low, at = np.where(one, zeros + a, low - a), np.where(one, zeros + b, at - b)
        return at - low

    def step_back(self, rows: np.ndarray) -> np.ndarray:
        """The row of the suffix that is one word longer to the left."""
        low, at, code = np.zeros(len(rows), np.int64), rows, np.zeros(len(rows), np.int64)
        for ranks, zeros in self.levels:
            one = ranks.get(at)
            code = code * 2 + one
            a, b = ranks.ones(low), ranks.ones(at)
            low, at = np.where(one, zeros + a, low - a), np.where(one, zeros + b, at - b)
        return self.smaller[code] + at - low

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases that occur, with the first row of each and the row after its last."""
        live = np.arange(len(phrases.windows))
        live = live[(phrases.table[live, -1] < 1 << self.bits)] if len(live) else live
        low, high = np.zeros(len(live), np.int64), np.full(len(live), self.n, np.int64)
        done = []
        for k in range(phrases.longest):
            code = phrases.table[live, phrases.longest - 1 - k]
            over = code == 0  # a shorter phrase is complete
            if over.any():
                done.append((live[over], low[over], high[over]))
            keep = ~over & (code < 1 << self.bits)
            live, low, high, code = live[keep], low[keep], high[keep], code[keep]
            low, high = self.smaller[code] + self.rank(code, low), self.smaller[code] + self.rank(code, high)
            some = high > low
            live, low, high = live[some], low[some], high[some]
        done.append((live, low, high))
        return tuple(np.concatenate(x) for x in zip(*done))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text position of each row."""
        found, rows, steps, open_ = np.zeros(len(rows), np.int64), rows.copy(), 0, np.arange(len(rows))
        while len(open_):
            hit = self.marks.get(rows)
            found[open_[hit]] = self.samples[self.marks.ones(rows[hit])] + steps
            open_, rows = open_[~hit], rows[~hit]
            rows, steps = self.step_back(rows), steps + 1
        return found


LOCATE_AT_ONCE = 1 << 19


def _searched(hashes: list[np.ndarray], phrases: Phrases) -> tuple[list[list], list[set]]:
    """One shard: its index, the occurrences of all phrases, and the merged spans and the items of each document."""
    lengths = np.array([len(h) for h in hashes], np.int64)
    starts = np.zeros(len(hashes), np.int64)
    np.cumsum(lengths[:-1] + 1, out=starts[1:])
    text = np.zeros(int(lengths.sum()) + len(hashes), np.int64)
    text[joined_ranges(starts, lengths)] = phrases.coded(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64))
    spans: list[list] = [[] for _ in hashes]
    items: list[set] = [set() for _ in hashes]
    if len(phrases.windows) and lengths.any():
        index = FMIndex(text)
        which, low, high = index.search(phrases)
        counts, docs_at, first_at, window_at = high - low, [], [], []
        cut = np.append(np.searchsorted(np.cumsum(counts), np.arange(LOCATE_AT_ONCE, counts.sum(), LOCATE_AT_ONCE)), len(counts))
        a = 0
        for b in np.unique(cut):
            at = index.locate(joined_ranges(low[a:b], counts[a:b]))
            doc = np.searchsorted(starts, at, side="right") - 1
            docs_at.append(doc)
            first_at.append(at - starts[doc])
            window_at.append(np.repeat(which[a:b], counts[a:b]))
            a = b
        doc, first, window = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (docs_at, first_at, window_at))
        order = np.argsort(doc, kind="stable")
        doc, first, window = doc[order], first[order], window[order]
        edges = np.append(np.flatnonzero(np.diff(doc, prepend=-1)), len(doc)) if len(doc) else np.zeros(0, np.int64)
        for a, b in zip(edges[:-1], edges[1:]):
            spans[doc[a]] = [{"first": int(s), "last": int(e) - 1} for s, e in zip(*union_length(first[a:b], first[a:b] + phrases.length[window[a:b]]))]
            items[doc[a]].update(i for w in np.unique(window[a:b]) for i in phrases.items[w])
    return spans, items


#: A shard ends early when the columns that it carries reach so many bytes.
CARRIED_BYTES = 64 << 20


def _shards(batches: Iterator[pa.RecordBatch], text_at: int, carried: list[int], shard_words: int) -> Iterator[tuple[list[pa.RecordBatch], list[np.ndarray]]]:
    """Stretches of rows with about `shard_words` words: their carried columns, piece by piece, and the word hashes of each row."""
    pieces, hashes, held = [], [], 0
    for batch in batches:
        data, bounds = text_buffers(batch.column(text_at))
        rest, given = batch.select(carried), 0
        for a, b in row_slices(bounds):
            own = bounds[a : b + 1]
            found, _, _, at = words_of(data[own[0] : own[-1]], own - own[0])
            for k in range(b - a):
                hashes.append(found[at[k] : at[k + 1]])
                held += int(at[k + 1] - at[k]) + 1
                if held >= shard_words:
                    yield [*pieces, rest.slice(given, a + k + 1 - given)], hashes
                    pieces, hashes, held, given = [], [], 0, a + k + 1
        if given < batch.num_rows:
            pieces.append(rest.slice(given))
            if sum(p.nbytes for p in pieces) >= CARRIED_BYTES:
                yield pieces, hashes
                pieces, hashes, held = [], [], 0
    if hashes:
        yield pieces, hashes


def _one_pass(docs: DataFrame, rows: list, window: int, shard_words: int) -> DataFrame:
    """The columns of `docs` but its text, with n_words, spans and items for each row."""
    sent = docs.sparkSession.sparkContext.broadcast(([r[0] for r in rows], [r[1] for r in rows]))
    names = [c for c in docs.columns if c != "text"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(*sent.value, window)
        for pieces, hashes in _shards(batches, 0, list(range(1, len(names) + 1)), shard_words):
            spans, items = _searched(hashes, phrases)
            yield pa.RecordBatch.from_arrays(
                [*(pa.concat_arrays([p.column(k) for p in pieces]) for k in range(len(names))), pa.array([len(h) for h in hashes], pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))), pa.array([sorted(x) for x in items], pa.list_(pa.int64()))],
                [*names, "n_words", "spans", "items"])

    docs = docs.select("text", *names)
    schema = StructType(docs.schema.fields[1:] + StructType.fromDDL(FOUND).fields)
    return docs.mapInArrow(search, schema)


def _blocks(benchmark: DataFrame, block_words: int) -> list[DataFrame]:
    """Frames (item_id, text) that together hold the benchmark, each of about `block_words` words of phrases at most."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    #: A text has at most one word for each two bytes, and a word lies in at most `window` windows.
    words = int(items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]) // 2
    blocks = max(1, -(-words // block_words))
    #: Rows of one item_id may go to different blocks; equal rows say the same and are searched once.
    return [items.distinct().where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) for k in range(blocks)] if blocks > 1 else [items]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """For each row of `docs` (doc_id, text): doc_id, n_words, spans (maximal stretches of words inside occurrences of test windows, first and
    last word) and items (sorted ids of the test items with occurring windows).

    A window is `window` consecutive words of a test item; a shorter item is one window, an item without words (or NULL) none. NULL or empty
    text has no words and no spans. Repeated rows and rows that share a doc_id, or have none, are each answered, whatever the size of the
    benchmark: beyond one block, the passes search a stored copy of the texts with a number for each row. A NULL item_id is left out. Other
    columns are ignored. Occurrences never cross documents.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = _blocks(benchmark, block_words)
    if len(blocks) == 1:
        return _one_pass(docs, blocks[0].collect(), window, shard_words)
    numbered = staged(docs.withColumn("row", F.monotonically_increasing_id()), "decontaminate")
    return _merged([_one_pass(numbered, block.collect(), window, shard_words) for block in blocks])


def _merged(answers: list[DataFrame]) -> DataFrame:
    """Spans of all passes for each row, made maximal again."""
    union = answers[0]
    for a in answers[1:]:
        union = union.unionByName(a)
    own = union.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")).drop("row")

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for row in batch.column("spans").to_pylist():
                s = np.array([x["first"] for x in row], np.int64)
                e = np.array([x["last"] + 1 for x in row], np.int64)
                spans.append([{"first": int(a), "last": int(b) - 1} for a, b in zip(*union_length(s, e))])
            kind = batch.schema.field("spans").type
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, kind), batch.column(3)], batch.schema.names)

    return own.mapInArrow(unite, RESULT)


def without_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """`docs` without the ids that `found` (doc_id, spans) holds a test window for, whatever other rows share the id: for tables in which every
    row has a doc_id of its own. `clean` decides for each row."""
    hit = found.where(F.size("spans") > 0).select("doc_id").distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["doc_id"]), "left_anti")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of `docs` (text and any other columns) whose own text holds no test window, as they are.

    Each row is judged by itself: rows without doc_id, with the same doc_id or repeated do not touch each other, and doc_id is not needed. The
    search carries the rows along and hands on the clean ones, without a shuffle. A benchmark of several blocks is searched in a stored copy of
    the texts with a number for each row, and the numbers that were hit are taken out of that copy.
    """
    blocks = _blocks(benchmark, block_words)
    if len(blocks) == 1:
        rows = blocks[0].collect()
        sent = docs.sparkSession.sparkContext.broadcast(([r[0] for r in rows], [r[1] for r in rows]))
        text_at, every = docs.columns.index("text"), list(range(len(docs.columns)))

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            phrases = Phrases(*sent.value, window)
            for pieces, hashes in _shards(batches, text_at, every, shard_words):
                spans, _ = _searched(hashes, phrases)
                at = 0
                for piece in pieces:
                    yield piece.filter(pa.array([not s for s in spans[at : at + piece.num_rows]], pa.bool_()))
                    at += piece.num_rows

        return docs.mapInArrow(keep, docs.schema)
    row = f"row_{uuid.uuid4().hex}"
    numbered = staged(docs.withColumn(row, F.monotonically_increasing_id()), "decontaminate")
    hits = [_one_pass(numbered.select("text", row), block.collect(), window, shard_words).where(F.size("spans") > 0).select(row) for block in blocks]
    return numbered.join(reduce(DataFrame.unionByName, hits).distinct(), row, "left_anti").select(*docs.columns)
