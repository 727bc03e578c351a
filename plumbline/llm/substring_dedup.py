"""Substring dedup with suffix automata: a document streams through the automaton of a reference shard, and words covered by a match of
WINDOW words that an earlier document holds are removed.

An automaton for each part of the corpus, sent to all documents, would be work that grows with the square of the corpus. So reference shards are made of
what can match at all (see `passages`): runs of windows around shared anchors, first places only, dealt out by anchor; the automaton of a
shard meets the runs of the same anchors and no others. Each state knows the smallest doc_id that its strings occur in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.arrays import BYTE_VALUES, Rolling, row_slices, stretches, text_buffers, union_length
from plumbline.llm.packing import NOT_SPACE
from plumbline.llm.passages import HOT, SHARD_BYTES, Kind, repeated_spans

WINDOW = 50
GRAM = 8

RESULT = "doc_id long, n_words long, spans array<struct<first:long,last:long>>, kept string"


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts, ends = stretches(NOT_SPACE[data], bounds)
    return Rolling(BYTE_VALUES[data]).of(starts, ends), starts, ends, np.searchsorted(starts, bounds)


class SuffixAutomaton:
    """Of several texts, added in ascending order of their document."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.document = [-1], [0], [-1]

    def add(self, words: list, document: int) -> None:
        step, link, length, docs = self.next, self.link, self.length, self.document
        last = 0
        for w in words:
            have = step[last].get(w)
            if have is not None and length[have] == length[last] + 1:
                last = have
                continue
            if have is None:
                new = len(step)
                step.append({})
                link.append(0)
                length.append(length[last] + 1)
                docs.append(document)
                p = last
                while p >= 0 and w not in step[p]:
                    step[p][w] = new
                    p = link[p]
                if p >= 0:
                    q = step[p][w]
                    link[new] = q if length[q] == length[p] + 1 else self._split(p, q, w)
                last = new
            else:
                last = self._split(last, have, w)

    def _split(self, p: int, q: int, w: object) -> int:
        step, link, length = self.next, self.link, self.length
        half = len(step)
        step.append(step[q].copy())
        link.append(link[q])
        length.append(length[p] + 1)
        self.document.append(self.document[q])
        link[q] = half
        while p >= 0 and step[p].get(w) == q:
            step[p][w] = half
            p = link[p]
        return half

    def first_documents(self, words: list, window: int) -> list[int]:
        """For each window of the words: the smallest document that holds it, or -1. Matching statistics, kept to the window's length."""
        step, link, length, docs = self.next, self.link, self.length, self.document
        state, matched, found = 0, 0, []
        for k, w in enumerate(words):
            while state and w not in step[state]:
                state = link[state]
                matched = length[state]
            if w in step[state]:
                state, matched = step[state][w], matched + 1
                while length[link[state]] >= window:
                    state = link[state]
                matched = min(matched, length[state])
            if k >= window - 1:
                found.append(docs[state] if matched >= window else -1)
        return found


def compare(contents: list[bytes], ids: list[int], starts: list[int], window: int) -> list[np.ndarray]:
    """Which windows of each text stand in a text of a smaller document."""
    words = [c.split() for c in contents]
    automaton = SuffixAutomaton()
    for k in sorted(range(len(ids)), key=lambda k: ids[k]):
        automaton.add(words[k], ids[k])
    return [np.array(automaton.first_documents(w, window), np.int64) < i for w, i in zip(words, ids)]


def without_repeats(docs: DataFrame, window: int = WINDOW, hot: int = HOT, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_words, spans of removed words (maximal, first and last word) and kept (the other words, parted by one space) of each row.

    Words are parted by ASCII white space. A word goes if it lies in `window` consecutive words that also start in a document of a smaller
    doc_id; windows are judged on the input. NULL text has no words and `kept` is empty; so does a text that is empty or white space. A text
    of fewer words than a window is kept whole. A row without doc_id keeps all its words and is no reference. Rows that share a doc_id are one
    document to others: they do not remove each other's words, and a span found in one is removed from each of them. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = Kind(_words, window, min(GRAM, window))
    found = repeated_spans(docs.where("doc_id IS NOT NULL AND text IS NOT NULL"), kind, lambda c, i, s: compare(c, i, s, window), True, hot, shard_bytes)
    joined = docs.join(found.withColumnRenamed("doc_id", "_doc"), F.col("doc_id") == F.col("_doc"), "left").select("doc_id", "text", "spans")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_buffers(batch.column(1))
            spans = batch.column(2)
            for a, b in row_slices(bounds):
                own = bounds[a : b + 1]
                text = data[own[0] : own[-1]]
                starts, ends = stretches(NOT_SPACE[text], own - own[0])
                at = np.searchsorted(starts, own - own[0])
                removed, kept = [], []
                for k in range(b - a):
                    n = at[k + 1] - at[k]
                    s = spans[a + k].as_py() or []
                    first, end = union_length(np.array([x["first"] for x in s], np.int64), np.array([x["last"] + 1 for x in s], np.int64))
                    first, end = first[first < n], np.minimum(end[first < n], n)
                    words = text[own[k] - own[0] : own[k + 1] - own[0]].tobytes().split()
                    left, p = [], 0
                    for x, y in zip(first.tolist(), end.tolist()):
                        left += words[p:x]
                        p = y
                    kept.append(b" ".join(left + words[p:]).decode())
                    removed.append([{"first": x, "last": y - 1} for x, y in zip(first.tolist(), end.tolist())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(at)), pa.array(removed, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))), pa.array(kept, pa.string())],
                    ["doc_id", "n_words", "spans", "kept"])

    return joined.mapInArrow(keep, RESULT)
