"""Byte-level BPE of many texts at once: texts are cut into pretokens with numpy, and each different pretoken is encoded once per cache."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from tokenizers import Tokenizer

from plumbline.llm.arrays import Rolling, joined_ranges, mixed

#: The pretoken pattern of this family of tokenizers; `pretoken_starts` does the same on arrays.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
SLOT_BITS = 20
POOL_IDS = 1 << 22


def _classes() -> np.ndarray:
    text = "".join(map(chr, [*range(0xD800), *([0x21] * 0x800), *range(0xE000, 0x110000)]))
    found = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{White_Space}+", SPACE), (r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for m in regex.finditer(pattern, text):
            found[m.start() : m.end()] = kind
    return found


def pretoken_starts(points: np.ndarray, bounds: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Whether a pretoken begins at each code point; bounds are those of the texts, in code points."""
    n = len(points)
    kind = classes[points]
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    last, first = first[1:], first[:-1]
    space = kind == SPACE
    changes = first.copy()
    changes[1:] |= kind[1:] != kind[:-1]
    after_blank = np.zeros(n, bool)
    after_blank[1:] = (points[:-1] == 32) & ~first[1:]
    starts = changes & (space | ~after_blank)
    ends_run = np.zeros(n, bool)  # a white space with something else after it in its text
    ends_run[:-1] = space[:-1] & ~space[1:] & ~last[:-1]
    starts |= ends_run
    quote = np.flatnonzero((points == 39) & starts)
    if len(quote):
        padded = np.append(points, [0, 0])
        text_end = bounds[np.searchsorted(bounds, quote, side="right")]
        a, b = padded[quote + 1], padded[quote + 2]
        short = np.isin(a, [ord(c) for c in "stmd"]) & (quote + 1 < text_end)
        long = (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))) & (quote + 2 < text_end)
        for hit, width in ((short, 2), (long, 3)):
            at, end = quote[hit], text_end[hit]
            starts[at + 1] = False
            more = at[at + width < end] + width
            starts[more[kind[more] == LETTER]] = True
    return starts


class Encoder:
    """Ids of whole texts as the tokenizer in the JSON file at `path` gives them without special tokens added."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.fast = spec["model"]["type"] == "BPE" and spec["normalizer"] is None and spec["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(printable))}
        if self.fast:
            ranks = {bytes(byte_of[c] for c in token): k for token, k in spec["model"]["vocab"].items() if token not in self.special}
            self.bpe = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.classes = _classes()
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(1 << SLOT_BITS, np.uint64)
        self.at = np.zeros(1 << SLOT_BITS, np.int64)
        self.size = np.zeros(1 << SLOT_BITS, np.int64)
        self.pool, self.used = np.zeros(POOL_IDS, np.uint32), 0

    def of(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. A text that spells a special token goes through the tokenizer itself."""
        out: list = [None] * len(texts)
        plain = []
        for k, t in enumerate(texts):
            if self.fast and not any(s in t for s in self.special):
                plain.append(k)
            else:
                out[k] = np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32)
        for k, ids in zip(plain, self._fast([texts[k] for k in plain])):
            out[k] = ids
        return out

    def _fast(self, texts: list[str]) -> list[np.ndarray]:
        whole = "".join(texts)
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=bounds[1:])
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(points):
            return [np.zeros(0, np.uint32)] * len(texts)
        starts = np.flatnonzero(pretoken_starts(points, bounds, self.classes))
        ends = np.append(starts[1:], len(points))
        keys = Rolling(mixed(points.astype(np.uint64) + np.uint64(1))).of(starts, ends)
        keys[keys == 0] = 1
        slots = (keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        missing = np.flatnonzero(self.keys[slots] != keys)
        at, size = self.at[slots], self.size[slots]
        pool = self.pool
        if len(missing):
            _, one, inverse = np.unique(keys[missing], return_index=True, return_inverse=True)
            encode, one = self.bpe.encode_ordinary, missing[one]
            fresh = [encode(whole[a:b]) for a, b in zip(starts[one].tolist(), ends[one].tolist())]
            lengths = np.array([len(f) for f in fresh], np.int64)
            ids = np.fromiter((i for f in fresh for i in f), np.uint32, int(lengths.sum()))
            if self.used + len(ids) > len(self.pool):
                # What this slice still needs from the old pool stays readable through `pool`.
                offset = self.used
                pool = np.concatenate((self.pool[: self.used], ids))
                self._reset()
                if len(ids) <= len(self.pool):
                    self.pool[: len(ids)], self.used = ids, len(ids)
                    self._keep(keys[one], np.cumsum(lengths) - lengths, lengths)
            else:
                offset = self.used
                self.pool[offset : offset + len(ids)] = ids
                self.used += len(ids)
                self._keep(keys[one], np.cumsum(lengths) - lengths + offset, lengths)
            at[missing] = (np.cumsum(lengths) - lengths + offset)[inverse]
            size[missing] = lengths[inverse]
        ids = pool[joined_ranges(at, size)]
        total = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        cuts = total[np.searchsorted(starts, bounds)]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def _keep(self, keys: np.ndarray, at: np.ndarray, size: np.ndarray) -> None:
        slots = (keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        last = np.zeros(1 << SLOT_BITS, np.int64)  # of pieces that meet in a slot one stays, whole
        last[slots] = np.arange(len(slots))
        own = last[slots] == np.arange(len(slots))
        self.keys[slots[own]], self.at[slots[own]], self.size[slots[own]] = keys[own], at[own], size[own]


def texts_of(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]
