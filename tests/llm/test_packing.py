"""Round trip of packed ids, gapless sequences, and the tokenizer on arrays against the tokenizer itself."""

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from plumbline.llm import packing
from plumbline.llm.bpe import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH)


def test_encoder_agrees_with_the_tokenizer(encoder):
    rnd = random.Random(1)
    alphabet = " '  \n\tstremdlva'é1２٣!?<|中   \r\x1c😀-"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(3000)] + ["", "<|endoftext|> a", "it's we'll'sx 'll"]
    assert all(a.tolist() == b.ids for a, b in zip(encoder.of(texts), encoder.tokenizer.encode_batch(texts, add_special_tokens=False)))


def test_encoder_with_a_full_cache(encoder, monkeypatch):
    monkeypatch.setattr("plumbline.llm.bpe.POOL_IDS", 40)
    encoder._reset()
    texts = [f"word{k} and{k} 'tis {k}" for k in range(60)]
    for k in range(0, 60, 7):
        part = texts[k : k + 7] + texts[:3]
        assert [a.tolist() for a in encoder.of(part)] == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in part]
    monkeypatch.undo()
    encoder._reset()


def test_hilbert_curve_visits_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    key = packing.hilbert(cells, 3)
    assert sorted(key.tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_pieces_hold_every_id_once(spark, sf_dir, documents, encoder):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(80).collect()]
    rows += [(900, None), (901, ""), (None, "no id"), (902, rows[3][1]), (903, "long " * 30000)]
    pieces = packing.pack(documents(rows), PATH).collect()
    own, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        own[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append(p)
    for doc_id, text in rows:
        ids = [*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        parts = sorted(own[doc_id], key=lambda p: p["start"])
        assert [p["start"] for p in parts] == np.cumsum([0] + [p["length"] for p in parts])[:-1].tolist()
        assert b"".join(bytes(p["ids"]) for p in parts) == np.array(ids, "<u4").tobytes() and {p["doc_tokens"] for p in parts} == {len(ids)}
    for parts in sequences.values():
        parts.sort(key=lambda p: p["offset"])
        total = sum(p["length"] for p in parts)
        assert [p["offset"] for p in parts] == np.cumsum([0] + [p["length"] for p in parts])[:-1].tolist()
        assert total <= 2048 and total & (total - 1) == 0


def test_repeated_rows_and_empty_table(spark, documents):
    pieces = packing.pack(documents([(1, "same text"), (1, "same text")]), PATH).collect()
    assert sum(p["length"] for p in pieces) == 2 * pieces[0]["doc_tokens"]
    assert packing.pack(documents([]), PATH).count() == 0
