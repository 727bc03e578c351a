"""Language by compression: one zstandard raw-content dictionary per language; the dictionary that makes a text smallest names its language."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A dictionary is made of at most so many documents of a language, of at most so many bytes each and together.
SAMPLE_DOCS = 128
SAMPLE_DOC_BYTES = 8 << 10
DICTIONARY_BYTES = 128 << 10
#: At most so many languages are learned; more are an error, not a cut.
MAX_LANGUAGES = 512
#: Texts are compressed piece by piece, so that each piece leans on the dictionary and not on the text before it.
PIECE_BYTES = 2 << 10
LEVEL = 6
#: Sharpness of the score in nats for each byte saved per byte of text.
SHARPNESS = 40.0
#: A text is rejected when the second language needs less than this share more than the first one.
MIN_MARGIN = 0.01

UNDETERMINED = "und"
RESULT = "lang_pred string, score double, margin double, rejected boolean"
OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """Lower-case words parted by one space: case, digits and punctuation say little about the language and cost many bytes."""
    return f" {OTHER.sub(' ', text.lower()).strip()} ".encode()


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Dictionary content for each non-NULL lang of the labelled rows (text, lang, and a doc_id that only picks the sample).

    Rows without lang, text or doc_id teach nothing. The sample is bounded by `sample_docs` for each language, is drawn from all of its documents and
    does not depend on how rows are partitioned. A document longer than SAMPLE_DOC_BYTES gives one piece of that size, from an offset picked by a
    hash. The last text of a dictionary is cut where the dictionary is full.
    """
    key, size = F.col("doc_id").cast("string"), F.octet_length("text")
    offset = F.pmod(F.xxhash64(F.lit(11), key), F.greatest(size - SAMPLE_DOC_BYTES, F.lit(0)) + 1).cast("int")
    rows = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL AND length(text) > 0").select("lang", F.col("text").cast("binary").alias("text"), offset.alias("offset"), F.xxhash64(F.lit(7), key).alias("at"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return {}
    #: Of n rows, those with the smallest hashes: about twice as many as are needed.
    share = {k: min(1.0, 2 * sample_docs / n) for k, n in counts.items()}
    limit = docs.sparkSession.createDataFrame([(k, int(v * 2.0**64 - 2.0**63) if v < 1 else 2**63 - 1) for k, v in share.items()], "lang string, most long")
    picked = rows.join(F.broadcast(limit), "lang").where("at <= most").select("lang", F.substr("text", F.col("offset") + 1, F.lit(SAMPLE_DOC_BYTES)).alias("piece"), "at").collect()
    sampled: dict[str, list] = {}
    for r in picked:
        sampled.setdefault(r["lang"], []).append((r["at"], bytes(r["piece"])))
    content = {}
    for lang in sorted(counts, key=lambda x: (-counts[x], x)):
        joined = b""
        for _, piece in sorted(sampled.get(lang, []))[:sample_docs]:
            text = letters(piece.decode(errors="ignore"))  # a piece may begin or end inside a character
            joined = (joined + b"\n" + text if joined else text)[:dictionary_bytes]
        content[lang] = joined
    return content


def pieces(text: bytes, size: int = PIECE_BYTES) -> list[bytes]:
    """Equal pieces of at most about `size` bytes."""
    n = max(1, -(-len(text) // size))
    step = -(-len(text) // n)
    return [text[k : k + step] for k in range(0, len(text), step)] if text else []


class Classifier:
    def __init__(self, content: dict[str, bytes], level: int = LEVEL):
        self.langs = list(content)  # the more frequent first: it wins a tie
        self.compressors = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.compressors.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))

    def of(self, text: str | None, min_margin: float) -> tuple[str, float, float, bool]:
        if text is None or not self.langs or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, 0.0, True
        data = letters(text)
        parts = pieces(data)
        sizes = np.array([sum(len(c.compress(p)) for p in parts) for c in self.compressors], float)
        best = int(sizes.argmin())
        score = 1.0 / float(np.exp((sizes[best] - sizes) * (SHARPNESS / len(data))).sum())
        margin = float(np.partition(sizes, 1)[1] / sizes[best] - 1) if len(sizes) > 1 else 1.0
        return self.langs[best], score, margin, margin < min_margin


def identify(docs: DataFrame, content: dict[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """`docs` with lang_pred, score (0 to 1), margin and rejected, from the whole of each text alone.

    NULL text, text without a letter, and every text when no language was learned: `und`, score 0, rejected. With one learned language the
    margin is 1. Equal sizes go to the language with more labelled rows, and are rejected. Columns of `docs` that clash with the four new names are
    replaced. Repeated rows are answered alike.
    """
    kept = docs.drop("lang_pred", "score", "margin", "rejected")
    names, at = kept.columns, kept.columns.index("text")
    sent = docs.sparkSession.sparkContext.broadcast(content)  # at most MAX_LANGUAGES dictionaries

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(sent.value)
        for batch in batches:
            lang, score, margin, rejected = zip(*(classifier.of(t.as_py(), min_margin) for t in batch.column(at))) if batch.num_rows else ((), (), (), ())
            new = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*names, "lang_pred", "score", "margin", "rejected"])

    schema = StructType(list(kept.schema))
    for name, kind in (("lang_pred", "string"), ("score", "double"), ("margin", "double"), ("rejected", "boolean")):
        schema = schema.add(name, kind)
    return kept.mapInArrow(classify, schema)
