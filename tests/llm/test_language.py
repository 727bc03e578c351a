"""Held-out accuracy and the defined results of odd rows."""

import random

from pyspark.sql import functions as F

from plumbline.llm import language


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    content = language.fit(docs.where(~held))
    rows = language.identify(docs.where(held), content).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows) and sum(r["rejected"] for r in rows) <= 0.03 * len(rows)


def test_odd_rows(spark, documents):
    train = spark.createDataFrame([(1, "the house and the garden " * 8, "en"), (2, "das haus und der garten " * 8, "de"), (3, "x", None), (None, "y", "fr"), (4, None, "fr")], "doc_id long, text string, lang string")
    content = language.fit(train)
    assert sorted(content) == ["de", "en"]
    docs = documents([(1, None), (2, ""), (3, "12 34 !"), (4, "der garten und das haus"), (4, "der garten und das haus"), (5, "the garden and the house " * 9000)])
    docs = docs.withColumn("score", F.lit("theirs"))
    got = [(r["doc_id"], r["lang_pred"], r["rejected"]) for r in language.identify(docs, content).collect()]
    assert got == [(1, "und", True), (2, "und", True), (3, "und", True), (4, "de", False), (4, "de", False), (5, "en", False)]
    assert language.identify(docs, {}).select("lang_pred").distinct().collect() == [("und",)]
    assert language.fit(train.limit(0)) == {} and language.identify(docs.limit(0), content).count() == 0


def test_long_documents_teach(spark, documents):
    """A few short texts beside many long ones, and long texts that all begin alike."""
    rnd = random.Random(1)

    def long(words, head=""):
        return head + " ".join(rnd.choice(words) for _ in range(4000))

    da, nl = ["ikke", "været", "også", "hvad", "måske", "kunne"], ["niet", "geweest", "ook", "wat", "misschien", "kunnen"]
    notice = "this page was made by a machine " * 300
    rows = [(1, "OK", "da"), *((k, long(da), "da") for k in range(2, 30))] + [(k, long(nl, notice), "nl") for k in range(30, 60)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    content = language.fit(train)
    assert len(content["da"]) == language.DICTIONARY_BYTES and "været".encode() in content["da"]
    assert len(content["nl"]) > 0.9 * language.DICTIONARY_BYTES and b"geweest" in content["nl"]
    assert content == language.fit(train.repartition(7))
    assert all(len(x) == 1000 for x in language.fit(train, dictionary_bytes=1000).values())
    got = language.identify(documents([(1, "hvad kunne også været"), (2, "wat kunnen ook geweest")]), content)
    assert [(r["lang_pred"], r["rejected"]) for r in got.collect()] == [("da", False), ("nl", False)]


def test_every_byte_is_judged():
    text = b"abc" * 5000
    assert b"".join(language.pieces(text)) == text and max(map(len, language.pieces(text))) <= language.PIECE_BYTES
