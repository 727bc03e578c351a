"""The corpus pipeline: language, lines, near-duplicates, benchmark leaks, packing. Each stage works on all that the one before it kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import bag_minhash, decontaminate, language, line_dedup, packing
from plumbline.llm.queries import TOKENIZER
from plumbline.llm.shared import shared_folder, staged


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear, learned from the labelled rows; lang itself stays as it was given."""
    content = language.fit(docs.select("doc_id", "text", "lang"))
    return language.identify(docs, content).where("NOT rejected").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without lines that are alike an earlier one; n_chars counts what is left."""
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))).select(*docs.columns)


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates: the one with the smallest doc_id, of several the one stored first.

    Rows are compared by their own texts: rows that repeat, share a doc_id or have none are judged each by itself, so of equal rows one stays and
    different texts under one doc_id don't touch each other. Rows with NULL text stay. An empty table stays empty.
    """
    row = f"row_{uuid.uuid4().hex}"
    numbered = staged(docs.withColumn(row, F.monotonically_increasing_id()), "near-duplicates")
    classes = bag_minhash.near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text")).select(F.col("doc_id").alias(row), "class_id")
    crowds = staged(classes.groupBy("class_id").agg(F.count("*").alias("n")).where("n > 1").select("class_id"), "crowds")
    crowded = staged(classes.join(crowds, "class_id"), "crowded").join(numbered.select(row, "doc_id"), row)
    kept = crowded.groupBy("class_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("k")).select(F.col(f"k.{row}").alias(row))
    gone = crowded.select(row).join(kept, row, "left_anti")
    return numbered.join(gone, row, "left_anti").select(*docs.columns)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose own text holds no passage of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences along the space-filling curve: their ids, with a checksum beside them."""
    pieces = packing.pack(docs, TOKENIZER)
    return pieces.select("doc_id", "start", "length", "ids", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language id", identify_language),
    ("line dedup", dedup_lines),
    ("near duplicates", keep_one_of_each_class),
    ("benchmark decontamination", remove_leaks),
    ("packing", pack),
]

#: Compression and tokenizers are beyond SQL; tests hold the near-duplicate and the leak stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
