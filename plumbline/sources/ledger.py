"""Ledger of deliveries: which payloads of a run have been answered for good.

A payload is known by a digest of its code reference and its text, so it is the same payload however it is batched in another try. Every wave of
batches adds its answers once it is over; a try that ends in the middle loses the answers of one wave at most.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: key, outcome (written or rejected), and of refused payloads what the quarantine tells of them.
LEDGER = "key binary, outcome string, code_reference string, payload string, answer string"


def payload_key(code_reference: Column, payload: Column) -> Column:
    reference = F.coalesce(F.concat(F.octet_length(code_reference).cast("string"), F.lit(":"), code_reference), F.lit("-"))
    return F.unhex(F.sha2(F.concat(reference, payload), 256))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """What was answered for good so far; empty where nothing was sent yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        return spark.createDataFrame([], LEDGER)


def add_answers(routed: DataFrame, path: str) -> None:
    """Add the payloads of routed batch rows (outcome, answer, code_reference, payload) whose outcome is final."""
    refused = F.col("outcome") == "rejected"
    routed.filter("outcome IN ('written', 'rejected')").select(
        payload_key(F.col("code_reference"), F.col("payload")).alias("key"), "outcome", F.when(refused, F.col("code_reference")).alias("code_reference"),
        F.when(refused, F.col("payload")).alias("payload"), F.when(refused, F.col("answer")).alias("answer"),
    ).write.mode("append").parquet(path)
