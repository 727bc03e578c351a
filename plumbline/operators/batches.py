"""Batches of payloads for delivery, and what happens to their rows once the answers are in."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.skew import MAX_BROADCAST_BYTES, lookup_join

BATCH_SCHEMA = (
    "batch_id bigint, size int, items array<struct<source_id string, code_reference string, payload string>>"
)


def _cut(size: int):
    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cut a partition's rows into lists of ``size``; the remainder of one block opens the next list."""
        number = TaskContext.get().partitionId() << 33

        def lists(rows: pa.StructArray, each: int):
            nonlocal number
            count = len(rows) // each
            offsets = pa.array(range(0, count * each + 1, each), pa.int32())
            ids = pa.array(range(number, number + count), pa.int64())
            number += count
            return pa.RecordBatch.from_arrays(
                [ids, pa.array([each] * count, pa.int32()), pa.ListArray.from_arrays(offsets, rows[:count * each])],
                ["batch_id", "size", "items"],
            )

        rest = None
        for block in blocks:
            rows = block.to_struct_array()
            if rest is not None and len(rest):
                rows = pa.concat_arrays([rest, rows])
            if len(rows) >= size:
                yield lists(rows, size)
            rest = rows[len(rows) - len(rows) % size:]
        if rest is not None and len(rest):
            yield lists(rest, len(rest))

    return run


def assemble_batches(payloads: DataFrame, size: int) -> DataFrame:
    """(batch_id, size, items): at most ``size`` payloads per batch, each partition with its own remainder.

    Rows of a batch already sit in one partition, so nothing is shuffled and no more than one Arrow block and one
    remainder is held. Batch ids depend on the partitioning: write the result before the batches are answered.
    """
    rows = payloads.select(
        F.col("source_id").cast("string").alias("source_id"),
        "code_reference", "payload",
    )
    return rows.mapInArrow(_cut(size), BATCH_SCHEMA)


LOST_SCHEMA = "lost struct<source_id string, code_reference string, asset string, reject struct<code string, message string, field string>>"


def _cut_beside_lost(size: int, items_type: pa.DataType, lost_type: pa.DataType):
    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches of the rows that could be built, and the other rows one by one, in one stream."""
        aside = []

        def whole() -> Iterator[pa.RecordBatch]:
            for block in blocks:
                rejected = pc.is_valid(block.column("reject"))
                aside.append(block.filter(rejected).select(["source_id", "code_reference", "asset", "reject"]))
                yield block.filter(pc.invert(rejected)).select(["source_id", "code_reference", "payload"])

        def rejects() -> Iterator[pa.RecordBatch]:
            while aside:
                rows = aside.pop()
                if rows.num_rows:
                    none = [pa.nulls(rows.num_rows, t) for t in (pa.int64(), pa.int32(), items_type)]
                    yield pa.RecordBatch.from_arrays([*none, rows.to_struct_array().cast(lost_type)], ["batch_id", "size", "items", "lost"])

        for batch in _cut(size)(whole()):
            lost = pa.nulls(batch.num_rows, lost_type)
            ids, sizes, items = batch.columns
            yield pa.RecordBatch.from_arrays([ids, sizes, items.cast(items_type), lost], ["batch_id", "size", "items", "lost"])
            yield from rejects()
        yield from rejects()

    return run


def assemble_beside_lost(rows: DataFrame, size: int) -> DataFrame:
    """(batch_id, size, items, lost): batches of rows without a ``reject``, and each row with one as ``lost``, from one pass.

    ``rows`` has source_id, code_reference, payload, asset and reject; a row of the result is either a batch or a lost row.
    """
    text, fields = pa.string(), ("source_id", "code_reference", "payload")
    items = pa.list_(pa.struct([(f, text) for f in fields]))
    reject = pa.struct([(f, text) for f in ("code", "message", "field")])
    lost = pa.struct([("source_id", text), ("code_reference", text), ("asset", text), ("reject", reject)])
    held = rows.select(F.col("source_id").cast("string").alias("source_id"), "code_reference", "payload", "asset", "reject")
    return held.mapInArrow(_cut_beside_lost(size, items, lost), f"{BATCH_SCHEMA}, {LOST_SCHEMA}")


def batch_body(items):
    """JSON array text of a batch's payloads."""
    return F.concat(F.lit("["), F.array_join(F.transform(items, lambda i: i["payload"]), ","), F.lit("]"))


def outcome(status):
    """written (below 400), rejected (400-499) or failed (anything else, or no answer)."""
    return (
        F.when(status < 400, F.lit("written")).when(status.between(400, 499), F.lit("rejected"))
        .otherwise(F.lit("failed"))
    )


def route_outcomes(batches: DataFrame, answers: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Batches with their ``outcome`` and the answer's text; ``answers`` has batch_id (unique), status, body."""
    told = answers.select("batch_id", "status", F.col("body").alias("answer"))
    joined = lookup_join(
        batches, F.col("batch_id"), told, "batch_id", F.xxhash64("batch_id"), may_be_hot=False, max_bytes=max_bytes
    )
    return joined.withColumn("outcome", outcome(F.col("status")))


def batch_rows(routed: DataFrame) -> DataFrame:
    """One row per payload of routed batches."""
    return routed.select("batch_id", "outcome", "answer", F.explode("items").alias("item")).select(
        "batch_id", "outcome", "answer", "item.*"
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
