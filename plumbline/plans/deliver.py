"""Deliver: standard datasets to payload batches, and the routing of their outcomes.

How a batch reaches the receiving system is the caller's business: ``answer`` takes the frame of batches
(batch_id, size, items) and returns a frame of answers (batch_id, status, body), typically through ``mapInPandas``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.batches import assemble_beside_lost, batch_rows, route_outcomes
from plumbline.operators.geo import decode_geometry
from plumbline.operators.payload import PayloadSettings, Template, build_payloads, payload_json
from plumbline.operators.quarantine import SERIALIZATION, UPLOAD, asset_json, batch_records, row_records
from plumbline.operators.skew import settled
from plumbline.plans.errors import Failure, StageFailed
from plumbline.plans.together import each
from plumbline.plans.standardize import Run, check_gate, stage_path
from plumbline.sources.layout import dataset_path
from plumbline.sources.ledger import add_answers, payload_key, read_ledger
from plumbline.sources.quarantine import write_quarantine
from plumbline.sources.tables import read_dataset

Answer = Callable[[DataFrame], DataFrame]


def payload_rows(built: DataFrame, row_columns: Sequence[str]) -> DataFrame:
    """Built payloads as text; a row that could not be built keeps itself as JSON text for the quarantine."""
    lost = F.col("reject").isNotNull()
    return built.select(
        F.col("id").cast("string").alias("source_id"),
        F.col("payload.codeReference").alias("code_reference"),
        F.when(~lost, payload_json(F.col("payload"))).alias("payload"),
        F.when(lost, asset_json(built, list(row_columns))).alias("asset"),
        "reject",
    )


def unanswered(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Payload rows without those that the ledger holds; rows that could not be built all stay."""
    keyed = rows.withColumn("_key", F.when(F.col("payload").isNotNull(), payload_key(F.col("code_reference"), F.col("payload"))))
    return keyed.join(ledger.select(F.col("key").alias("_key")), "_key", "left_anti").drop("_key")


def send_waves(batches: DataFrame, answer: Answer, waves: int, ledger_path: str) -> str | None:
    """Send batches in waves, each stored in the ledger before the next begins; what the first failed batch was told, if any failed.

    A wave is a share of the batches by a hash of their id. An exception of ``answer`` ends the delivery at once.
    """
    problem = None
    for wave in range(waves):
        now = batches.filter(F.pmod(F.xxhash64("batch_id"), F.lit(waves)) == wave)
        answers = settled(answer(now).select("batch_id", "status", "body"))  # every batch of the wave is sent once
        routed = route_outcomes(now, answers)
        add_answers(batch_rows(routed), ledger_path)
        failed = routed.filter("outcome = 'failed'").agg(F.min(F.struct("batch_id", "status", "answer")).alias("first")).first()["first"]
        if failed and problem is None:
            problem = f"batch {failed['batch_id']} was answered with status {failed['status']}: {failed['answer']}"
    return problem


def deliver_template(
    spark: SparkSession, run: Run, template: Template, settings: PayloadSettings, answer: Answer, counts: dict[str, int],
    masterdata: DataFrame | None = None, tags: DataFrame | None = None, waves: int = 1,
) -> None:
    """Build, batch and deliver what the ledger of the run does not hold yet; counts are payloads, of earlier tries as well.

    Rejects are stored before any failure is raised.
    """
    rules = run.rules
    standard = decode_geometry(
        read_dataset(spark, dataset_path(run.standard, run.run_id, template.code)), rules.geometry_column
    )
    built = build_payloads(
        standard, template, settings, masterdata, tags, rules.id_column, rules.geometry_column
    )
    ledger_path = run.ledger_path(spark, template.code)
    sent_before = read_ledger(spark, ledger_path)
    rows = payload_rows(built, standard.columns)
    if not sent_before.isEmpty():
        rows = unanswered(rows, sent_before)
    # One stage table holds the batches and, beside them, the rows that could not be built.
    path = stage_path(spark, run, UPLOAD, template.code)
    assemble_beside_lost(rows, settings.batch_size).write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)

    lost = stored.filter("lost IS NOT NULL").select("lost.*")
    counts["quarantined"] += lost.count()
    write_quarantine(
        row_records(lost, run.run_id, run.environment, template.code, SERIALIZATION), run.quarantine, scope=run.scope(template, SERIALIZATION)
    )
    problem, broken = None, None
    try:
        problem = send_waves(stored.filter("lost IS NULL").select("batch_id", "size", "items"), answer, waves, ledger_path)
    except Exception as error:
        broken = error  # what was answered before is counted and stored
    ledger = read_ledger(spark, ledger_path)
    by_outcome = {row["outcome"]: row["n"] for row in ledger.groupBy("outcome").agg(F.count("*").alias("n")).collect()}  # two outcomes
    counts["written"] += by_outcome.get("written", 0)
    counts["quarantined"] += by_outcome.get("rejected", 0)
    refused = ledger.filter("outcome = 'rejected'")
    write_quarantine(batch_records(refused, run.run_id, run.environment, template.code), run.quarantine, scope=run.scope(template, UPLOAD))
    if broken is not None:
        raise broken
    if problem:
        raise RuntimeError(problem)


def deliver(
    spark: SparkSession, run: Run, templates: Sequence[Template], settings: PayloadSettings, answer: Answer,
    masterdata: DataFrame | None = None, tags: DataFrame | None = None, waves: int = 1, at_once: int = 1,
) -> dict[str, dict[str, int]]:
    """Deliver every template, ``at_once`` of them side by side; failures (also of the gate) are raised together at the end.

    A repeated delivery of the same run sends only payloads that have no final answer (below 500) yet: changed payloads count as new ones. Each
    of the ``waves`` is stored before the next is sent, so more waves mean less to send twice after a crash, and more jobs.
    """
    counts = {template.code: {"written": 0, "quarantined": 0} for template in templates}

    def work(template: Template) -> None:
        deliver_template(spark, run, template, settings, answer, counts[template.code], masterdata, tags, waves)
        check_gate(counts[template.code], run.max_quarantine_ratio)

    done = each(spark, templates, work, at_once)
    failures = [Failure("delivery", template.code, error) for template, _, error in done if error is not None]
    if failures:
        raise StageFailed(failures, counts)
    return counts
