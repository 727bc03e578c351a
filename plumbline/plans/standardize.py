"""Standardise: raw datasets to standard datasets, quarantine and quality gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.geo import decode_geometry, geometry_bytes, promote_geometry
from plumbline.operators.metrics import count_columns, quarantined_share
from plumbline.operators.payload import Template
from plumbline.operators.privacy import Privacy, pseudonymise
from plumbline.operators.project import fill_name, union_tables
from plumbline.operators.quarantine import STANDARDIZATION, quarantine_records
from plumbline.operators.skew import shared_folder
from plumbline.operators.validate import INVALID_TYPE, Rules, classify
from plumbline.plans.errors import Failure, StageFailed, TooManyRejects
from plumbline.plans.together import each
from plumbline.sources.layout import dataset_path, run_folder
from plumbline.sources.published import attempt_path, new_attempt, publish
from plumbline.sources.quarantine import Scope, write_quarantine
from plumbline.sources.tables import read_template_tables


@dataclass(frozen=True)
class Run:
    """What the stages of one run share; ``attempt`` names this try of the run in the quarantine."""

    run_id: str
    environment: str
    raw: str
    standard: str
    quarantine: str
    max_quarantine_ratio: float
    rules: Rules = field(default_factory=Rules)
    privacy: Privacy | None = None
    attempt: str = "1"
    #: Where deliveries keep their ledgers; a folder that outlives the session, by default one in the shared folder.
    ledger: str | None = None

    def ledger_path(self, spark: SparkSession, template: str) -> str:
        """Folder of a template's ledger in this run."""
        if self.ledger is None:
            return stage_path(spark, self, "ledger", template)
        return f"{self.ledger.rstrip('/')}/{self.environment}/{run_folder(self.run_id)}/{template}"

    def scope(self, template: Template, stage: str) -> Scope:
        """Whose quarantine records a stage of this run stores for a template."""
        return Scope(self.environment, self.run_id, template.code, stage, self.attempt)


def standard_rows(
    spark: SparkSession, run: Run, template: Template, tables: Sequence[str], mapping: Mapping[str, Mapping]
) -> DataFrame:
    """Projected, unified, named, promoted and pseudonymised rows of a template; one lazy plan."""
    projected = read_template_tables(
        spark, run.raw, run.run_id, tables, run.rules.core_fields, template.characteristics, mapping,
        run.rules.geometry_column,
    )
    named = fill_name(union_tables(projected), run.rules.id_column)
    promoted = promote_geometry(named, template.geometry_type, run.rules.geometry_column)
    return pseudonymise(promoted, run.privacy) if run.privacy else promoted


def stage_path(spark: SparkSession, run: Run, stage: str, template: str) -> str:
    """Run-scoped place in the shared folder for a stage's intermediate table."""
    return f"{shared_folder(spark)}/plumbline/{stage}/{run.environment}/{run_folder(run.run_id)}/{template}"


def standardize_template(
    spark: SparkSession, run: Run, template: Template, tables: Sequence[str], mapping: Mapping[str, Mapping]
) -> dict[str, int]:
    """Classify once and store the result once, split by outcome: the valid half is the standard dataset.

    The raw data, the joins and the geometry checks run a single time, every row is written a single time, and the counts come from
    that same pass. The rejected half is read back for the quarantine, which is written before the valid half is published and the
    gate is judged; if anything fails before, readers still see the version that was published last.
    """
    geometry_column = run.rules.geometry_column
    classified = classify(standard_rows(spark, run, template, tables, mapping), run.rules)
    seen = Observation()
    stored = geometry_bytes(classified.observe(seen, *count_columns()), geometry_column).withColumn(
        "outcome", F.when(F.col("reject").isNull(), F.lit("valid")).otherwise(F.lit("rejected"))
    )
    path, attempt = dataset_path(run.standard, run.run_id, template.code), new_attempt()
    stored.write.partitionBy("outcome").parquet(attempt_path(path, attempt))
    outcome = {"written": seen.get["written"], "quarantined": seen.get["quarantined"]}

    schema = stored.drop("outcome").schema
    rejected = spark.read.schema(schema).parquet(f"{attempt_path(path, attempt)}/outcome=rejected") if outcome["quarantined"] else spark.createDataFrame([], schema)
    write_quarantine(quarantine_records(
        decode_geometry(rejected, geometry_column), run.run_id, run.environment, template.code, STANDARDIZATION,
        INVALID_TYPE, "Asset failed final validation.",
    ), run.quarantine, scope=run.scope(template, STANDARDIZATION))
    publish(spark, path, attempt, stored.drop("outcome", "reject").schema, "outcome=valid")
    return outcome


def check_gate(outcome: Mapping[str, int], limit: float) -> None:
    """The limit itself is allowed."""
    if quarantined_share(outcome) > limit:
        raise TooManyRejects(outcome, limit)


def standardize(
    spark: SparkSession, run: Run, templates: Sequence[Template], tables: Mapping[str, Sequence[str]],
    mapping: Mapping[str, Mapping], at_once: int = 1,
) -> dict[str, dict[str, int]]:
    """Standardise every template, ``at_once`` of them side by side; failures (also of the gate) are raised together at the end."""
    counts: dict[str, dict[str, int]] = {}

    def work(template: Template) -> None:
        counts[template.code] = standardize_template(spark, run, template, tables.get(template.code) or (), mapping)
        check_gate(counts[template.code], run.max_quarantine_ratio)

    done = each(spark, templates, work, at_once)
    failures = [Failure("standardization", template.code, error) for template, _, error in done if error is not None]
    if failures:
        raise StageFailed(failures, counts)
    return {template.code: counts[template.code] for template in templates}
