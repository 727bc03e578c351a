"""Extract: source tables to raw datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from plumbline.plans.errors import Failure, StageFailed
from plumbline.plans.together import each
from plumbline.sources.layout import dataset_path
from plumbline.sources.tables import write_dataset


def extract(
    spark: SparkSession, source, tables: Mapping[str, Sequence[str]], raw_base: str, run_id: str, geometry_column: str, at_once: int = 1,
) -> None:
    """Store every table of every template as raw data, ``at_once`` tables side by side.

    A failing table does not stop the others; all failures are raised together at the end. A table of several templates is stored once.
    """
    def store(name: str) -> None:
        # Hex text becomes bytes on the way; geometries are first decoded where they are needed.
        write_dataset(source.read(spark, name), dataset_path(raw_base, run_id, name), geometry_column)

    wanted = dict.fromkeys(name for names in tables.values() for name in names or ())
    errors = {name: error for name, _, error in each(spark, wanted, store, at_once) if error is not None}
    failures = []
    for template, names in tables.items():
        if not names:
            failures.append(Failure("extraction", template, "it names no table to read"))
        failures += [Failure("extraction", f"{template}/{name}", errors[name]) for name in names or () if name in errors]
    if failures:
        raise StageFailed(failures)
