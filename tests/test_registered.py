"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare


#: The text operators have tests of their own.
OWN = sorted(name for area in entry.AREAS if area.__name__.startswith("registry.") for name in area.QUERIES)


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, sf_dir, name):
    assert compare(spark, sf_dir, name, entry.queries()[name], entry.oracle_sql().get(name)) is None


def test_every_query_has_a_twin():
    assert set(OWN) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    counts = {r["code"]: r["n"] for r in entry.entry(spark).collect()}
    assert counts["ok"] > 0 and set(counts) <= {
        "ok", "invalid_type", "required_field_missing", "duplicated_id", "invalid_geometry"}
