"""Work that is little to read and much to compute: spread over tasks, computed once, without an exception for each wrong text."""

import pytest
from pyspark.sql import functions as F

from plumbline.functions.casting import safe_cast
from plumbline.operators.project import INVALID_FIELDS, project_to_template
from plumbline.sources.quarantine import write_quarantine
from registry import geometry, shaping


@pytest.mark.parametrize("query, name, columns", [
    (shaping.wide_projection, "customer", "id AS c_custkey"),
    (geometry.ring_validity, "part", "id AS p_partkey, CAST(id % 5 AS int) AS p_size"),
])
def test_a_file_of_one_split_is_computed_in_several_tasks(spark, tmp_path, query, name, columns):
    spark.range(40).coalesce(1).selectExpr(*columns.split(", ")).write.parquet(f"{tmp_path}/{name}.parquet")
    found = query(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert found.count() == 40


def test_wrong_text_is_told_by_compiled_code_and_not_cast(spark):
    texts = ["7", " -7 ", "3.7", ".5", "x", "3000000000", "1e3", "1d", "0x1p3", " NaN", "-inf", "abc", "+", "5 ", None]
    raw = spark.createDataFrame(list(enumerate(texts)), "id long, s string").repartition(1)
    template = [{"code": "i", "type": "integer"}, {"code": "d", "type": "double"}]
    df = project_to_template(raw, ["id"], template, {"i": {"field": "s"}, "d": {"field": "s"}})
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" not in plan and "RLIKE" in safe_cast("s", raw.schema["s"].dataType, "double")
    rows = {r["id"]: r for r in df.withColumn("d", F.col("d").cast("string")).collect()}
    assert [rows[k]["i"] for k in range(len(texts))] == [7, -7, 3, 0, None, None, None, None, None, None, None, None, None, 5, None]
    assert [rows[k]["d"] for k in range(len(texts))] == [
        "7.0", "-7.0", "3.7", "0.5", None, "3.0E9", "1000.0", "1.0", "8.0", "NaN", "-Infinity", None, None, None, None]
    assert rows[4][INVALID_FIELDS] == ["i", "d"] and rows[0][INVALID_FIELDS] == [] and rows[14][INVALID_FIELDS] == []


def test_records_without_scope_are_derived_once(spark, tmp_path):
    from plumbline.operators.quarantine import RECORD

    seen = spark.sparkContext.accumulator(0)

    def told(rows):
        for row in rows:
            seen.add(1)
            yield row

    value = {n: f"'{n}'" for n in RECORD.names} | {"failed_at": "timestamp'2024-03-01 08:00:00'", "asset": "'{}'", "source_id": "CAST(id AS string)"}
    base = spark.range(20).selectExpr(*[f"{v} AS {n}" for n, v in value.items()])
    records = spark.createDataFrame(base.rdd.mapPartitions(told), RECORD)
    write_quarantine(records, str(tmp_path / "quarantine"))
    assert seen.value == 20
    assert spark.read.json(str(tmp_path / "quarantine")).count() == 20


def test_rows_behind_records_are_read_once(spark):
    from plumbline.operators.quarantine import row_records

    seen = spark.sparkContext.accumulator(0)

    def told(rows):
        for row in rows:
            seen.add(1)
            yield row

    rows = [("{}", str(i % 15), ("code", "message", None)) for i in range(20)]
    schema = "asset string, source_id string, reject struct<code:string,message:string,field:string>"
    lost = spark.createDataFrame(spark.createDataFrame(rows, schema).rdd.mapPartitions(told), schema)
    ids = [r["quarantine_id"] for r in row_records(lost, "run", "DEV", "T", "serialization").collect()]
    assert len(ids) == len(set(ids)) == 20 and seen.value == 20
