"""Empty inputs, also ones the optimizer knows to be empty, give empty results and never block."""

import pytest
from pyspark.sql import functions as F

from plumbline.functions.geometry import GEOMETRY
from plumbline.operators.batches import assemble_batches
from plumbline.operators.lookup import attach_signals, masterdata_index, tag_index
from plumbline.operators.payload import PayloadSettings, Template, build_payloads
from plumbline.operators.validate import Rules, classify


@pytest.fixture(params=["none", "filtered", "one"])
def assets(spark, request):
    if request.param == "none":
        return spark.createDataFrame([], f"id string, name string, geom {GEOMETRY.simpleString()}"), 0
    one = spark.sql("SELECT 'a' AS id, 'n' AS name").withColumn("geom", F.lit(None).cast(GEOMETRY))
    return (one.filter("id = 'b'"), 0) if request.param == "filtered" else (one, 1)


@pytest.mark.parametrize("max_bytes", [1 << 20, -1])
def test_empty_inputs(spark, assets, max_bytes):
    df, count = assets
    assert classify(df, Rules(), max_bytes).count() == count
    tags = spark.createDataFrame([], "name string, uid string, pos bigint")
    relations = spark.createDataFrame([], "entry_pos int, code string, name string, rel_pos int, value string, id bigint")
    assert tag_index(tags).count() == 0
    assert attach_signals(df, tags, "id", max_bytes=max_bytes).count() == count
    index = masterdata_index(relations, max_bytes)
    assert index.count() == 0
    template = Template(1, "T", characteristics=({"code": "m", "type": "maindata"}, {"code": "g", "type": "iotsignal"}))
    built = build_payloads(df.withColumn("m", F.lit("x")), template, PayloadSettings(), index, tags, max_bytes=max_bytes)
    assert built.count() == count
    rows = built.select(F.col("id").alias("source_id"), F.lit("r").alias("code_reference"), F.to_json("payload").alias("payload"))
    assert assemble_batches(rows, 10).count() == count
