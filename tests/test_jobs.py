import glob
import json
import threading
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from plumbline.functions.geometry import GEOMETRY
from plumbline.functions.wkb import to_wkb
from plumbline.operators.payload import PayloadSettings, Template
from plumbline.operators import quarantine
from plumbline.operators.privacy import Privacy
from plumbline.operators.quarantine import RECORD, STANDARDIZATION, quarantine_records
from plumbline.operators.validate import Rules
from plumbline.plans.deliver import deliver
from plumbline.plans.errors import Failure, StageFailed, TooManyRejects
from plumbline.plans.extract import extract
from plumbline.plans.standardize import Run, standardize
from plumbline.plans.together import each
from plumbline.sources.layout import dataset_path, run_folder
from plumbline.sources.published import newest
from plumbline.sources.quarantine import Scope, write_quarantine
from plumbline.sources.tables import JdbcTables, Partitioning, read_dataset, write_dataset
from tests.test_geometry import BOW_TIE, polygon, shape, square


@pytest.mark.parametrize("run_id,expected", [
    ("manual__2024-03-01T10:20:30.5+00:00", "20240301T102030.500000Z"), ("2024-03-01T10:20:30", "20240301T102030.000000Z"),
    ("scheduled__2024-03-01T10:20:30+00:00", "scheduled__2024-03-01T10:20:30+00:00"), ("manual-test-001", "manual-test-001"),
])
def test_run_ids(run_id, expected):
    assert run_folder(run_id) == expected
    assert dataset_path("base/", run_id, "t") == f"base/run_id={expected}/t.parquet"


def test_jdbc_arguments():
    source = JdbcTables("jdbc:postgresql://h:5432/db", "Sch", "u", "p", partitioning={"Big": Partitioning("Id", 0, 1000, 8)})
    plain, cut = source.options('odd"name'), source.options("Big")
    assert plain["table"] == '"Sch"."odd""name"' and "column" not in plain
    assert plain["properties"]["driver"] == "org.postgresql.Driver" and "p" not in repr(source).split("password")[-1:]
    assert (cut["column"], cut["lowerBound"], cut["upperBound"], cut["numPartitions"]) == ('"Id"', 0, 1000, 8)


def test_write_refuses_or_replaces(spark, tmp_path):
    path = str(tmp_path / "d.parquet")
    write_dataset(spark.range(3), path)
    with pytest.raises(Exception, match="(?i)already exists"):
        write_dataset(spark.range(2), path, overwrite=False)
    write_dataset(spark.range(1), path)
    assert read_dataset(spark, path).count() == 1


def test_a_failed_attempt_leaves_what_was_published(spark, tmp_path):
    base, path = str(tmp_path), dataset_path(str(tmp_path), "r", "d")
    write_dataset(spark.range(3), path)
    reader = read_dataset(spark, path)
    with pytest.raises(Exception, match="broken"):
        write_dataset(spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id")), path)
    assert read_dataset(spark, path).count() == 3
    write_dataset(spark.range(5), path)
    assert reader.count() == 3 and read_dataset(spark, path).count() == 5  # a reader that has begun keeps its files
    assert read_dataset(spark, path, base).columns == ["id", "run_id"]
    assert newest(spark, path).number == 2 and newest(spark, f"{base}/none") is None
    spark.range(4).write.parquet(f"{base}/plain")
    assert read_dataset(spark, f"{base}/plain").count() == 4


def test_standardize_again(spark, run):
    path = dataset_path(run.standard, run.run_id, "PIPE")
    standardize(spark, run, [TEMPLATE], TABLES, MAPPING)
    first = newest(spark, path)
    with pytest.raises(StageFailed):  # the quarantine cannot be written, so nothing is published
        standardize(spark, replace(run, quarantine="nowhere://q"), [TEMPLATE], TABLES, MAPPING)
    assert newest(spark, path) == first and read_dataset(spark, path).count() == 2
    standardize(spark, run, [TEMPLATE], TABLES, MAPPING)
    assert newest(spark, path).number == 2 and spark.read.json(run.quarantine).count() == 5
    halves = glob.glob(f"{path}/attempts/{newest(spark, path).attempt}/outcome=*/*.parquet")
    assert halves and not glob.glob(f"{path}/*.parquet")  # each row is stored once


def test_standardize_with_rejects_only(spark, run):
    table = spark.createDataFrame([(None, None, None, "x")], "id string, name string, geom binary, n string")
    write_dataset(table, dataset_path(run.raw, run.run_id, "pipes"), "geom")
    assert standardize(spark, run, [TEMPLATE], {"PIPE": ["pipes"]}, MAPPING)["PIPE"] == {"written": 0, "quarantined": 1}
    stored = read_dataset(spark, dataset_path(run.standard, run.run_id, "PIPE"))
    assert stored.count() == 0 and stored.columns == ["id", "name", "geom", "N"]


def test_record_fields(spark):
    df = spark.createDataFrame([("a", None, 1.5)], "id string, codeReference string, v double")
    record = quarantine_records(df, "r", "DEV", "T", STANDARDIZATION, "invalid_type", "why", failed_at="2024-03-01 23:59:59")
    assert record.columns == RECORD.names
    row = record.first()
    assert json.loads(row["asset"]) == {"id": "a", "codeReference": None, "v": 1.5}
    assert (row["error_code"], row["error_message"], row["source_id"], row["field_name"]) == ("invalid_type", "why", "a", None)


def test_quarantine_lines(spark, tmp_path):
    df = spark.createDataFrame([("a", shape("Point", [[[1.0, 2.5]]])), ("é", None)], f"id string, geom {GEOMETRY.simpleString()}")
    path = str(tmp_path / "q")
    for _ in range(2):  # a repeated write replaces its folders
        write_quarantine(quarantine_records(df, "run 1/x", "DEV", "T", STANDARDIZATION, "c", "m", failed_at="2024-03-01 23:30:00"), path)
    files = glob.glob(f"{path}/environment=DEV/date=2024-03-01/run_id=*/template=T/stage=standardization/attempt=1/part-*")
    lines = [json.loads(line) for f in files for line in open(f, encoding="utf-8")]
    assert sorted(line["asset"]["id"] for line in lines) == ["a", "é"]
    assert list(lines[0]) == RECORD.names and lines[0]["failed_at"] == "2024-03-01T23:30:00+00:00" and lines[0]["run_id"] == "run 1/x"
    assert {line["asset"]["geom"] for line in lines} == {"POINT (1 2.5)", None}
    write_quarantine(quarantine_records(df, "run 1/x", "DEV", "T", STANDARDIZATION, "c", "m", failed_at="2024-03-01 23:30:00"), path, "2")
    assert spark.read.text(path).count() == 4  # another attempt adds
    write_quarantine(quarantine_records(df.limit(0), "r2", "DEV", "T", STANDARDIZATION, "c", "m"), path)
    assert not glob.glob(f"{path}/environment=DEV/date=*/run_id=r2")


def records_of(spark, rows, day, run_id="run 1/x"):
    df = spark.createDataFrame(rows, "id string, v string")
    return quarantine_records(df, run_id, "DEV", "T", STANDARDIZATION, "c", "m", failed_at=f"{day} 12:00:00")


def test_a_repeat_on_another_day_adds_nothing_and_leaves_nothing_stale(spark, tmp_path):
    path, scope = str(tmp_path / "q"), Scope("DEV", "run 1/x", "T", STANDARDIZATION)

    def stored():
        return sorted((r["asset"]["id"], r["failed_at"][:10], r["quarantine_id"]) for r in spark.read.json(path).collect())

    write_quarantine(records_of(spark, [("a", "1"), ("b", "1")], "2024-03-01"), path, scope=scope)
    write_quarantine(records_of(spark, [("z", "1")], "2024-03-01", "other"), path)
    first = stored()
    write_quarantine(records_of(spark, [("a", "1"), ("b", "1")], "2024-03-02"), path, scope=scope)
    assert stored() == first
    write_quarantine(records_of(spark, [("b", "1"), ("c", "1")], "2024-03-03"), path, scope=scope)
    assert [r[:2] for r in stored()] == [("b", "2024-03-01"), ("c", "2024-03-03"), ("z", "2024-03-01")]
    write_quarantine(records_of(spark, [("c", "1")], "2024-03-04"), path)  # scopes from the records
    assert [r[:2] for r in stored()] == [("c", "2024-03-03"), ("z", "2024-03-01")]
    write_quarantine(records_of(spark, [], "2024-03-05"), path, scope=scope)
    assert [r[:2] for r in stored()] == [("z", "2024-03-01")]


def test_equal_records_have_ids_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(quarantine, "STRETCH", 3)
    rows = [("a", "1")] * 8 + [("a", "2"), (None, None), (None, None), ("b", "1")]
    ids = [sorted(r["quarantine_id"] for r in records_of(spark, rows[::step], "2024-03-01").collect()) for step in (1, -1)]
    assert ids[0] == ids[1] and len(set(ids[0])) == len(rows)
    assert set(r["quarantine_id"] for r in records_of(spark, rows, "2024-03-01", "run 2").collect()).isdisjoint(ids[0])


class Source:
    """Two small tables with a bad geometry, a duplicate, an uncastable value and a missing id."""

    def read(self, spark, table):
        if table == "broken":
            raise RuntimeError("no such table")
        rows = {
            "pipes": [("1", "one", polygon(square(0, 0)), "5"), ("2", None, polygon(BOW_TIE), "6"), ("3", "three", None, "x")],
            "valves": [("4", "four", None, None), ("4", "again", None, None), (None, None, None, "1"), ("5", "five", None, "7")],
        }[table]
        df = spark.createDataFrame(rows, f"id string, name string, geom {GEOMETRY.simpleString()}, n string")
        return df.withColumn("geom", F.hex(to_wkb(F.col("geom"))) if table == "pipes" else to_wkb(F.col("geom")))


TEMPLATE = Template(1, "PIPE", geometry_type="MultiPolygon", characteristics=({"code": "N", "name": "n", "type": "integer"},))
MAPPING = {"N": {"field": "n", "default_value": 0}}
TABLES = {"PIPE": ["pipes", "valves"]}


@pytest.fixture
def run(spark, tmp_path):
    run = Run("run-1", "DEV", str(tmp_path / "raw"), str(tmp_path / "standard"), str(tmp_path / "quarantine"), 1.0, Rules(),
              Privacy("salt", 10, 0, ("name",), ("geom",)), ledger=str(tmp_path / "ledger"))
    extract(spark, Source(), TABLES, run.raw, run.run_id, "geom")
    return run


def test_extract_isolates_failures(spark, tmp_path):
    with pytest.raises(StageFailed) as caught:
        extract(spark, Source(), {"A": ["broken", "pipes"], "B": [], "C": ["broken"]}, str(tmp_path), "r", "geom")
    assert len(caught.value.failures) == 3 and "no such table" in str(caught.value.failures[0])
    stored = read_dataset(spark, dataset_path(str(tmp_path), "r", "pipes"))
    assert stored.count() == 3 and stored.schema["geom"].dataType.simpleString() == "binary"


def test_standardize(spark, run):
    counts = standardize(spark, run, [TEMPLATE], TABLES, MAPPING)["PIPE"]
    assert counts == {"written": 2, "quarantined": 5}
    standard = read_dataset(spark, dataset_path(run.standard, run.run_id, "PIPE"))
    assert standard.columns == ["id", "name", "geom", "N"] and standard.schema["geom"].metadata == {"geometry": "wkb"}
    assert {(r["id"], r["N"]) for r in standard.collect()} == {("1", 5), ("5", 7)}
    assert all(r["name"].startswith("ANON_") for r in standard.collect())
    lost = spark.read.json(run.quarantine)
    assert {(r["source_id"], r["error_code"]) for r in lost.collect()} == {
        ("2", "invalid_geometry"), ("3", "invalid_type"), ("4", "duplicated_id"), (None, "required_field_missing")}
    bad = lost.filter("error_code = 'invalid_geometry'").first()["asset"]
    assert bad["geom"] == "MULTIPOLYGON (((10 0, 11 1, 11 0, 10 1, 10 0)))" and bad["name"].startswith("ANON_")
    assert lost.filter("error_code = 'required_field_missing'").first()["field_name"] == "id,name"


def test_gate_fails_after_everything_is_stored(spark, run):
    with pytest.raises(StageFailed, match="PIPE: quarantine took 5/7") as caught:
        standardize(spark, replace(run, max_quarantine_ratio=0.5), [TEMPLATE], TABLES, MAPPING)
    assert caught.value.outcomes["PIPE"]["quarantined"] == 5
    assert read_dataset(spark, dataset_path(run.standard, run.run_id, "PIPE")).count() == 2
    assert spark.read.json(run.quarantine).count() == 5
    ratio = 5 / 7
    assert standardize(spark, replace(run, max_quarantine_ratio=ratio), [TEMPLATE], TABLES, MAPPING)["PIPE"] == {"written": 2, "quarantined": 5}


def test_one_failing_template_does_not_stop_the_others(spark, run):
    with pytest.raises(StageFailed) as caught:
        standardize(spark, run, [Template(2, "NONE"), TEMPLATE], TABLES, MAPPING)
    assert len(caught.value.failures) == 1 and caught.value.failures[0].item == "NONE"
    assert read_dataset(spark, dataset_path(run.standard, run.run_id, "PIPE")).count() == 2


def test_empty_tables(spark, tmp_path):
    run = Run("r", "DEV", str(tmp_path / "raw"), str(tmp_path / "standard"), str(tmp_path / "quarantine"), 0.0)
    empty = spark.createDataFrame([], "id string, name string, geom binary, n string")
    write_dataset(empty, dataset_path(run.raw, "r", "pipes"), "geom")
    assert standardize(spark, run, [TEMPLATE], {"PIPE": ["pipes"]}, MAPPING)["PIPE"] == {"written": 0, "quarantined": 0}
    assert read_dataset(spark, dataset_path(run.standard, "r", "PIPE")).columns == ["id", "name", "geom", "N"]


def answering(status):
    return lambda batches: batches.select("batch_id", F.lit(status).alias("status"), F.lit("text").alias("body"))


@pytest.mark.parametrize("status,written,quarantined", [(200, 2, 0), (422, 0, 2)])
def test_deliver(spark, run, status, written, quarantined):
    standardize(spark, run, [TEMPLATE], TABLES, MAPPING)
    target = replace(run, quarantine=run.quarantine + "-delivery")
    counts = deliver(spark, target, [TEMPLATE], PayloadSettings(batch_size=1), answering(status))["PIPE"]
    assert counts == {"written": written, "quarantined": quarantined}
    if quarantined:
        rows = spark.read.json(target.quarantine).collect()
        assert {(r["stage"], r["error_code"], r["error_message"], r["code_reference"]) for r in rows} == {
            ("upload", "dmd_rejected_asset", "text", "1"), ("upload", "dmd_rejected_asset", "text", "5")}
        assert rows[0]["asset"]["templateCode"] == "PIPE"


def test_failed_delivery_keeps_the_rejects(spark, run):
    rows = [("1", "a", None, "x"), ("2", "b", None, "7")]
    df = spark.createDataFrame(rows, f"id string, name string, geom {GEOMETRY.simpleString()}, N string")
    write_dataset(df, dataset_path(run.standard, run.run_id, "PIPE"), "geom")
    with pytest.raises(StageFailed, match="status 500: text") as caught:
        deliver(spark, run, [TEMPLATE], PayloadSettings(), answering(500))
    assert caught.value.outcomes["PIPE"]["quarantined"] == 1
    lost = spark.read.json(run.quarantine).collect()
    assert [(r["source_id"], r["stage"], r["error_code"], r["asset"]["N"]) for r in lost] == [("1", "serialization", "invalid_type", "x")]


def test_every_batch_is_sent_once(spark, run):
    standardize(spark, run, [TEMPLATE], TABLES, MAPPING)
    sent = spark.sparkContext.accumulator(0)

    def answer(batches):
        def post(frames):
            for frame in frames:
                sent.add(len(frame))
                yield frame[["batch_id"]].assign(status=422, body="no")
        return batches.mapInPandas(post, "batch_id bigint, status int, body string")

    deliver(spark, run, [TEMPLATE], PayloadSettings(batch_size=1), answer)
    assert sent.value == 2


class Meeting:
    """A source whose tables can only be read two at a time: each read waits for the other one to begin."""

    def __init__(self):
        self.barrier, self.read_tables = threading.Barrier(2, timeout=60), []

    def read(self, spark, table):
        self.read_tables.append(table)
        self.barrier.wait()
        if table == "broken":
            raise RuntimeError("no such table")
        return Source().read(spark, table)


def test_tables_are_extracted_side_by_side(spark, tmp_path):
    source = Meeting()
    with pytest.raises(StageFailed) as caught:
        extract(spark, source, {"A": ["pipes", "broken"], "B": ["broken"]}, str(tmp_path), "r", "geom", at_once=2)
    assert [f.item for f in caught.value.failures] == ["A/broken", "B/broken"] and sorted(source.read_tables) == ["broken", "pipes"]
    assert read_dataset(spark, dataset_path(str(tmp_path), "r", "pipes")).count() == 3


def test_templates_side_by_side_give_the_same(spark, run):
    templates = [replace(TEMPLATE, code=c) for c in ("PIPE", "TUBE", "HOSE")]
    tables = {"PIPE": ["pipes", "valves"], "TUBE": ["pipes"], "HOSE": ["valves"]}
    one = standardize(spark, run, templates, tables, MAPPING)
    assert standardize(spark, run, templates, tables, MAPPING, at_once=3) == one
    tried = deliver(spark, run, templates, PayloadSettings(), answering(200), at_once=2)
    assert {k: v["written"] for k, v in tried.items()} == {k: v["written"] for k, v in one.items()}
    assert not spark.getTags()


def test_jobs_of_an_interrupted_stage_are_cancelled(spark, monkeypatch):
    tags = []
    monkeypatch.setattr(type(spark), "interruptTag", lambda self, tag: tags.append(tag))

    def work(item):
        if item == 1:
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        each(spark, range(6), work, 2)
    assert len(tags) == 1


def assets(spark, run, ids):
    df = spark.createDataFrame([(str(k), f"asset {k}", None, str(k)) for k in ids], f"id string, name string, geom {GEOMETRY.simpleString()}, N string")
    write_dataset(df, dataset_path(run.standard, run.run_id, "PIPE"), "geom")


def sends(spark, paths):
    rows = [r[0] for path in paths for r in spark.read.parquet(path).select(F.inline("items")).select("source_id").collect()]
    return {k: rows.count(k) for k in rows}


def test_a_repeated_delivery_sends_what_has_no_answer(spark, run, tmp_path):
    assets(spark, run, range(40))
    tries = []

    def answer(status):
        def told(batches):
            tries.append(str(tmp_path / f"sent-{len(tries)}"))
            batches.write.parquet(tries[-1])
            return spark.read.parquet(tries[-1]).select("batch_id", status.alias("status"), F.lit("said").alias("body"))
        return told

    first = F.col("items")[0]["source_id"].cast("int")
    settings = PayloadSettings(batch_size=1)
    with pytest.raises(StageFailed, match="status 503") as caught:
        deliver(spark, run, [TEMPLATE], settings, answer(F.when(first % 4 == 0, 503).when(first % 5 == 0, 422).otherwise(200)))
    assert caught.value.outcomes["PIPE"] == {"written": 24, "quarantined": 6}
    assert deliver(spark, run, [TEMPLATE], settings, answer(F.lit(200)))["PIPE"] == {"written": 34, "quarantined": 6}
    assert sends(spark, tries) == {str(k): 2 if k % 4 == 0 else 1 for k in range(40)}
    assert spark.read.json(run.quarantine).count() == 6  # of the first try, not lost by the second
    done = len(tries)
    assets(spark, run, range(42))  # two more assets in a new version of the dataset
    assert deliver(spark, run, [TEMPLATE], settings, answer(F.lit(200)))["PIPE"] == {"written": 36, "quarantined": 6}
    assert sends(spark, tries[done:]) == {"40": 1, "41": 1}


def test_a_delivery_that_breaks_between_waves_goes_on_there(spark, run, tmp_path):
    assets(spark, run, range(60))
    tries = []

    def answer(last):
        def told(batches):
            if len(tries) == last:
                raise ConnectionError("the line is down")
            tries.append(str(tmp_path / f"sent-{len(tries)}"))
            batches.write.parquet(tries[-1])
            return spark.read.parquet(tries[-1]).select("batch_id", F.lit(200).alias("status"), F.lit("ok").alias("body"))
        return told

    with pytest.raises(StageFailed, match="the line is down") as caught:
        deliver(spark, run, [TEMPLATE], PayloadSettings(batch_size=4), answer(2), waves=4)
    assert 0 < caught.value.outcomes["PIPE"]["written"] < 60
    assert deliver(spark, run, [TEMPLATE], PayloadSettings(batch_size=7), answer(None), waves=2)["PIPE"] == {"written": 60, "quarantined": 0}
    assert sends(spark, tries) == {str(k): 1 for k in range(60)}


def test_missing_standard_data_fails_the_template(spark, run):
    with pytest.raises(StageFailed, match="PIPE"):
        deliver(spark, run, [TEMPLATE], PayloadSettings(), answering(200))


def test_gate_error_text():
    error = TooManyRejects({"written": 4, "quarantined": 6}, 0.2)
    assert "60.00%" in str(error) and "6/10" in str(error)
    assert str(Failure("delivery", "PUMP", error)).startswith("[delivery] PUMP: quarantine took")
