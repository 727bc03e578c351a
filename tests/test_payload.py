import datetime
import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from plumbline.functions.geometry import GEOMETRY
from plumbline.functions.text import characteristic_name, double_text, pseudonym, timestamp_text
from plumbline.operators import lookup, skew
from plumbline.operators.batches import assemble_batches, batch_body, batch_rows, outcome, route_outcomes
from plumbline.operators.lookup import attach_signals, masterdata_id, masterdata_index
from plumbline.operators.payload import PayloadSettings, Template, build_payloads, payload_json
from plumbline.operators.privacy import Privacy, clear_siblings, pseudonymise
from plumbline.sources.metadata import load_template, masterdata_relations, tag_catalogue
from tests.test_geometry import shape

SETTINGS = PayloadSettings(name_prefix="P - ", code_reference_prefix="P - ", main_hierarchy_parent=7)


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("name,expected", [
    ("Asset Name", "Asset_Name"), ("Status_-_Value", "Status_Value"), (None, ""), ("Asset Name_-_Status", "Asset_Name_Status"),
    ("A - B", "A_B"),
])
def test_names(spark, name, expected):
    assert one(spark, characteristic_name(F.lit(name).cast("string"))) == expected


def test_double_text_is_python_text(spark):
    numbers = [0.0, -0.0, 1.0, -1.5, 1e7, 12345678.9, 1e15, 1e16, 123456789012345680.0, 1e-3, 1e-4, 0.00012345, 1e-5, -2.5e-7,
               1e22, 1e300, 2.0**-24, 2.0**-44, 0.1 + 0.2, 100.0, float("nan"), float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in numbers], "v double")
    assert [r[0] for r in df.select(F.expr(double_text("v"))).collect()] == [repr(v) for v in numbers]


def test_timestamp_text(spark):
    moments = [datetime.datetime(2023, 12, 25), datetime.datetime(2023, 12, 25, 1, 2, 3, 4000)]
    df = spark.createDataFrame([(m,) for m in moments], "t timestamp")
    assert [r[0] for r in df.select(timestamp_text(F.col("t"))).collect()] == [m.isoformat() for m in moments]
    assert [r[0] for r in df.select(timestamp_text(F.col("t"), " ")).collect()] == [str(m) for m in moments]


def test_pseudonyms(spark):
    import hashlib
    df = spark.createDataFrame([(" Main St ",), ("main st",), ("",), ("  ",), (None,)], "v string")
    got = [r[0] for r in df.select(pseudonym(F.col("v"), "s")).collect()]
    expected = "ANON_" + hashlib.sha256(b"s|main st").hexdigest()[:16]
    assert got == [expected, expected, "", "  ", None]
    again = pseudonymise(df, Privacy("s", 1, 1, ("v", "absent"), ("geom",)))
    assert [r[0] for r in again.collect()] == got
    with pytest.raises(TypeError):
        Privacy(text_columns=("v",))


def test_siblings_of_hidden_columns_are_listed():
    mapping = {"a": {"field": "f"}, "b": {"field": "f"}, "c": {"field": "g"}}
    assert clear_siblings(mapping, ["a", "c"]) == {"a": ["b"]} and clear_siblings(mapping, ["a", "b"]) == {}


@pytest.fixture
def snapshots(tmp_path):
    documents = {
        "templates": [{"id": 42, "code": "PUMP", "name": "Pump", "isDeleted": False, "isEnabled": True, "geometryType": "MultiPoint"},
                      {"id": 43, "code": "PUMP", "isDeleted": True}],
        "schemas": [{"id": 42, "characteristics": [{"code": "A", "name": "A", "type": "Integer"}]}],
        "masterdata": [
            {"code": "STATUS", "name": "State", "relations": [{"name": "Active", "id": 1}, {"name": "Old", "id": 5}]},
            {"code": "TYPE", "name": "", "relations": [{"name": "TypeA", "id": 10}, {"name": "TypeA", "id": 11}]},
            {"code": "STATUS", "name": None, "relations": [{"name": "Active", "id": 2}]},
            {"code": "EMPTY", "name": "State", "relations": []},
        ],
        "tags": [{"name": "a", "uid": "3"}, {"name": "a", "uid": "1"}, {"name": "", "uid": "9"}, {"name": "a", "uid": None},
                 {"name": "A", "uid": "4"}, {"name": "a", "uid": "2"}],
    }
    for name, document in documents.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(document))
    return lambda name: str(tmp_path / f"{name}.json")


def test_template_metadata(spark, snapshots):
    template = load_template(spark, snapshots("templates"), snapshots("schemas"), "PUMP")
    assert (template.id, template.geometry_type, template.is_enabled, template.is_deleted) == (42, "MultiPoint", True, False)
    assert template.characteristics == ({"code": "A", "name": "A", "type": "integer"},)
    with pytest.raises(ValueError, match="pump"):
        load_template(spark, snapshots("templates"), snapshots("schemas"), "pump")


@pytest.mark.parametrize("max_bytes", [1 << 25, -1])
def test_masterdata_index(spark, snapshots, max_bytes):
    index = masterdata_index(masterdata_relations(spark, snapshots("masterdata")), max_bytes)
    assert {tuple(r) for r in index.collect()} == {("STATUS", "Active", 2), ("TYPE", "TypeA", 11)}
    df = spark.createDataFrame([(1, "Active"), (2, "Unknown"), (3, None), (4, "Other")], "id int, v string")
    found = masterdata_id(df, "v", index, "STATUS", "m", F.col("id"), max_bytes)
    assert {r["id"]: r["m"] for r in found.collect()} == {1: 2, 2: None, 3: None, 4: None}


def test_many_masterdata_columns_scan_the_rows_once(spark):
    """Beyond the bound too, the plan grows with the number of columns and not with its power."""
    index = spark.createDataFrame([(f"c{k}", f"v{v}", 10 * k + v) for k in range(8) for v in range(3)], "key string, value string, id bigint")
    wide = spark.range(40).select("id", *[F.when(F.col("id") % 7 != k, F.concat(F.lit("v"), F.col("id") % 4)).alias(f"c{k}") for k in range(8)])
    for max_bytes in (1 << 25, -1):
        for n in (1, 8):
            got = lookup.masterdata_ids(wide, {f"c{k}": f"m{k}" for k in range(n)}, index, max_bytes)
            assert got._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 40") == 1
            for r in got.collect():
                assert [r[f"m{k}"] for k in range(n)] == [10 * k + r["id"] % 4 if r["id"] % 7 != k and r["id"] % 4 < 3 else None for k in range(n)]


def test_columns_beyond_the_bound_share_their_shuffles(spark, monkeypatch):
    """One exchange of narrow rows and one of wide rows, for one and for eight columns; values and combinations can be hot, missing or odd."""
    joins = []
    monkeypatch.setattr(lookup, "lookup_join", lambda df, *a, **k: joins.append(skew.lookup_join(df, *a, **k)) or joins[-1])
    index = spark.createDataFrame([(f"c{k}", v, 10 * k + n) for k in range(8) for n, v in enumerate(["a", "b:1", "", "-"])], "key string, value string, id bigint")
    value = lambda k: F.expr(f"CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 3 = 1 THEN element_at(array('b:1', '', '-', 'Unknown', 'else', NULL), CAST(1 + (id + {k}) % 6 AS INT)) END")
    wide = spark.range(3000).select("id", F.col("id").alias("x.y"), *[value(k).alias(f"c{k}") for k in range(8)])
    known = {v: n for n, v in enumerate(["a", "b:1", "", "-"])}
    for n in (1, 8):
        joins.clear()
        got = lookup.masterdata_ids(wide, {f"c{k}": f"m{k}" for k in range(n)}, index, -1)
        assert len(joins) == 2  # narrow rows to values, wide rows to combinations
        shuffles = [j._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for j in joins]
        assert shuffles == [2, 2]  # both sides of one join each
        assert got.columns == wide.columns + [f"m{k}" for k in range(n)] and got.count() == 3000
        for r in got.collect():
            assert [r[f"m{k}"] for k in range(n)] == [10 * k + known[r[f"c{k}"]] if r[f"c{k}"] in known else None for k in range(n)]


@pytest.mark.parametrize("files", [1, 3])
def test_catalogue_of_lines_has_gapless_positions(spark, tmp_path, files):
    """Many splits, blank lines and several files give the positions that the one-document reader gives."""
    tags = [{"name": f"n{k % 7}", "uid": str(k) * (1 + k % 9)} for k in range(2000)]
    (tmp_path / "all.json").write_text(json.dumps(tags))
    (tmp_path / "lines").mkdir()
    for f in range(files):
        own = tags[2000 * f // files : 2000 * (f + 1) // files]
        (tmp_path / "lines" / f"part-{f}").write_text("\n" + "".join(json.dumps(t) + ("\n \n" if k % 50 == 0 else "\n") for k, t in enumerate(own)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        read = tag_catalogue(spark, str(tmp_path / "lines"), lines=True)
        assert read.rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    whole = tag_catalogue(spark, str(tmp_path / "all.json"))
    assert read.columns == whole.columns and sorted(map(tuple, read.collect())) == sorted(map(tuple, whole.collect()))
    assert sorted(r["pos"] for r in read.collect()) == list(range(2000))


def test_masterdata_lines(spark, snapshots, tmp_path):
    entries = json.loads((tmp_path / "masterdata.json").read_text())
    (tmp_path / "entries.jsonl").write_text("\n".join(map(json.dumps, entries)))
    ways = [masterdata_relations(spark, snapshots("masterdata")), masterdata_relations(spark, str(tmp_path / "entries.jsonl"), lines=True)]
    assert ways[0].columns == ways[1].columns
    assert sorted(map(tuple, ways[0].collect()), key=str) == sorted(map(tuple, ways[1].collect()), key=str)
    (tmp_path / "broken.jsonl").write_text(json.dumps(entries[0]) + '\n{"code": \n')
    with pytest.raises(Py4JJavaError, match="alformed"):
        masterdata_relations(spark, str(tmp_path / "broken.jsonl"), lines=True).collect()
    (tmp_path / "empty.jsonl").write_text("\n\n")
    assert masterdata_relations(spark, str(tmp_path / "empty.jsonl"), lines=True).isEmpty()


@pytest.mark.parametrize("max_bytes", [1 << 25, -1])
def test_signals(spark, snapshots, max_bytes):
    tags = tag_catalogue(spark, snapshots("tags"))
    df = spark.createDataFrame([("a",), ("A",), ("b",), (None,)], "id string")
    rows = attach_signals(df, tags, "id", max_bytes).collect()
    lists = {row["id"]: [(s["uid"], s["type"], s["name"]) for s in row["signals"]] for row in rows}
    assert len(rows) == 4
    assert lists == {"a": [(u, "SIGNAL", "a") for u in ("3", "1", "2")], "A": [("4", "SIGNAL", "A")], "b": [], None: []}


def test_crowded_name_is_one_whole_list(spark, monkeypatch):
    """One name owns a third of the tags: its stretches are sorted apart, and the asset still has one row with the whole ordered list."""
    monkeypatch.setattr(lookup, "STRETCH", 500)
    tags = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), F.col("id") % 700)).alias("name"),
        F.col("id").cast("string").alias("uid"), F.when(F.col("id") != 4500, F.col("id")).alias("pos"))
    assets = spark.createDataFrame([("hot",), ("n1",), ("none",)], "id string")
    for max_bytes in (1 << 25, -1):
        got = {r["id"]: [int(s["uid"]) for s in r["signals"]] for r in attach_signals(assets, tags, "id", max_bytes).collect()}
        assert got["hot"] == [4500] + [k for k in range(0, 6000, 3) if k != 4500]
        assert got["none"] == [] and len(got["n1"]) == tags.filter("name = 'n1'").count()


def test_unbuildable_asset_with_many_tags_is_one_record(spark):
    tags = spark.range(2000).select(F.lit("a").alias("name"), F.col("id").cast("string").alias("uid"), F.col("id").alias("pos"))
    df = spark.createDataFrame([("a", "n", "3.7")], "id string, name string, I string")
    template = Template(1, "T", characteristics=({"code": "I", "type": "integer"}, {"code": "G", "type": "iotsignal"}))
    built = build_payloads(df, template, PayloadSettings(), tags=tags)
    assert [r["reject"]["code"] for r in built.collect()] == ["invalid_type"]


CHARACTERISTICS = (
    {"code": "S", "name": "A name", "type": "string"}, {"code": "D", "name": "D", "type": "Double"},
    {"code": "I", "name": "I", "type": "integer"}, {"code": "T", "name": "T", "type": "date"},
    {"code": "M", "name": "M", "type": "maindata"}, {"code": "G", "name": "G", "type": "iotsignal"},
    {"code": "Y", "name": "Y", "type": "iotsynoptic"}, {"code": "B", "name": "B", "type": "boolean"},
    {"code": "X1", "name": "X", "type": "double"}, {"code": "X2", "name": "X", "type": "integer"},
    {"code": "X3", "name": "X", "type": "maindata"}, {"code": "X4", "name": "X", "type": "string"},
)
TEMPLATE = Template(id=42, code="PUMP", is_enabled=True, is_deleted=False, characteristics=CHARACTERISTICS)


def payloads(spark, rows, schema, template=TEMPLATE, settings=SETTINGS, **more):
    built = build_payloads(spark.createDataFrame(rows, schema), template, settings, **more)
    return built.select("*", payload_json(F.col("payload")).alias("json")).collect()


def test_payload(spark):
    schema = f"id string, name string, geom {GEOMETRY.simpleString()}, S string, D double, I int, T timestamp, M string, B boolean"
    rows = [("a", "Pump", shape("Point", [[[10.0, 20.0, 5.0]]], dims="XYZ"), "text", 3.14, 4, datetime.datetime(2023, 12, 25), "Active", True),
            ("b", None, None, None, float("nan"), None, None, "Unknown", None)]
    index = spark.createDataFrame([("M", "Active", 1)], "key string, value string, id bigint")
    tags = spark.createDataFrame([("a", "u2", 0), ("a", "u1", 1)], "name string, uid string, pos bigint")
    first, second = [json.loads(r["json"]) for r in sorted(payloads(spark, rows, schema, masterdata=index, tags=tags), key=lambda r: r["id"])]
    assert list(first) == ["templateId", "templateCode", "characteristics", "name", "isEnabled", "isDeleted", "originId", "geometry",
                           "externalObjects", "mainHierarchyParent", "codeReference"]
    assert (first["templateId"], first["templateCode"], first["name"], first["codeReference"]) == (42, "PUMP", "P - Pump", "P - a")
    assert first["geometry"] == {"type": "Point", "coordinates": [10.0, 20.0]} and second["geometry"] is None
    assert first["externalObjects"] == [{"externalId": "a", "consumerapplicationId": 1}] and first["mainHierarchyParent"] == 7
    assert first["characteristics"][0] == {"name": "A_name", "value": "text", "code": "S", "type": "string"}
    assert {c["code"]: c["value"] for c in first["characteristics"]} == {
        "S": "text", "D": "3.14", "I": "4", "T": "2023-12-25T00:00:00", "M": 1, "B": True, "X1": 0.0, "X2": 0, "X3": None, "X4": "",
        "G": [{"uid": "u2", "type": "SIGNAL", "name": "a"}, {"uid": "u1", "type": "SIGNAL", "name": "a"}]}
    assert {c["code"]: c["value"] for c in second["characteristics"]} == {
        "S": None, "D": "0.0", "I": "0", "T": None, "M": None, "B": None, "X1": 0.0, "X2": 0, "X3": None, "X4": "", "G": []}
    assert second["name"] == "P - None"


def test_lookups_without_catalogues(spark):
    row = payloads(spark, [("a", "n", "Active")], "id string, name string, M string")[0]
    values = {c["code"]: c["value"] for c in json.loads(row["json"])["characteristics"]}
    assert values["M"] is None and values["G"] == []


def test_hash_code_names_the_payload(spark):
    template = Template(1, "T", characteristics=({"code": "XV_hash_code", "name": "h", "type": "string"},))
    rows = payloads(spark, [("a", "n", "HASH123"), ("b", "n", None), ("c", "n", " ")], "id string, name string, XV_hash_code string", template)
    assert sorted(r["payload"]["codeReference"] for r in rows) == ["P - HASH123", "P - b", "P - c"]
    absent = payloads(spark, [("a", "n")], "id string, name string", template)[0]
    assert absent["payload"]["codeReference"] == "P - a"


def test_rows_that_cannot_be_built(spark):
    template = Template(1, "T", characteristics=({"code": "I", "type": "integer"}, {"code": "T", "type": "date"}))
    collection = shape("GeometryCollection", [[[1.0, 2.0]]], members="Point:1")
    rows = [("ok", "n", None, "10", None), ("text", "n", None, "3.7", None), ("day", "n", None, None, "2020"), ("geo", "n", collection, None, None)]
    built = payloads(spark, rows, f"id string, name string, geom {GEOMETRY.simpleString()}, I string, T string", template)
    reasons = {r["id"]: r["reject"] and (r["reject"]["code"], r["reject"]["message"]) for r in built}
    assert reasons == {"ok": None, "text": ("invalid_type", "Value of I is no integer"), "day": ("invalid_type", "Value of T is no date"),
                       "geo": ("invalid_type", "A geometry collection has no coordinates")}


@pytest.mark.parametrize("rows,partitions,size", [(0, 2, 10), (7, 1, 10), (10, 1, 10), (25_003, 3, 100), (20_000, 1, 7)])
def test_batches_hold_every_payload_once(spark, rows, partitions, size):
    df = spark.range(0, rows, 1, partitions).select(
        F.col("id").alias("source_id"), F.lit("r").alias("code_reference"), F.to_json(F.struct("id")).alias("payload"))
    batches = assemble_batches(df, size).select("*", batch_body(F.col("items")).alias("body")).collect()
    assert len({b["batch_id"] for b in batches}) == len(batches)
    assert all(b["size"] == len(b["items"]) <= size for b in batches) and sum(b["size"] < size for b in batches) <= partitions
    assert sorted(int(i["source_id"]) for b in batches for i in b["items"]) == list(range(rows))
    assert all(len(json.loads(b["body"])) == b["size"] for b in batches)
    assert "Exchange" not in assemble_batches(df, size)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("max_bytes", [1 << 25, -1])
def test_outcomes(spark, max_bytes):
    df = spark.range(0, 50, 1, 1).select(F.col("id").alias("source_id"), F.lit("r").alias("code_reference"), F.lit("{}").alias("payload"))
    batches = assemble_batches(df, 10)
    answers = spark.createDataFrame([(0, 200, "ok"), (1, 422, "bad"), (2, 500, "down"), (3, 301, "moved")], "batch_id bigint, status int, body string")
    routed = batch_rows(route_outcomes(batches, answers, max_bytes)).groupBy("batch_id", "outcome", "answer").count().collect()
    assert {(r[0], r[1], r[2], r[3]) for r in routed} == {
        (0, "written", "ok", 10), (1, "rejected", "bad", 10), (2, "failed", "down", 10), (3, "written", "moved", 10), (4, "failed", None, 10)}
    assert one(spark, outcome(F.lit(499))) == "rejected" and one(spark, outcome(F.lit(400))) == "rejected"
