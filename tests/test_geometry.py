import random
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.functions import wkb
from plumbline.functions.geometry import GEOMETRY, UNREADABLE, geojson, promote, structurally_valid, translate, wkt
from plumbline.functions.wkb import from_wkb, to_wkb
from plumbline.operators.geo import decode_geometry, geometry_bytes
from plumbline.operators.validate import Rules, classify, geometry_verdict


def ring(*points):
    return [[float(x), float(y)] for x, y in points] + [[float(points[0][0]), float(points[0][1])]]


def square(x, y, side=1):
    return ring((x, y), (x + side, y), (x + side, y + side), (x, y + side))


def shape(kind, *parts, dims="XY", members=None, srid=0):
    return {"type": kind, "srid": srid, "dims": dims, "parts": list(parts), "members": members}


def polygon(*rings):
    return shape("Polygon", list(rings))


def multi(*parts):
    return shape("MultiPolygon", *parts)


NAN, INF = float("nan"), float("inf")
BOW_TIE = ring((0, 0), (1, 1), (1, 0), (0, 1))
CASES = {
    "null": (None, True),
    "empty polygon": (shape("Polygon"), True),
    "point": (shape("Point", [[[1.0, 2.0]]]), True),
    "infinite point": (shape("Point", [[[INF, 2.0]]]), False),
    "nan in multipoint": (shape("MultiPoint", [[[1.0, 2.0]]], [[[NAN, 2.0]]]), False),
    "line": (shape("LineString", [[[0.0, 0.0], [1.0, 1.0]]]), True),
    "self-crossing line": (shape("LineString", [BOW_TIE]), True),
    "line of one place": (shape("LineString", [[[0.0, 0.0], [0.0, 0.0]]]), False),
    "multiline with such a line": (shape("MultiLineString", [[[0.0, 0.0], [1.0, 0.0]]], [[[0.0, 0.0], [0.0, 0.0]]]), False),
    "square": (polygon(square(0, 0)), True),
    "open ring": (polygon(square(0, 0)[:-1]), False),
    "too few points": (polygon(ring((0, 0), (1, 1))), False),
    "repeats hide too few points": (polygon([[0.0, 0.0], [1.0, 1.0], [1.0, 1.0], [0.0, 0.0]]), False),
    "repeated point": (polygon([[0.0, 0.0], [1.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]), True),
    "bow-tie": (polygon(BOW_TIE), False),
    "spike": (polygon(ring((0, 0), (2, 0), (2, 2), (3, 3), (2, 2), (0, 2))), False),
    "self-touch": (polygon(ring((0, 0), (4, 0), (4, 4), (2, 0), (0, 4))), False),
    "hole": (polygon(square(0, 0, 10), square(2, 2, 2)), True),
    "hole outside": (polygon(square(0, 0, 10), square(20, 2, 2)), False),
    "hole across the shell": (polygon(square(0, 0, 10), square(9, 2, 2)), False),
    "hole touching once": (polygon(square(0, 0, 10), ring((0, 5), (2, 4), (2, 6))), True),
    "hole touching twice": (polygon(square(0, 0, 10), ring((0, 5), (5, 0), (6, 6))), False),
    "hole along the shell": (polygon(square(0, 0, 10), square(0, 2, 2)), False),
    "hole in hole": (polygon(square(0, 0, 10), square(2, 2, 6), square(3, 3, 1)), False),
    "holes touching once": (polygon(square(0, 0, 10), square(2, 2, 2), ring((4, 4), (6, 5), (5, 6))), True),
    "chain of holes splits": (polygon(square(0, 0, 10), ring((0, 5), (3, 4), (5, 5), (3, 6)), ring((5, 5), (7, 4), (10, 5), (7, 6))), False),
    "hole is the shell": (polygon(square(0, 0, 10), square(0, 0, 10)), False),
    "apart": (multi([square(0, 0)], [square(5, 5)]), True),
    "overlapping": (multi([square(0, 0, 2)], [square(1, 1, 2)]), False),
    "corner touch": (multi([square(0, 0, 2)], [square(2, 2, 2)]), True),
    "edge touch": (multi([square(0, 0, 2)], [square(2, 0, 2)]), False),
    "inside each other": (multi([square(0, 0, 10)], [square(2, 2, 2)]), False),
    "inside a hole": (multi([square(0, 0, 10), square(2, 2, 6)], [square(3, 3, 2)]), True),
    "diamond touching its hole": (multi([square(0, 0, 10), square(2, 2, 6)], [ring((5, 2), (8, 5), (5, 8), (2, 5))]), True),
    "diamond in a shell": (multi([square(0, 0, 10)], [ring((5, 0), (10, 5), (5, 10), (0, 5))]), False),
    "the same twice": (multi([square(0, 0, 10)], [square(0, 0, 10)]), False),
    "large coordinates": (polygon(ring((1e15, 1e15), (1e15 + 1, 1e15), (1e15 + 1, 1e15 + 1))), True),
    "bad collection": (shape("GeometryCollection", [BOW_TIE], members="Polygon:1"), False),
    "open ring in collection": (shape("GeometryCollection", [square(0, 0)[:-1]], members="Polygon:1"), False),
    "overlap across members": (shape("GeometryCollection", [square(0, 0)], [square(0, 0)],
                                     members="Polygon:1,Polygon:1"), True),
}


@pytest.fixture(scope="module")
def shapes(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("geom", GEOMETRY), T.StructField("expected", T.BooleanType())])
    return spark.createDataFrame([(n, g, v) for n, (g, v) in CASES.items()], schema)


def test_validity(shapes):
    rows = geometry_verdict(shapes, "geom", F.lit(False), "bad").collect()
    assert [r["name"] for r in rows if r["bad"] == r["expected"]] == []


def test_skipped_rows_are_not_judged(shapes):
    assert geometry_verdict(shapes, "geom", F.lit(True), "bad").filter("bad").count() == 0


def test_filter_on_the_verdict_runs_the_function_once(shapes):
    plan = geometry_verdict(shapes, "geom", F.lit(False), "bad").filter("NOT bad")._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("ArrowEvalPython") == 1


def test_wkb_round_trip(shapes):
    finite = shapes.filter("name NOT IN ('open ring', 'too few points', 'open ring in collection', 'nan in multipoint')")
    back = finite.select("name", "geom", from_wkb(to_wkb(F.col("geom"))).alias("back")).collect()
    assert [r["name"] for r in back if r["geom"] != r["back"]] == []


def test_bytes_and_hex_decode_alike(spark, shapes):
    stored = geometry_bytes(shapes.filter("expected"), "geom")
    assert stored.schema["geom"].metadata == {"geometry": "wkb"}
    hexed = stored.withColumn("geom", F.hex("geom"))
    assert decode_geometry(stored, "geom").select("geom").collect() == decode_geometry(hexed, "geom").select("geom").collect()
    assert geometry_bytes(hexed, "geom").select("geom").collect() == stored.select("geom").collect()


def test_other_types_and_missing_columns_are_left_alone(spark):
    df = spark.createDataFrame([(1,)], "geom int")
    assert decode_geometry(df, "geom").schema == df.schema and decode_geometry(df, "other").schema == df.schema


def decoded(spark, *values):
    df = spark.createDataFrame([(i, bytearray(v)) for i, v in enumerate(values)], "i int, geom binary")
    return [r["geom"] for r in decode_geometry(df, "geom").orderBy("i").collect()]


def test_ewkb_iso_and_byte_orders(spark):
    point = decoded(
        spark, bytes.fromhex("01010000A0E610000000000000000024400000000000003440000000000000F03F"),
        struct.pack(">BIddd", 0, 1001, 10.0, 20.0, 1.0), struct.pack("<BIddd", 1, 2001, 10.0, 20.0, 5.0),
        struct.pack("<BIdddd", 1, 0xC0000001, 1.0, 2.0, 3.0, 4.0), struct.pack("<BIdd", 1, 1, NAN, NAN),
    )
    assert [(p["srid"], p["dims"], p["parts"]) for p in point] == [
        (4326, "XYZ", [[[[10.0, 20.0, 1.0]]]]), (0, "XYZ", [[[[10.0, 20.0, 1.0]]]]), (0, "XYM", [[[[10.0, 20.0, 5.0]]]]),
        (0, "XYZM", [[[[1.0, 2.0, 3.0, 4.0]]]]), (0, "XY", []),
    ]


def test_open_and_short_rings_are_repaired(spark):
    def polygon_bytes(points):
        return struct.pack("<BIII", 1, 3, 1, len(points)) + b"".join(struct.pack("<dd", *p) for p in points)

    line = struct.pack("<BIIdd", 1, 2, 1, 3.0, 4.0)
    three, five, one = decoded(spark, polygon_bytes([(0, 0), (1, 0), (0, 1)]), polygon_bytes([(0, 0), (1, 0), (1, 1), (0, 1)]), line)
    assert three["parts"] == [[ring((0, 0), (1, 0), (0, 1))]] and five["parts"] == [[square(0, 0)]]
    assert one["parts"] == [[[[3.0, 4.0], [3.0, 4.0]]]]


def random_wkb(rng, kind, depth=0, zm=None):
    """A value of any layout and byte order; members of a multi geometry have its dimensions."""
    order, (z, m), srid, iso = rng.choice("<>"), zm or (rng.random() < 0.4, rng.random() < 0.3), rng.choice([0, 0, 4326]), rng.random() < 0.5
    code = kind + (1000 * (z + 2 * m) if iso else 0) | (0 if iso else 0x80000000 * z | 0x40000000 * m) | (0x20000000 if srid else 0)
    head = struct.pack("B", order == "<") + struct.pack(order + "I", code) + (struct.pack(order + "I", srid) if srid else b"")

    def points(n):
        return b"".join(struct.pack(order + "d", float(rng.randrange(3))) for _ in range(n * (2 + z + m)))

    def listed(counts, item):
        n = rng.choice(counts)
        return struct.pack(order + "I", n) + item(n)

    if kind == 1:
        return head + (struct.pack(order + "d", NAN) * (2 + z + m) if rng.random() < 0.2 else points(1))
    if kind == 2:
        return head + listed([0, 1, 2, 5], points)
    if kind == 3:
        return head + listed([0, 1, 2, 3], lambda n: b"".join(listed([0, 1, 2, 3, 4, 5, 7], points) for _ in range(n)))
    inner = [1, 2, 3, 4, 5, 6] if depth < 2 else [1, 2, 3]
    return head + listed([0, 1, 2, 3], lambda n: b"".join(random_wkb(rng, kind - 3 if kind < 7 else rng.choice(inner), depth + 1, (z, m)) for _ in range(n)))


@pytest.mark.parametrize("rounds", [1, 4, wkb.ROUNDS])
def test_values_read_together_as_one_by_one(monkeypatch, rounds):
    monkeypatch.setattr(wkb, "ROUNDS", rounds)
    rng, values = random.Random(7), []
    for _ in range(4000):
        value = bytearray(random_wkb(rng, rng.randrange(1, 8)))
        luck = rng.random()
        if luck < 0.1:
            value = value[: rng.randrange(len(value))]
        elif luck < 0.15:
            value[rng.randrange(min(5, len(value)))] = rng.randrange(256)
        values.append(None if luck > 0.95 else bytes(value))
    read, problems = wkb._read_alone([v for v in values if v is not None])
    alone = iter(zip(read.to_pylist(), problems, [v for v in values if v is not None]))
    expected = [None if v is None else shape(UNREADABLE, members=raw.hex()) if problem else one for v in values for one, problem, raw in [(None, 0, b"") if v is None else next(alone)]]
    for size in (4000, 30):
        found = [g for k in range(0, 4000, size) for g in wkb.decode_batch(pa.array(values[k : k + size], pa.binary())).to_pylist()]
        assert list(map(repr, found)) == list(map(repr, expected))


def test_a_huge_count_or_many_parts(spark):
    parts = b"".join(struct.pack("<BIdd", 1, 1, float(k), 0.0) for k in range(3000))
    many, bogus = decoded(spark, struct.pack("<BII", 1, 4, 3000) + parts, struct.pack("<BII", 1, 3, 2**32 - 1) + b"\0" * 64)
    assert len(many["parts"]) == 3000 and many["parts"][2999] == [[[2999.0, 0.0]]]
    assert bogus["type"] == UNREADABLE


def test_malformed_values_are_kept_and_rejected(spark):
    short, unknown = struct.pack("<BIId", 1, 2, 5, 1.0), struct.pack("<BI", 1, 77)
    rows = [("a", "n", short.hex()), ("b", "n", unknown.hex()), ("c", "n", "no hex"), ("d", "n", ""), ("e", "n", struct.pack("<BIdd", 1, 1, 1.0, 2.0).hex()), ("f", "n", None)]
    df = spark.createDataFrame(rows, "id string, name string, geom string")
    found = {r["id"]: r for r in classify(df, Rules()).select("id", "geom", "reject.code", wkt("geom").alias("text")).collect()}
    assert {k: r["code"] for k, r in found.items()} == dict.fromkeys("abcd", "invalid_geometry") | {"e": None, "f": None}
    assert found["a"]["geom"]["type"] == UNREADABLE and found["a"]["text"] == short.hex() and found["e"]["text"] == "POINT (1 2)"
    stored = {r["id"]: r["geom"] and bytes(r["geom"]) for r in geometry_bytes(decode_geometry(df, "geom"), "geom").collect()}
    assert stored["a"] == short and stored["b"] == unknown and stored["c"] == b"no hex" and stored["f"] is None
    assert decode_geometry(df, "geom").select(geojson("geom").alias("g")).filter("g IS NOT NULL").count() == 1


def test_malformed_wkb_fails_where_it_must_be_sound(spark):
    df = spark.createDataFrame([(bytearray(struct.pack("<BIId", 1, 2, 5, 1.0)),)], "geom binary")
    with pytest.raises(Exception, match="ends before|Unsupported"):
        df.select(from_wkb(F.col("geom"))).collect()


def test_promotion_only_for_the_matching_single_type(spark, shapes):
    kinds = shapes.select("geom.type", promote(F.col("geom"), "st_multipolygon")["type"].alias("to")).distinct().collect()
    assert {(r["type"], r["to"]) for r in kinds if r["type"] != r["to"]} == {("Polygon", "MultiPolygon")}
    for expected in ("Polygon", None, "GeometryCollection"):
        assert str(shapes.select(promote(F.col("geom"), expected)).collect()).count("Multi") == str(shapes.select("geom").collect()).count("Multi")


def test_translation_keeps_z_and_differences(spark):
    row = shape("LineString", [[[0.0, 0.0, 5.0], [1.0, 2.0, 6.0]]], dims="XYZ", srid=4326)
    df = spark.createDataFrame([(row,), (None,)], "geom " + GEOMETRY.simpleString())
    moved = [r[0] for r in df.select(translate("geom", 1, -1.5)).collect()]
    assert moved[0]["parts"] == [[[[1.0, -1.5, 5.0], [2.0, 0.5, 6.0]]]] and moved[0]["srid"] == 4326 and moved[1] is None


@pytest.mark.parametrize("value,json_text,text", [
    (shape("Point", [[[10.0, 20.0, 3.0]]], dims="XYZ"), "[10.0,20.0]", "POINT Z (10 20 3)"),
    (shape("Point"), "[]", "POINT EMPTY"),
    (shape("LineString", [[[0.0, 0.0], [1.5, 1.0]]]), "[[0.0,0.0],[1.5,1.0]]", "LINESTRING (0 0, 1.5 1)"),
    (polygon(square(0, 0)), "[[[0.0,0.0],[1.0,0.0],[1.0,1.0],[0.0,1.0],[0.0,0.0]]]", "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"),
    (shape("MultiPoint", [[[1.0, 2.0]]], [[[3.0, 4.0]]]), "[[1.0,2.0],[3.0,4.0]]", "MULTIPOINT ((1 2), (3 4))"),
    (shape("MultiLineString", [[[0.0, 0.0], [1.0, 1.0]]]), "[[[0.0,0.0],[1.0,1.0]]]", "MULTILINESTRING ((0 0, 1 1))"),
    (multi([ring((0, 0), (1, 0), (0, 1))]), "[[[[0.0,0.0],[1.0,0.0],[0.0,1.0],[0.0,0.0]]]]", "MULTIPOLYGON (((0 0, 1 0, 0 1, 0 0)))"),
])
def test_geojson_and_text(spark, value, json_text, text):
    df = spark.createDataFrame([(value,)], "geom " + GEOMETRY.simpleString())
    row = df.select(geojson("geom")["type"], F.to_json(geojson("geom")["coordinates"]), wkt("geom")).first()
    assert tuple(row) == (value["type"], json_text, text)


def test_collections_have_no_coordinates(spark):
    value = shape("GeometryCollection", [[[1.0, 2.0]]], members="Point:1")
    df = spark.createDataFrame([(value,), (None,)], "geom " + GEOMETRY.simpleString())
    assert [r[0] for r in df.select(geojson("geom")).collect()] == [None, None]


def test_large_ring(spark):
    import numpy as np
    angle = np.linspace(0, 2 * np.pi, 20001)[:-1]
    points = np.c_[(1 + 0.1 * np.sin(50 * angle)) * np.cos(angle), (1 + 0.1 * np.sin(50 * angle)) * np.sin(angle)].tolist()
    crossed = points[:100] + [points[10000]] + points[100:]
    df = spark.createDataFrame([(polygon(points + points[:1]),), (polygon(crossed + crossed[:1]),)], "geom " + GEOMETRY.simpleString())
    assert [r["bad"] for r in geometry_verdict(df, "geom", F.lit(False), "bad").collect()] == [False, True]
    assert df.select(structurally_valid("geom")).first()[0]
