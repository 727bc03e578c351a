"""G: decoding, types, promotion, translation, validity, GeoJSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.geometry import geojson, make_geometry, plain_type
from plumbline.functions.geometry import translate
from plumbline.functions.wkb import to_wkb
from plumbline.operators.geo import decode_geometry, promote_geometry
from plumbline.operators.validate import Rules, classify, geometry_verdict
from registry.inputs import RING_VERTICES_SQL, dealt, points, rings, table


def vertices(df, key):
    """One row per vertex: key, position, x, y."""
    ring = F.flatten(F.flatten(F.col("geom.parts")))
    spread = df.select(key, F.posexplode(ring).alias("at", "point"))
    return spread.select(
        key, (F.col("at") + 1).alias("i"), F.col("point")[0].alias("x"), F.col("point")[1].alias("y")
    )


def decode(spark, sf_dir):
    stored = points(spark, sf_dir).select("o_orderkey", to_wkb(F.col("geom")).alias("geom"))
    from_bytes = decode_geometry(stored, "geom")
    from_hex = decode_geometry(stored.withColumn("geom", F.hex("geom")), "geom")
    both = from_bytes.withColumn("kind", F.lit("bytes")).unionByName(from_hex.withColumn("kind", F.lit("hex")))
    point = F.get(F.get(F.get("geom.parts", 0), 0), 0)
    return both.select(
        "o_orderkey", "kind", F.col("geom.type").alias("type"), F.coalesce(F.get(point, 0), F.lit(-1.0)).alias("x"),
        F.coalesce(F.get(point, 1), F.lit(-1.0)).alias("y"),
    )


def decoded_shapes(spark, sf_dir):
    """One row per vertex of lines, polygons and multipolygons with Z and SRID, read back from their bytes; one of cut-off bytes."""
    kind = F.col("p_partkey") % 4
    raised = "transform(ring, p -> concat(p, array(CAST(p_partkey AS double))))"
    beside = "transform(ring, p -> array(p[0] + 100D, p[1], CAST(-p_partkey AS double)))"
    first = F.expr(f"transform(geom.parts, part -> transform(part, ring -> {raised}))")
    second = F.expr(f"transform(geom.parts, part -> transform(part, ring -> {beside}))")
    shape = F.struct(
        F.when(kind == 0, "LineString").when(kind == 1, "Polygon").otherwise("MultiPolygon").alias("type"), (4000 + kind).cast("int").alias("srid"),
        F.lit("XYZ").alias("dims"), F.when(kind < 2, first).otherwise(F.concat(first, second)).alias("parts"), F.lit(None).cast("string").alias("members"))
    stored = rings(spark, sf_dir).select("p_partkey", to_wkb(shape).alias("geom"))
    stored = stored.withColumn("geom", F.when(kind == 3, F.expr("substring(geom, 1, octet_length(geom) - 5)")).otherwise(F.col("geom")))
    read = decode_geometry(stored, "geom").select("p_partkey", "geom.type", "geom.srid", F.posexplode_outer("geom.parts").alias("part", "rings"))
    points = read.select("p_partkey", "type", "srid", "part", F.posexplode_outer(F.get("rings", F.lit(0))).alias("i", "p"))
    return points.select("p_partkey", "type", "srid", "part", "i", *[F.get("p", F.lit(k)).alias(c) for k, c in enumerate("xyz")])


def unreadable(spark, sf_dir):
    """The reject reason of rows whose geometry bytes are cut off, of an unknown type, or no hex at all."""
    df = rings(spark, sf_dir).withColumn("geom", F.hex(to_wkb(F.col("geom"))))
    key = F.col("p_partkey") % 13
    broken = F.when(key == 1, F.expr("substring(geom, 1, length(geom) - 8)")).when(key == 2, F.lit("01FF000000")).when(key == 3, F.lit("n/a")).otherwise(F.col("geom"))
    df = df.filter("p_partkey % 7 <> 0").select(F.col("p_partkey").cast("string").alias("id"), F.lit("part").alias("name"), broken.alias("geom"))
    return classify(df, Rules()).select("id", F.col("reject.code").alias("code"), F.col("reject.field").alias("field"))


_TYPE_NAMES = "CASE p_partkey % 4 WHEN 0 THEN 'Point' WHEN 1 THEN 'ST_LineString' WHEN 2 THEN 'multipolygon' ELSE 'st_MultiPoint' END"


def type_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", plain_type(F.expr(_TYPE_NAMES)).alias("type"))


def mixed(spark, sf_dir):
    """Lines for every third part, polygons otherwise."""
    ring = rings(spark, sf_dir)
    line = make_geometry("LineString", F.col("geom.parts"))
    return ring.withColumn("geom", F.when(F.col("p_partkey") % 3 == 0, line).otherwise(F.col("geom")))


def promoted(spark, sf_dir):
    multi = promote_geometry(mixed(spark, sf_dir), "ST_MultiPolygon", "geom")
    return multi.select("p_partkey", F.col("geom.type").alias("type"), F.size("geom.parts").alias("parts"))


def type_probe(spark, sf_dir):
    return mixed(spark, sf_dir).select("p_partkey", F.col("geom.type").alias("type"))


def translated(spark, sf_dir):
    return vertices(rings(spark, sf_dir).withColumn("geom", translate("geom", 2.0, -3.0)), "p_partkey")


def validity(spark, sf_dir):
    judged = geometry_verdict(rings(spark, sf_dir), "geom", F.lit(False), "bad")
    return judged.select("p_partkey", (~F.col("bad")).alias("valid"))


#: A box beside the first one of each part: its lower corner and its sides.
_BOX = {
    "hole": ("p_partkey % 13 - 1", "p_partkey DIV 13 % 13 - 1", "1 + p_partkey % 3", "1 + p_partkey % 2"),
    "second": ("p_partkey % 11 - 5", "p_partkey DIV 11 % 11 - 5", "1 + p_partkey % 5", "1 + p_partkey % 3"),
}


def ring_validity(spark, sf_dir):
    """Squares with a hole, and multipolygons of a square and a box, in all positions to each other."""

    def box(x, y, width, height):
        corners = ((x, y), (f"{x} + {width}", y), (f"{x} + {width}", f"{y} + {height}"), (x, f"{y} + {height}"), (x, y))
        return f"array({', '.join(f'array(CAST(p_partkey + {a} AS double), CAST(p_size + {b} AS double))' for a, b in corners)})"

    holed = F.expr(f"array(array({box('0', '0', '10', '10')}, {box(*_BOX['hole'])}))")
    twofold = F.expr(f"array(array({box('0', '0', '4', '4')}), array({box(*_BOX['second'])}))")
    even = F.col("p_partkey") % 2 == 0
    made = make_geometry(F.when(even, "Polygon").otherwise("MultiPolygon"), F.when(even, holed).otherwise(twofold))
    part = dealt(table(spark, sf_dir, "part").select("p_partkey", "p_size"))
    judged = geometry_verdict(part.select("p_partkey", made.alias("geom")), "geom", F.lit(False), "bad")
    return judged.select("p_partkey", (~F.col("bad")).alias("valid"))


def geojson_text(spark, sf_dir):
    text = F.to_json(geojson("geom"))
    return points(spark, sf_dir).select("o_orderkey", text.alias("geojson"))


def geojson_rings(spark, sf_dir):
    return rings(spark, sf_dir).select("p_partkey", F.to_json(geojson("geom")).alias("geojson"))


QUERIES = {
    "G1_decode_geometry": decode,
    "G1_decode_shapes": decoded_shapes,
    "G1_unreadable": unreadable,
    "G2_geometry_type_name": type_names,
    "G3_promote_to_multi": promoted,
    "G4_geometry_type": type_probe,
    "G5_translate": translated,
    "G6_validity": validity,
    "G6_ring_validity": ring_validity,
    "G7_geojson_points": geojson_text,
    "G7_geojson_polygons": geojson_rings,
}

ORACLES = {
    "G1_decode_geometry": """
SELECT o_orderkey, kind, CASE WHEN o_orderkey % 43 <> 0 THEN 'Point' END AS type,
       CAST(CASE WHEN o_orderkey % 43 <> 0 THEN o_custkey ELSE -1 END AS DOUBLE) AS x,
       CAST(CASE WHEN o_orderkey % 43 <> 0 THEN o_orderkey ELSE -1 END AS DOUBLE) AS y
FROM orders, (SELECT unnest(['bytes', 'hex']) AS kind)""",
    # Polygons that were stored open are closed on reading, lines are left as they are.
    "G1_decode_shapes": f"""
WITH v AS (SELECT p_partkey, i, x, y FROM ({RING_VERTICES_SQL})),
closed AS (
  SELECT * FROM v UNION ALL SELECT p_partkey, 5, x, y FROM v WHERE i = 1 AND p_partkey % 11 = 0 AND p_partkey % 4 <> 0
), told AS (
  SELECT p_partkey, 0 AS part, i, x, y, CAST(p_partkey AS DOUBLE) AS z FROM closed
  UNION ALL SELECT p_partkey, 1, i, x + 100, y, CAST(-p_partkey AS DOUBLE) FROM closed WHERE p_partkey % 4 = 2
)
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'LineString' WHEN 1 THEN 'Polygon' ELSE 'MultiPolygon' END AS type, 4000 + p_partkey % 4 AS srid,
       part, i - 1 AS i, x, y, z FROM told WHERE p_partkey % 4 < 3
UNION ALL SELECT p_partkey, 'Unreadable', 0, NULL, NULL, NULL, NULL, NULL FROM part WHERE p_partkey % 4 = 3""",
    "G1_unreadable": """
SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 13 BETWEEN 1 AND 3 THEN 'invalid_geometry' END AS code,
       CASE WHEN p_partkey % 13 BETWEEN 1 AND 3 THEN 'geom' END AS field FROM part WHERE p_partkey % 7 <> 0""",
    "G2_geometry_type_name": f"SELECT p_partkey, regexp_replace(upper({_TYPE_NAMES}), '^ST_', '') AS type FROM part",
    "G3_promote_to_multi": """
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'LineString' ELSE 'MultiPolygon' END AS type, 1 AS parts FROM part""",
    "G4_geometry_type":
        "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'LineString' ELSE 'Polygon' END AS type FROM part",
    "G5_translate": f"SELECT p_partkey, i, x + 2.0 AS x, y - 3.0 AS y FROM ({RING_VERTICES_SQL})",
    # A four-cornered ring is invalid if it is open or if two opposite edges cross each other.
    "G6_validity": f"""
WITH v AS ({RING_VERTICES_SQL}),
corner AS (SELECT p_partkey, count(*) AS n,
                  max(x) FILTER (WHERE i = 1) AS x1, max(y) FILTER (WHERE i = 1) AS y1,
                  max(x) FILTER (WHERE i = 2) AS x2, max(y) FILTER (WHERE i = 2) AS y2,
                  max(x) FILTER (WHERE i = 3) AS x3, max(y) FILTER (WHERE i = 3) AS y3,
                  max(x) FILTER (WHERE i = 4) AS x4, max(y) FILTER (WHERE i = 4) AS y4 FROM v GROUP BY p_partkey),
turn AS (SELECT *, sign((x2 - x1) * (y3 - y1) - (y2 - y1) * (x3 - x1)) AS t123,
                sign((x2 - x1) * (y4 - y1) - (y2 - y1) * (x4 - x1)) AS t124,
                sign((x4 - x3) * (y1 - y3) - (y4 - y3) * (x1 - x3)) AS t341,
                sign((x4 - x3) * (y2 - y3) - (y4 - y3) * (x2 - x3)) AS t342,
                sign((x3 - x2) * (y4 - y2) - (y3 - y2) * (x4 - x2)) AS t234,
                sign((x3 - x2) * (y1 - y2) - (y3 - y2) * (x1 - x2)) AS t231,
                sign((x1 - x4) * (y2 - y4) - (y1 - y4) * (x2 - x4)) AS t412,
                sign((x1 - x4) * (y3 - y4) - (y1 - y4) * (x3 - x4)) AS t413 FROM corner)
SELECT p_partkey, n = 5 AND NOT (t123 * t124 < 0 AND t341 * t342 < 0) AND NOT (t234 * t231 < 0 AND t412 * t413 < 0) AS valid
FROM turn""",
    # A hole must lie in the open square; two boxes may meet in one corner at most.
    "G6_ring_validity": f"""
WITH box AS (
  SELECT p_partkey, {', '.join(f"{sql.replace('DIV', '//')} AS h{c}" for sql, c in zip(_BOX['hole'], 'xywh'))},
         {', '.join(f"{sql.replace('DIV', '//')} AS s{c}" for sql, c in zip(_BOX['second'], 'xywh'))} FROM part
)
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN hx > 0 AND hy > 0 AND hx + hw < 10 AND hy + hh < 10
       ELSE sx > 4 OR sy > 4 OR sx + sw < 0 OR sy + sh < 0 OR ((sx = 4 OR sx + sw = 0) AND (sy = 4 OR sy + sh = 0)) END AS valid FROM box""",
    "G7_geojson_points": """
SELECT o_orderkey, CASE WHEN o_orderkey % 43 <> 0 THEN
       concat('{"type":"Point","coordinates":[', o_custkey, '.0,', o_orderkey, '.0]}') END AS geojson FROM orders""",
    "G7_geojson_polygons": f"""
SELECT p_partkey, concat('{{"type":"Polygon","coordinates":[[',
       string_agg(concat('[', CAST(x AS BIGINT), '.0,', CAST(y AS BIGINT), '.0]'), ',' ORDER BY i), ']]}}') AS geojson
FROM ({RING_VERTICES_SQL}) GROUP BY p_partkey""",
}
