"""Geometry values as plain Spark structs.

At rest a geometry is a WKB ``binary`` column. In flight it is a struct whose ``parts`` nest as
part -> ring -> point -> ordinates, the same for every type: a point is one part with one ring with one point, a line
one part with one ring. Promotion, translation, GeoJSON and the structural validity rules are therefore ordinary
higher-order functions that stay in the JVM. A geometry collection lists its members as text, type:parts
with commas between (a nested list of structs is slow to exchange with Python even when it is NULL).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.text import double_text

GEOMETRY = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("srid", T.IntegerType()),
    T.StructField("dims", T.StringType()),
    T.StructField("parts", T.ArrayType(T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))),
    T.StructField("members", T.StringType()),
])

# Single types and their multi counterparts.
MULTI_OF = {"Point": "MultiPoint", "LineString": "MultiLineString", "Polygon": "MultiPolygon"}
COLLECTION = "GeometryCollection"

#: Type of a value that could not be read; its bytes are kept as hex text in ``members``.
UNREADABLE = "Unreadable"

_LARGEST = "1.7976931348623157e308D"


def is_geometry(data_type: T.DataType) -> bool:
    """Whether a column type is the in-flight geometry struct."""
    return isinstance(data_type, T.StructType) and data_type.names == GEOMETRY.names


def make_geometry(type_name: Column | str, parts: Column, srid: int = 0) -> Column:
    """Two-dimensional geometry struct from its type name and nested parts; NULL parts give a NULL geometry."""
    kind = F.lit(type_name) if isinstance(type_name, str) else type_name
    value = F.struct(
        kind.alias("type"), F.lit(srid).alias("srid"), F.lit("XY").alias("dims"), parts.alias("parts"),
        F.lit(None).cast("string").alias("members"),
    )
    return F.when(parts.isNotNull(), value).cast(GEOMETRY)


def plain_type(type_name: Column) -> Column:
    """Upper-case geometry type name without the optional ST_ prefix."""
    return F.regexp_replace(F.upper(type_name), "^ST_", "")


def promote(geometry: Column, expected_type: str | None) -> Column:
    """Single -> multi where the expected type is the multi form of the row's type; everything else is unchanged."""
    wanted = (expected_type or "").upper().removeprefix("ST_")
    for single, multi in MULTI_OF.items():
        if multi.upper() == wanted:
            return F.when(geometry["type"] == single, geometry.withField("type", F.lit(multi))).otherwise(geometry)
    return geometry


def _each_point(geometry: str, change: str) -> str:
    return f"transform({geometry}.parts, part -> transform(part, ring -> transform(ring, point -> {change})))"


def translate(geometry: str, dx: float, dy: float) -> Column:
    """Move every vertex by (dx, dy); Z and M are kept."""
    step = f"CASE i WHEN 0 THEN {float(dx)!r}D WHEN 1 THEN {float(dy)!r}D ELSE 0D END"
    moved = _each_point(geometry, f"transform(point, (v, i) -> v + {step})")
    return F.expr(geometry).withField("parts", F.expr(moved))


def coordinates(geometry: str) -> str:
    """SQL of the two-dimensional GeoJSON coordinates as a variant, nested as deep as the type asks for."""
    flat = _each_point(geometry, "slice(point, 1, 2)")
    levels = {
        "Point": "get(get(get(xy, 0), 0), 0)",
        "LineString": "get(get(xy, 0), 0)",
        "Polygon": "get(xy, 0)",
        "MultiPoint": "transform(xy, part -> get(get(part, 0), 0))",
        "MultiLineString": "transform(xy, part -> get(part, 0))",
        "MultiPolygon": "xy",
    }
    cases = " ".join(f"WHEN '{kind}' THEN CAST({level} AS variant)" for kind, level in levels.items())
    return f"get(transform(array({flat}), xy -> coalesce(CASE {geometry}.type {cases} END, parse_json('[]'))), 0)"


def geojson(geometry: str) -> Column:
    """struct<type, coordinates> of a geometry, NULL for NULL, unreadable values and collections (which have no coordinates)."""
    value = f"named_struct('type', {geometry}.type, 'coordinates', {coordinates(geometry)})"
    return F.expr(f"CASE WHEN {geometry} IS NOT NULL AND {geometry}.type NOT IN ('{COLLECTION}', '{UNREADABLE}') THEN {value} END")


def wkt(geometry: str) -> Column:
    """Well-known text; the members of a collection are not spelled out, and an unreadable value is the hex text of its bytes."""
    def listed(items, name, text):
        return f"concat('(', array_join(transform({items}, {name} -> {text}), ', '), ')')"

    number = f"regexp_replace({double_text('o')}, '[.]0$', '')"
    point = f"array_join(transform(point, o -> {number}), ' ')"
    ring = listed("ring", "point", point)
    rings = f"transform({geometry}.parts, part -> transform(part, ring -> {ring}))"
    body = f"""get(transform(array({rings}), t -> CASE
        WHEN {geometry}.type IN ('Point', 'LineString') THEN get(get(t, 0), 0)
        WHEN {geometry}.type = 'Polygon' THEN concat('(', array_join(get(t, 0), ', '), ')')
        WHEN {geometry}.type = 'MultiPolygon' THEN {listed('t', 'part', "concat('(', array_join(part, ', '), ')')")}
        ELSE {listed('t', 'part', 'get(part, 0)')} END), 0)"""
    name = f"concat(upper({geometry}.type), CASE {geometry}.dims WHEN 'XY' THEN '' ELSE concat(' ', substr({geometry}.dims, 3)) END)"
    text = f"concat({name}, CASE WHEN size({geometry}.parts) = 0 THEN ' EMPTY' ELSE concat(' ', {body}) END)"
    return F.expr(f"CASE WHEN {geometry}.type = '{UNREADABLE}' THEN {geometry}.members ELSE {text} END")


def is_polygonal(geometry: str) -> str:
    """SQL test for the types whose validity also depends on how their rings lie to each other."""
    return f"{geometry}.type IN ('Polygon', 'MultiPolygon', '{COLLECTION}')"


def structurally_valid(geometry: str) -> Column:
    """Validity rules that need no topology: finite X and Y, lines with two distinct points, closed rings with at
    least four points once consecutive repeats are dropped. Empty geometries pass; NULL stays NULL.

    Collections mix rules per member and are judged with the topology rules.
    """
    def every_ring(rule):
        return f"forall({geometry}.parts, part -> forall(part, ring -> {rule}))"

    finite = every_ring(f"forall(ring, p -> p[0] BETWEEN -{_LARGEST} AND {_LARGEST} AND p[1] BETWEEN -{_LARGEST} AND {_LARGEST})")
    line = "(size(ring) = 0 OR exists(ring, p -> p[0] <> ring[0][0] OR p[1] <> ring[0][1]))"
    fresh = "filter(ring, (p, i) -> i = 0 OR p[0] <> get(ring, i - 1)[0] OR p[1] <> get(ring, i - 1)[1])"
    closed = "get(ring, 0)[0] = element_at(ring, -1)[0] AND get(ring, 0)[1] = element_at(ring, -1)[1]"
    ring = f"(size(ring) = 0 OR ({closed} AND size({fresh}) >= 4))"
    return F.expr(f"""{geometry}.type <> '{UNREADABLE}' AND {finite} AND CASE
        WHEN {geometry}.type IN ('LineString', 'MultiLineString') THEN {every_ring(line)}
        WHEN {geometry}.type IN ('Polygon', 'MultiPolygon') THEN {every_ring(ring)} ELSE true END""")
