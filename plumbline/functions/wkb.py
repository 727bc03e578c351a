"""WKB <-> geometry struct, as Arrow batch functions (only the geometry column crosses to Python).

Reads OGC WKB, the ISO Z/M type codes and the EWKB flags (Z, M, SRID), either byte order. Like common readers it repairs
short or open rings: an open ring is closed, a ring of one to three points is padded to four with its first point, and a
one-point line gets its point twice.

A batch is read by one cursor for each value, all of them moved together: a round reads the next header, count or ring of every value that has one,
and the ordinates of all rings are gathered at the end. Values with more steps than ROUNDS, nested multi geometries and collections are read one by
one. A value that cannot be read becomes a geometry of type UNREADABLE that keeps its bytes as hex text and is never valid.
"""

from __future__ import annotations

import struct
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.geometry import GEOMETRY, UNREADABLE

# WKB type codes.
TYPE_NAMES = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon",
              7: "GeometryCollection"}
TYPE_CODES = {name: code for code, name in TYPE_NAMES.items()}
ORDINATES = {"XY": 2, "XYZ": 3, "XYM": 3, "XYZM": 4}
_WIDTHS = np.array([2, 3, 3, 4])
_PLAIN_POINT = np.frombuffer(bytes.fromhex("0101000000"), np.uint8)


#: Steps that all cursors take together; what is longer is read alone.
ROUNDS = 512
# By number: no problem, the value ends early, its byte order or type is none we know.
_PROBLEMS = ("", "WKB value ends before its coordinates do", "Unsupported WKB byte order or geometry type")
_DIMS = np.array(["XY", "XYZ", "XYM", "XYZM"], object)


class _Reader:
    """Cursor over one WKB value; reading a geometry returns (type, srid, dims, parts, members)."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def _count(self, order):
        value = struct.unpack_from(order + "I", self.data, self.at)[0]
        self.at += 4
        return value

    def _points(self, order, count, width):
        size = 8 * count * width
        if self.at + size > len(self.data):
            raise ValueError(_PROBLEMS[1])
        points = np.frombuffer(self.data, order + "f8", count * width, self.at).reshape(count, width)
        self.at += size
        return points

    def _ring(self, order, width):
        ring = self._points(order, self._count(order), width)
        if 0 < len(ring) <= 3:
            return np.concatenate([ring, np.repeat(ring[:1], 4 - len(ring), axis=0)])
        if len(ring) and not np.array_equal(ring[0, :2], ring[-1, :2]):
            return np.concatenate([ring, ring[:1]])
        return ring

    def geometry(self):
        if self.at >= len(self.data):
            raise ValueError(_PROBLEMS[1])
        if self.data[self.at] > 1:
            raise ValueError(_PROBLEMS[2])
        order = "<" if self.data[self.at] == 1 else ">"
        self.at += 1
        code = self._count(order)
        iso = (code & 0xFFFF) // 1000
        dims = "XY" + ("Z" if code & 0x80000000 or iso in (1, 3) else "") + ("M" if code & 0x40000000 or iso in (2, 3) else "")
        srid = self._count(order) if code & 0x20000000 else 0
        kind = TYPE_NAMES.get((code & 0xFFFF) % 1000)
        if kind is None:
            raise ValueError(_PROBLEMS[2])
        width = ORDINATES[dims]
        if kind == "Point":
            point = self._points(order, 1, width)
            return kind, srid, dims, [] if np.isnan(point[0, :2]).any() else [[point]], None
        if kind == "LineString":
            line = self._points(order, self._count(order), width)
            line = np.repeat(line, 2, axis=0) if len(line) == 1 else line
            return kind, srid, dims, [[line]] if len(line) else [], None
        if kind == "Polygon":
            rings = [self._ring(order, width) for _ in range(self._count(order))]
            return kind, srid, dims, [rings] if any(len(r) for r in rings) else [], None
        parts, members = [], []
        for _ in range(self._count(order)):
            member_kind, member_srid, member_dims, member_parts, nested = self.geometry()
            srid, dims = srid or member_srid, member_dims
            parts.extend(member_parts)
            members.extend(nested or [(member_kind, len(member_parts))])
        return kind, srid, dims, parts, members if kind == "GeometryCollection" else None


def _offsets(counts):
    return pa.array(np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]), pa.int32())


def _nested(part_counts, ring_counts, point_counts, widths, values, mask):
    """parts list array from the four levels of counts."""
    points = pa.ListArray.from_arrays(_offsets(widths), pa.array(values, pa.float64()))
    rings = pa.ListArray.from_arrays(_offsets(point_counts), points)
    parts = pa.ListArray.from_arrays(_offsets(ring_counts), rings)
    return pa.ListArray.from_arrays(_offsets(part_counts), parts, mask=mask)


def _assemble(kinds, srids, dims, parts, members, missing):
    fields = [pa.array(kinds, pa.string()), pa.array(srids, pa.int32()), pa.array(dims, pa.string()), parts,
              pa.array(members, pa.string())]
    return pa.StructArray.from_arrays(fields, ["type", "srid", "dims", "parts", "members"], mask=pa.array(missing))


def _plain_points(data: pa.Array):
    """Whole-batch path for the most common content: two-dimensional little-endian points without SRID."""
    values = data.drop_null()
    lengths = np.diff(np.frombuffer(values.buffers()[1], np.int32, len(values) + 1, 4 * values.offset))
    if not len(values) or not (lengths == 21).all():
        return None
    start = np.frombuffer(values.buffers()[1], np.int32, 1, 4 * values.offset)[0]
    raw = np.frombuffer(values.buffers()[2], np.uint8, 21 * len(values), start).reshape(-1, 21)
    if not (raw[:, :5] == _PLAIN_POINT).all():
        return None
    xy = np.ascontiguousarray(raw[:, 5:]).view("<f8")
    if np.isnan(xy).any():
        return None
    missing = np.asarray(data.is_null())
    one = (~missing).astype(np.int64)
    parts = _nested(one, np.ones(len(xy)), np.ones(len(xy)), np.full(len(xy), 2), xy.ravel(), pa.array(missing))
    known = one.astype(bool)
    return _assemble(np.where(known, "Point", None), np.where(known, 0, None), np.where(known, "XY", None), parts,
                     [None] * len(data), missing)


def _read_alone(items: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Values one by one: (geometries, problems); a value with a problem stands as an empty one."""
    kinds, srids, dims, members, problems = [], [], [], [], []
    part_counts, ring_counts, point_counts, widths, values = [], [], [], [], [np.empty(0)]
    for item in items:
        problem = 0
        try:
            kind, srid, layout, parts, member = _Reader(item).geometry()
        except (ValueError, struct.error) as error:
            problem = 2 if str(error) == _PROBLEMS[2] else 1
            kind, srid, layout, parts, member = None, 0, "XY", [], None
        problems.append(problem), kinds.append(kind), srids.append(srid), dims.append(layout)
        members.append(",".join(f"{t}:{n}" for t, n in member) if member is not None else None)
        part_counts.append(len(parts))
        for part in parts:
            ring_counts.append(len(part))
            for ring in part:
                point_counts.append(len(ring))
                widths.append(np.full(len(ring), ring.shape[1]))
                values.append(ring.astype("<f8").ravel())
    all_widths = np.concatenate(widths) if widths else np.empty(0, np.int64)
    parts = _nested(part_counts, ring_counts, point_counts, all_widths, np.concatenate(values), None)
    return _assemble(kinds, srids, dims, parts, members, np.zeros(len(items), bool)), np.array(problems)


class _Cursors:
    """One cursor for each of many WKB values. ``alone`` marks those that are left to be read one by one."""

    def __init__(self, data: pa.Array):
        self.ends = np.frombuffer(data.buffers()[1], np.int32, len(data) + 1, 4 * data.offset).astype(np.int64)
        self.buffer = data.buffers()[2] or pa.py_buffer(b"")
        self.at, self.end = self.ends[:-1].copy(), self.ends[1:]
        self.problem, self.alone = np.zeros(len(data), np.int8), np.zeros(len(data), bool)
        self.big, self.layout, self.srid = np.zeros(len(data), bool), np.zeros(len(data), np.int64), np.zeros(len(data), np.int64)
        self.rings: list[tuple] = []

    def _each(self, kind: str, places: np.ndarray, big: np.ndarray) -> np.ndarray:
        """The number of type ``kind`` that begins at each place, its first byte the highest one where ``big``."""
        width = np.dtype(kind).itemsize
        count = max(self.buffer.size - width + 1, 0)
        low, high = (np.ndarray((count,), order + kind, self.buffer, strides=(1,)) for order in "<>")
        found = low[places]
        found[big] = high[places[big]]
        return found

    def _room(self, rows: np.ndarray, size) -> np.ndarray:
        """Of the rows those whose value has ``size`` more bytes; the others end early."""
        fits = self.at[rows] + size <= self.end[rows]
        self.problem[rows[~fits]] = 1
        return rows[fits]

    def count(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = self._room(rows, 4)
        found = self._each("u4", self.at[rows], self.big[rows]).astype(np.int64)
        self.at[rows] += 4
        return rows, found

    def header(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows with a header of a known type, its type code); takes up dimensions and the first SRID that is not zero."""
        rows = self._room(rows, 5)
        first = np.frombuffer(self.buffer, np.uint8)[self.at[rows]] if len(rows) else np.empty(0, np.uint8)
        self.big[rows] = first == 0
        self.at[rows] += 1
        rows, code = self.count(rows)
        iso, kind = (code & 0xFFFF) // 1000, (code & 0xFFFF) % 1000
        self.layout[rows] = ((code & 0x80000000 > 0) | np.isin(iso, (1, 3))) + 2 * ((code & 0x40000000 > 0) | np.isin(iso, (2, 3)))
        self.problem[rows[(kind < 1) | (kind > 7) | (first > 1)]] = 2
        named = rows[(code & 0x20000000) > 0]
        named, srid = self.count(named)
        self.srid[named] = np.where(self.srid[named] == 0, srid, self.srid[named])
        good = self.problem[rows] == 0
        return rows[good], kind[good]

    def ring(self, rows: np.ndarray, counts: np.ndarray, member: np.ndarray, kind: np.ndarray) -> None:
        """Take ``counts`` points of each row as the next ring of its member."""
        size = 8 * counts * _WIDTHS[self.layout[rows]]
        fits = self.at[rows] + size <= self.end[rows]
        self.problem[rows[~fits]] = 1
        rows, counts, member, kind, size = rows[fits], counts[fits], member[fits], kind[fits], size[fits]
        self.rings.append((rows, member, self.at[rows], counts, _WIDTHS[self.layout[rows]], kind, self.big[rows]))
        self.at[rows] += size

    def read(self) -> np.ndarray:
        """Move all cursors to their ends; returns the type codes."""
        n = len(self.at)
        top = np.zeros(n, np.int64)
        rows, kinds = self.header(np.arange(n))
        top[rows] = kinds
        self.alone |= top == 7
        members, rings = (top > 0).astype(np.int64), np.zeros(n, np.int64)
        many = rows[(kinds > 3) & (kinds < 7)]
        self.at[rows[kinds <= 3]] = self.ends[:-1][rows[kinds <= 3]]  # a single geometry is its own only member
        many, counts = self.count(many)
        members[many] = counts
        member, inner = np.full(n, -1), np.zeros(n, np.int64)
        for step in range(ROUNDS + 1):
            active = np.flatnonzero((self.problem == 0) & ~self.alone & ((members > 0) | (rings > 0)))
            if not len(active):
                break
            if step == ROUNDS:
                self.alone[active] = True
                break
            rows, kinds = self.header(active[rings[active] == 0])
            members[rows] -= 1
            member[rows] += 1
            inner[rows] = kinds
            self.alone[rows[kinds > 3]] = True
            point = kinds == 1
            self.ring(rows[point], np.ones(point.sum(), np.int64), member[rows[point]], kinds[point])
            rows, counts = self.count(rows[(kinds == 2) | (kinds == 3)])
            line = inner[rows] == 2
            self.ring(rows[line], counts[line], member[rows[line]], inner[rows[line]])
            rings[rows[~line]] = counts[~line]
            rows, counts = self.count(active[(rings[active] > 0) & (self.problem[active] == 0)])
            rings[rows] -= 1
            self.ring(rows, counts, member[rows], inner[rows])
        return top

    def parts(self) -> pa.Array:
        """The rings that were passed, put together as parts of their values."""
        none = np.empty(0, np.int64)
        nothing = [(none,) * 6 + (none.astype(bool),)]
        rows, member, start, counts, widths, kind, big = (np.concatenate(x) for x in zip(*(self.rings or nothing)))
        good = (self.problem[rows] == 0) & ~self.alone[rows]
        order = np.flatnonzero(good)[np.argsort(rows[good], kind="stable")]
        rows, member, start, counts, widths, kind, big = (x[order] for x in (rows, member, start, counts, widths, kind, big))
        some = counts > 0
        ends = [np.zeros((len(rows), 2)), np.zeros((len(rows), 2))]
        for which, last in ((0, 0), (1, 1)):
            place = start[some] + last * 8 * widths[some] * (counts[some] - 1)
            for k in (0, 1):
                ends[which][some, k] = self._each("f8", place + 8 * k, big[some])
        empty = ~some | ((kind == 1) & np.isnan(ends[0]).any(axis=1))
        group = np.flatnonzero(np.diff(rows * (member.max(initial=0) + 2) + member, prepend=-1))
        kept = np.repeat(np.logical_or.reduceat(~empty, group), np.diff([*group, len(rows)])) if len(rows) else none.astype(bool)
        open_ring = (kind == 3) & some & (counts > 3) & (ends[0] != ends[1]).any(axis=1)
        longer = np.where((kind == 3) & some & (counts <= 3), 4 - counts, open_ring + ((kind == 2) & (counts == 1)))
        rows, member, start, counts, widths, longer, big = (x[kept] for x in (rows, member, start, counts, widths, longer, big))

        total = counts + longer
        ring = np.repeat(np.arange(len(rows)), total)
        point = np.arange(len(ring)) - np.repeat(np.cumsum(total) - total, total)
        place = start[ring] + 8 * widths[ring] * np.where(point < counts[ring], point, 0)
        each = widths[ring]
        ordinate = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        values = self._each("f8", np.repeat(place, each) + 8 * ordinate, np.repeat(big[ring], each))
        group = np.flatnonzero(np.diff(rows * (member.max(initial=0) + 2) + member, prepend=-1))
        return _nested(np.bincount(rows[group], minlength=len(self.at)), np.diff([*group, len(rows)]), total, each, values, None)


def decode_batch(data: pa.Array, strict: bool = False) -> pa.Array:
    data = data.cast(pa.binary())
    quick = _plain_points(data)
    if quick is not None:
        return quick
    values = data.drop_null()
    cursors = _Cursors(values)
    top = cursors.read()
    problem, alone = cursors.problem, np.flatnonzero(cursors.alone & (cursors.problem == 0))
    place = np.arange(len(values))
    rest = None
    if len(alone):
        rest, problem[alone] = _read_alone(values.take(pa.array(alone)).to_pylist())
        place[alone] = len(values) + np.arange(len(alone))
    broken = problem > 0
    if strict and broken.any():
        raise ValueError(_PROBLEMS[int(problem[broken][0])])
    place[broken] = np.flatnonzero(broken)
    cursors.problem = problem
    known = ~broken
    kinds = np.where(known, np.array([None, *TYPE_NAMES.values()], object)[np.where(known, top, 0)], UNREADABLE)
    texts = np.full(len(values), None, object)
    for k in np.flatnonzero(broken):  # only what is broken
        texts[k] = values[int(k)].as_py().hex()
    read = _assemble(kinds, np.where(known, cursors.srid, 0), np.where(known, _DIMS[cursors.layout], "XY"), cursors.parts(), texts, np.zeros(len(values), bool))
    if rest is not None:
        read = pa.concat_arrays([read, rest])
    elif not data.null_count:
        return read
    where = np.zeros(len(data), np.int64)
    missing = np.asarray(data.is_null())
    where[~missing] = place
    return read.take(pa.array(where, mask=missing))


def _header(kind, dims, srid):
    flags = (0x80000000 if "Z" in dims else 0) | (0x40000000 if "M" in dims else 0) | (0x20000000 if srid else 0)
    head = struct.pack("<BI", 1, TYPE_CODES[kind] | flags)
    return head + struct.pack("<I", srid) if srid else head


def _line_bytes(ring):
    count, data = ring
    return struct.pack("<I", count) + data


def _encode(kind, dims, srid, parts, members):
    """WKB from parts of rings, a ring being (number of points, little-endian ordinate bytes)."""
    if kind == UNREADABLE:
        return bytes.fromhex(members)
    head = _header(kind, dims, srid)
    if kind == "Point":
        return head + (parts[0][0][1] if parts else np.full(ORDINATES[dims], np.nan).tobytes())
    if kind == "LineString":
        return head + (_line_bytes(parts[0][0]) if parts else struct.pack("<I", 0))
    if kind == "Polygon":
        rings = parts[0] if parts else []
        return head + struct.pack("<I", len(rings)) + b"".join(_line_bytes(r) for r in rings)
    listed = [(kind.removeprefix("Multi"), 1)] * len(parts)
    if kind == "GeometryCollection":
        listed = [(name, int(count)) for name, _, count in (m.partition(":") for m in (members or "").split(",") if m)]
    body, at = [], 0
    for name, count in listed:
        body.append(_encode(name, dims, 0, parts[at:at + count], None))
        at += count
    return head + struct.pack("<I", len(listed)) + b"".join(body)


def _lengths(lists: pa.Array):
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def encode_batch(kinds: pa.Array, srids: pa.Array, dims: pa.Array, parts: pa.Array, members: pa.Array) -> pa.Array:
    rings = parts.flatten()
    lines = rings.flatten()
    points = lines.flatten()
    ordinates = points.flatten().to_numpy(zero_copy_only=False).astype("<f8")
    missing = np.asarray(kinds.is_null())
    present = len(kinds) - missing.sum()
    plain = pc.all(pc.and_(pc.and_(pc.equal(kinds, "Point"), pc.equal(dims, "XY")), pc.equal(srids, 0)), min_count=0).as_py()
    if present and plain and len(ordinates) == 2 * present:
        raw = np.empty((present, 21), np.uint8)
        raw[:, :5] = _PLAIN_POINT
        raw[:, 5:] = ordinates.reshape(-1, 2).view(np.uint8)
        ends = np.concatenate([[0], np.cumsum(~missing)]).astype(np.int32) * 21
        buffers = [pa.array(~missing).buffers()[1], pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.tobytes())]
        return pa.Array.from_buffers(pa.binary(), len(kinds), buffers)

    counts = _lengths(lines)
    ends = np.cumsum(_lengths(points))
    last = np.cumsum(counts)
    stops = np.where(last > 0, ends[np.maximum(last - 1, 0)] if len(ends) else 0, 0)
    starts = np.concatenate([[0], stops[:-1]])
    flat = [(int(n), ordinates[i:j].tobytes()) for n, i, j in zip(counts, starts, stops)]
    ring_ends, part_ends = np.cumsum(_lengths(rings)), np.cumsum(_lengths(parts))
    groups = [flat[i:j] for i, j in zip(np.concatenate([[0], ring_ends[:-1]]), ring_ends)]
    rows = zip(kinds.to_pylist(), dims.to_pylist(), srids.to_pylist(), np.concatenate([[0], part_ends[:-1]]), part_ends,
               members.to_pylist(), missing)
    return pa.array([
        None if gone else _encode(kind, layout, srid or 0, groups[i:j], listed)
        for kind, layout, srid, i, j, listed, gone in rows
    ], pa.binary())


def _strict(data: pa.Array) -> pa.Array:
    return decode_batch(data, strict=True)


def _lenient(data: pa.Array) -> pa.Array:
    return decode_batch(data)


def from_wkb(value: Column, lenient: bool = False) -> Column:
    """Geometry struct of a WKB binary column; a malformed value fails the task, or is UNREADABLE if ``lenient``."""
    return F.arrow_udf(_lenient if lenient else _strict, GEOMETRY)(value)


def to_wkb(geometry: Column) -> Column:
    """Little-endian EWKB of a geometry struct."""
    return F.arrow_udf(encode_batch, "binary")(*[geometry[name] for name in GEOMETRY.names])


# Executors need no installed copy of the package: the batch functions travel inside the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
