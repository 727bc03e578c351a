"""How the rings of polygons lie to each other (OGC rules), as an Arrow batch function.

A batch is checked in whole: candidate segment pairs come from grids over each geometry, and all pairs are classified
with array operations. Only geometries whose rings touch, or that have several rings, are looked
at one by one afterwards.
"""

from __future__ import annotations

import sys
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

_PAIRS_AT_ONCE = 2_000_000
_ROUNDING = 3.3306690738754716e-16  # relative error bound of the float orientation test


def orientation(ax, ay, bx, by, cx, cy):
    """Sign of the turn a -> b -> c; exact, because doubtful float results are recomputed with fractions."""
    left, right = (bx - ax) * (cy - ay), (by - ay) * (cx - ax)
    det = np.atleast_1d(left - right)
    sign = np.sign(det)
    bound = _ROUNDING * np.atleast_1d(np.abs(left) + np.abs(right))
    columns = np.broadcast_arrays(*np.atleast_1d(ax, ay, bx, by, cx, cy))
    at_end = ((cx == ax) & (cy == ay)) | ((cx == bx) & (cy == by))
    for i in np.flatnonzero((np.abs(det) <= bound) & (bound > 0) & ~at_end):
        x1, y1, x2, y2, x3, y3 = (Fraction(float(c[i])) for c in columns)
        exact = (x2 - x1) * (y3 - y1) - (y2 - y1) * (x3 - x1)
        sign[i] = (exact > 0) - (exact < 0)
    return sign


def _spread(keys):
    """Hash of rows of whole numbers; equal rows have equal hashes."""
    mixed = np.zeros(len(keys), np.uint64)
    for column, factor in zip(keys.T, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)):
        mixed = (mixed ^ column.astype(np.int64).view(np.uint64)) * np.uint64(factor)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def _box_pairs(owner, low, high):
    """Index pairs of boxes with the same owner that meet, each pair once, in bounded blocks.

    A box belongs to the grid whose cells are the next power of two to its longer side, and covers four cells of it at most. In each grid its own
    boxes are met by all boxes that are as small or smaller; of the cells that two of them share only the one that holds the lower corner of
    their overlap counts. Work grows with the boxes and with the pairs that lie close together, however they are spread.
    """
    side = (high - low).max(axis=1)
    level = np.ceil(np.log2(np.maximum(side, np.finfo(float).tiny))).astype(np.int64)
    largest, origin = np.full(owner.max() + 1, level.min()), np.full((owner.max() + 1, 2), np.inf)
    np.maximum.at(largest, owner, level)
    np.minimum.at(origin, owner, low)
    level = np.maximum(level, largest[owner] - 24)
    for grid in np.unique(level):
        cell, has = np.ldexp(1.0, int(grid)), np.zeros(len(largest), bool)
        has[owner[level == grid]] = True
        asked = np.flatnonzero((level <= grid) & has[owner])
        first, last = (np.floor((corner[asked] - origin[owner[asked]]) / cell) for corner in (low, high))
        covered = [(asked, first)]
        for step in ((0, 1), (1, 0), (1, 1)):
            more = (first + step <= last).all(axis=1)
            covered.append((asked[more], first[more] + step))
        box, place = (np.concatenate(x) for x in zip(*covered))
        marks = _spread(np.column_stack([owner[box], place]))
        own = level[box] == grid
        order = np.argsort(marks[own], kind="stable")
        listed, known = box[own][order], marks[own][order]
        begin = np.searchsorted(known, marks)
        counts = np.searchsorted(known, marks, "right") - begin
        ends = np.cumsum(counts)
        at = 0
        while at < len(box):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PAIRS_AT_ONCE, "right")))
            each = counts[at:stop]
            asking = np.repeat(np.arange(at, stop), each)
            i, j = listed[np.arange(len(asking)) + np.repeat(begin[at:stop] - np.cumsum(each) + each, each)], box[asking]
            corner = np.maximum(low[i], low[j])
            meet = (owner[i] == owner[j]) & ((level[j] < grid) | (i < j)) & (corner <= np.minimum(high[i], high[j])).all(axis=1)
            i, j, corner, asking = i[meet], j[meet], corner[meet], asking[meet]
            here = (np.floor((corner - origin[owner[i]]) / cell) == place[asking]).all(axis=1)
            yield i[here], j[here]
            at = stop


def _within_arc(p, a, b, q):
    """Whether direction p->q lies inside the counter-clockwise arc from p->a to p->b."""
    def turn(u, v):
        return orientation(p[0], p[1], u[0], u[1], v[0], v[1])[0]

    bend = turn(a, b)
    if bend > 0:
        return turn(a, q) > 0 and turn(q, b) > 0
    if bend < 0:
        return not (turn(b, q) >= 0 and turn(q, a) >= 0)
    return turn(a, q) > 0


def _corner(ring, p):
    """Neighbours of point p on a ring: the vertices around it, or the ends of the segment it lies on."""
    hit = np.flatnonzero((ring[:-1] == p).all(axis=1))
    if len(hit):
        return ring[hit[0] - 1 if hit[0] else -2], ring[hit[0] + 1]
    a, b = ring[:-1], ring[1:]
    on = orientation(a[:, 0], a[:, 1], b[:, 0], b[:, 1], p[0], p[1]) == 0
    on &= (np.minimum(a, b) <= p).all(axis=1) & (np.maximum(a, b) >= p).all(axis=1)
    i = np.flatnonzero(on)[0]
    return a[i], b[i]


def _side(p, ring):
    """1 inside the ring, -1 outside, 0 on it."""
    a, b = ring[:-1], ring[1:]
    near = (np.minimum(a[:, 1], b[:, 1]) <= p[1]) & (np.maximum(a[:, 1], b[:, 1]) >= p[1])
    near &= np.maximum(a[:, 0], b[:, 0]) >= p[0]
    a, b = a[near], b[near]
    turn = orientation(a[:, 0], a[:, 1], b[:, 0], b[:, 1], p[0], p[1])
    if ((turn == 0) & (np.minimum(a[:, 0], b[:, 0]) <= p[0])).any():
        return 0
    up = (a[:, 1] <= p[1]) & (b[:, 1] > p[1]) & (turn > 0)
    down = (b[:, 1] <= p[1]) & (a[:, 1] > p[1]) & (turn < 0)
    return 1 if (up.sum() + down.sum()) % 2 else -1


def _ring_side(inner, outer):
    """Side of a whole ring that does not cross the other one, from its first vertex or edge middle off it."""
    if (inner.max(axis=0) < outer.min(axis=0)).any() or (inner.min(axis=0) > outer.max(axis=0)).any():
        return -1
    for p in np.concatenate([inner[:-1], (inner[:-1] + inner[1:]) / 2]):
        side = _side(p, outer)
        if side:
            return side
    return 1


def _rings_agree(rings, part_of, touches):
    """Checks between rings that neither overlap nor cross: holes, nesting and a connected interior."""
    group = {}

    def root(x):
        while group.setdefault(x, x) != x:
            x = group[x]
        return x

    edges = set()
    for a, b, point in touches:
        ax, bx = _corner(rings[a], point), _corner(rings[b], point)
        if _within_arc(point, *ax, bx[0]) != _within_arc(point, *ax, bx[1]):
            return False
        if part_of[a] == part_of[b]:
            node = ("point", int(part_of[a]), float(point[0]), float(point[1]))
            edges |= {(("ring", a), node), (("ring", b), node)}
    for ring, node in edges:  # a loop of rings and touch points cuts the interior apart
        x, y = root(ring), root(node)
        if x == y:
            return False
        group[x] = y
    numbers = np.array(list(rings))
    boxes = np.array([[r.min(axis=0), r.max(axis=0)] for r in rings.values()])
    shell, first = {}, {}
    for number in rings:
        shell[number] = first.setdefault(int(part_of[number]), number)
    if any(_ring_side(rings[n], rings[shell[n]]) < 0 for n in rings if shell[n] != n):
        return False
    inside = []  # of rings whose boxes meet, those where the first one lies in the second
    for i, j in _box_pairs(np.zeros(len(numbers), np.int64), boxes[:, 0], boxes[:, 1]):
        for a, b in zip(numbers[i].tolist(), numbers[j].tolist()):
            holes = shell[a] != a, shell[b] != b
            if holes == (True, True):
                if shell[a] == shell[b] and (_ring_side(rings[a], rings[b]) > 0 or _ring_side(rings[b], rings[a]) > 0):
                    return False
            elif shell[a] != shell[b]:
                inside += [(x, y) for x, y, hole in ((a, b, holes[0]), (b, a, holes[1])) if not hole and _ring_side(rings[x], rings[y]) > 0]
    sheltered = {(x, shell[y]) for x, y in inside if shell[y] != y}  # a shell in a hole of another part
    return all(shell[y] != y or (x, y) in sheltered for x, y in inside)


class _Batch:
    """Rings of a whole Arrow batch as flat arrays, without the consecutive repeats."""

    def __init__(self, parts: pa.Array):
        rings = parts.flatten()
        lines = rings.flatten()
        points = lines.flatten()
        widths = _lengths(points)
        starts = np.cumsum(widths) - widths
        ordinates = points.flatten().to_numpy(zero_copy_only=False)
        self.part_row = np.repeat(np.arange(len(parts)), _lengths(parts))
        self.ring_part = np.repeat(np.arange(len(self.part_row)), _lengths(rings))
        ring = np.repeat(np.arange(len(self.ring_part)), _lengths(lines))
        xy = np.stack([ordinates[starts], ordinates[starts + 1]], axis=1) if len(starts) else np.empty((0, 2))
        fresh = np.ones(len(ring), bool)
        fresh[1:] = (ring[1:] != ring[:-1]) | (xy[1:] != xy[:-1]).any(axis=1)
        self.xy = xy[fresh]
        self.counts = np.bincount(ring[fresh], minlength=len(self.ring_part))
        self.starts = np.cumsum(self.counts) - self.counts

    def ring(self, number):
        return self.xy[self.starts[number]:self.starts[number] + self.counts[number]]


def _lengths(lists: pa.Array):
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _groups(kinds, members, batch, valid):
    """Group number per part: parts that are checked together, -1 for points and lines; and the row of each group.

    A polygon or multipolygon is one group. The members of a collection are judged one by one, here with the simple
    rules as well, because those are checked in the JVM for the plain types only.
    """
    kinds = np.array(kinds.to_pylist(), object)
    group_row = list(range(len(kinds)))
    polygonal = np.isin(kinds.astype(str), ["Polygon", "MultiPolygon"])
    group = np.where(polygonal[batch.part_row], batch.part_row, -1)
    for row in np.flatnonzero(kinds == "GeometryCollection"):
        at = int(np.searchsorted(batch.part_row, row))
        for member in filter(None, (members[row].as_py() or "").split(",")):
            name, _, count = member.partition(":")
            parts = range(at, at + int(count))
            at = parts.stop
            rings = np.flatnonzero(np.isin(batch.ring_part, parts))
            if name.endswith("Polygon"):
                group[list(parts)] = len(group_row)
                group_row.append(int(row))
                for ring in (batch.ring(r) for r in rings):
                    if len(ring) and (len(ring) < 4 or (ring[0] != ring[-1]).any()):
                        valid[row] = False
            elif name.endswith("LineString") and (batch.counts[rings] == 1).any():
                valid[row] = False
    return group, np.array(group_row)


def topology_batch(kinds: pa.Array, parts: pa.Array, members: pa.Array) -> pa.Array:
    valid = np.ones(len(kinds), bool)
    missing = np.asarray(kinds.is_null())
    batch = _Batch(parts)
    part_group, group_row = _groups(kinds, members, batch, valid)
    ring_group = part_group[batch.ring_part]
    counts = np.where((ring_group >= 0) & (batch.counts > 1), batch.counts - 1, 0)
    if not counts.sum():
        return pa.array(valid, mask=missing)
    ring_id = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(ring_id)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = batch.starts[ring_id] + place
    s = np.hstack([batch.xy[at], batch.xy[at + 1]])
    owner, size = ring_group[ring_id], counts[ring_id]
    broken = np.zeros(len(group_row), bool)
    touches = {}
    low, high = np.minimum(s[:, :2], s[:, 2:]), np.maximum(s[:, :2], s[:, 2:])
    for i, j in _box_pairs(owner, low, high):
        (ax, ay, bx, by), (cx, cy, dx, dy) = s[i].T, s[j].T
        o1, o2 = orientation(ax, ay, bx, by, cx, cy), orientation(ax, ay, bx, by, dx, dy)
        o3, o4 = orientation(cx, cy, dx, dy, ax, ay), orientation(cx, cy, dx, dy, bx, by)
        meet = (o1 * o2 <= 0) & (o3 * o4 <= 0)
        shared = np.minimum(high[i], high[j]) - np.maximum(low[i], low[j])
        overlap = meet & (o1 == 0) & (o2 == 0) & (shared > 0).any(axis=1)
        proper = meet & (o1 * o2 < 0) & (o3 * o4 < 0)
        same = ring_id[i] == ring_id[j]
        gap = np.abs(place[i] - place[j])
        adjacent = same & ((gap == 1) | (gap == size[i] - 1))
        broken[owner[i[overlap | proper | (meet & same & ~adjacent)]]] = True
        for k in np.flatnonzero(meet & ~same & ~overlap & ~proper & ~broken[owner[i]]):
            ends = [(o1[k], s[j[k], :2]), (o2[k], s[j[k], 2:]), (o3[k], s[i[k], :2]), (o4[k], s[i[k], 2:])]
            box_low, box_high = np.maximum(low[i[k]], low[j[k]]), np.minimum(high[i[k]], high[j[k]])
            point = next(p for o, p in ends if o == 0 and (box_low <= p).all() and (p <= box_high).all())
            touches.setdefault(int(owner[i[k]]), []).append((int(ring_id[i[k]]), int(ring_id[j[k]]), point))
    filled = np.flatnonzero(counts > 0)
    by_group = filled[np.argsort(ring_group[filled], kind="stable")]
    heads = np.flatnonzero(np.diff(ring_group[by_group], prepend=-1))
    for members in np.split(by_group, heads[1:]):
        group = ring_group[members[0]]
        if not broken[group] and len(members) > 1:
            rings = {int(r): batch.ring(r) for r in members}
            broken[group] = not _rings_agree(rings, batch.ring_part, touches.get(int(group), []))
    valid[group_row[broken]] = False
    return pa.array(valid, mask=missing)


def topologically_valid(geometry: Column) -> Column:
    """Ring topology of polygonal geometries that passed the structural rules; pass NULL to skip a row.

    Declared non-deterministic so that a later filter on the verdict is not pushed below the projection, where
    Catalyst would run the function a second time.
    """
    return F.arrow_udf(topology_batch, "boolean").asNondeterministic()(
        geometry["type"], geometry["parts"], geometry["members"]
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
