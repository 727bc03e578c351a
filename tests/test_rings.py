"""Ring validity against an exact brute-force check, on small grids where degenerate cases are common."""

import random
import time
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from plumbline.functions import topology
from plumbline.functions.topology import topology_batch


def turn(a, b, c):
    value = (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    return (value > 0) - (value < 0)


def on(p, a, b):
    return turn(a, b, p) == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])


def meet(a, b, c, d):
    if any((on(c, a, b), on(d, a, b), on(a, c, d), on(b, c, d))):
        return True
    return turn(a, b, c) != turn(a, b, d) and turn(c, d, a) != turn(c, d, b)


def simple(ring):
    """No two edges share anything but the vertex between neighbours."""
    n = len(ring) - 1
    for i in range(n):
        for j in range(i + 1, n):
            a, b, c, d = ring[i], ring[i + 1], ring[j], ring[j + 1]
            if j == i + 1 or (i == 0 and j == n - 1):
                p, q, r = (a, b, d) if j == i + 1 else (b, a, c)
                if n > 1 and (on(r, p, q) or on(p, q, r)):
                    return False
            elif meet(a, b, c, d):
                return False
    return True


def verdicts(parts):
    kinds = pa.array(["MultiPolygon"] * len(parts))
    nested = pa.array(parts, pa.list_(pa.list_(pa.list_(pa.list_(pa.float64())))))
    return topology_batch(kinds, nested, pa.nulls(len(parts), pa.string())).to_pylist()


def random_ring(rng, grid, size, shift=0):
    while True:
        points = [(rng.randrange(grid) + shift, rng.randrange(grid) + shift) for _ in range(size)]
        ring = [p for i, p in enumerate(points) if p != points[i - 1]]
        if len(ring) >= 3:
            return ring + ring[:1]


def as_lists(ring, scale=1.0):
    return [[x * scale, y * scale] for x, y in ring]


def test_single_rings():
    rng = random.Random(5)
    rings = [random_ring(rng, grid, rng.randrange(3, 8)) for grid in (3, 4, 6) for _ in range(3000)]
    expected = [simple(r) for r in rings]
    assert 500 < sum(expected) < len(rings) - 500
    for scale in (1.0, 0.1, 1e9 + 7):
        got = verdicts([[[as_lists(r, scale)]] for r in rings])
        if scale == 1.0:
            assert got == expected
        else:  # scaled coordinates are rounded, so collinear points may really be off the line
            exact = [simple([(Fraction(x * scale), Fraction(y * scale)) for x, y in r]) for r in rings]
            assert got == exact


def inside(p, ring):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 > p[1]) != (y2 > p[1]) and p[0] < x1 + Fraction(p[1] - y1) * (x2 - x1) / (y2 - y1):
            odd = not odd
    return odd


def overlap(r, s):
    """Two simple rings overlap if an edge of one shares a stretch with the other or some cut point's surroundings do."""
    for a, b in zip(r, r[1:]):
        for c, d in zip(s, s[1:]):
            if turn(a, b, c) == turn(a, b, d) == 0:
                axis = 0 if a[0] != b[0] else 1
                low, high = max(min(a[axis], b[axis]), min(c[axis], d[axis])), min(max(a[axis], b[axis]), max(c[axis], d[axis]))
                if low < high:
                    return True
            elif turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0:
                return True
    # Left: touching at most. Interiors then meet only if points next to edges of one lie inside the other.
    tiny = Fraction(1, 10_000)
    for one, other in ((r, s), (s, r)):
        for (x1, y1), (x2, y2) in zip(one, one[1:]):
            for t in (Fraction(1, 7), Fraction(1, 2), Fraction(6, 7), tiny, 1 - tiny):
                for side in (-1, 1):
                    p = (x1 + t * (x2 - x1) - side * tiny * tiny * (y2 - y1), y1 + t * (y2 - y1) + side * tiny * tiny * (x2 - x1))
                    if inside(p, one) and inside(p, other):
                        return True
    return False


def test_two_parts_overlap_or_not():
    rng = random.Random(9)
    pairs = []
    while len(pairs) < 1500:
        a, b = (random_ring(rng, 4, rng.randrange(3, 6), shift) for shift in (0, rng.randrange(3)))
        if simple(a) and simple(b):
            pairs.append((a, b))
    got = verdicts([[[as_lists(a)], [as_lists(b)]] for a, b in pairs])
    expected = [not overlap(a, b) for a, b in pairs]
    assert 100 < sum(expected) < 1400
    assert [p for p, g, e in zip(pairs, got, expected) if g != e] == []


def test_box_pairs_are_all_pairs_that_meet():
    rng = np.random.default_rng(4)
    for spread in (1.0, 30.0, 1e6):
        low = rng.integers(0, 40, (300, 2)) * spread / 4
        high = low + rng.integers(0, 3, (300, 2)) * rng.choice([0.0, 0.5, 1.0, 64.0], (300, 1))
        owner = rng.integers(0, 4, 300)
        found = [pair for i, j in topology._box_pairs(owner, low, high) for pair in zip(i.tolist(), j.tolist())]
        expected = {(i, j) for i in range(300) for j in range(i + 1, 300)
                    if owner[i] == owner[j] and (low[i] <= high[j]).all() and (low[j] <= high[i]).all()}
        assert len(found) == len(expected) and {tuple(sorted(p)) for p in found} == expected


def squares(corners, side):
    return [[[[x, y], [x + side, y], [x + side, y + side], [x, y + side], [x, y]]] for x, y in corners]


def judged(parts):
    kinds, members = pa.array(["MultiPolygon"]), pa.array([None], pa.string())
    listed = pa.array([parts], pa.list_(pa.list_(pa.list_(pa.list_(pa.float64())))))
    return topology.topology_batch(kinds, listed, members)[0].as_py()


@pytest.mark.parametrize("across", [1, 100])
def test_many_parts_in_little_time(across):
    """10 000 parts, in one column and in a field: far below the hours that all pairs would take."""
    corners = [(2.0 * (k % across), 2.0 * (k // across)) for k in range(10_000)]
    started = time.perf_counter()
    assert judged(squares(corners, 1.0))
    assert not judged(squares([*corners, (0.5, 0.5)], 1.0))  # crosses one
    assert not judged(squares([*corners, (0.25, 0.25)], 0.5))  # lies in one
    holed = [[squares([(-1.0, -1.0)], 30_000.0)[0][0], *[ring for part in squares(corners, 1.0) for ring in part]]]
    assert judged(holed)
    assert time.perf_counter() - started < 60
