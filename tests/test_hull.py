import math
import random

import numpy as np
import pytest

from planar.operators import hull as H
from planar.operators.hull import (
    convex_hull,
    convex_hull_ring,
    farthest_pair,
    hull_chains,
    hull_closest_pair,
)
from tests import brute
from tests.conftest import points_df

LIMITS = {
    "one": [(1, 2)],
    "two": [(0, 0), (3, 4)],
    "all_equal": [(5, 5)] * 7,
    "collinear": [(i, 2 * i) for i in range(10)],
    "vertical": [(3, i) for i in range(6)],
    "horizontal": [(i, -1) for i in range(6)],
    "square_with_mid_edge_points": [(0, 0), (2, 0), (2, 2), (0, 2), (1, 0), (2, 1), (1, 2), (0, 1), (1, 1)],
}


def _set(df):
    return {(r.x, r.y) for r in df.collect()}


@pytest.mark.parametrize("name", list(LIMITS))
def test_hull_limits(spark, name):
    pts = LIMITS[name]
    assert _set(convex_hull(points_df(spark, pts))) == {(float(x), float(y)) for x, y in brute.hull(pts)}


def test_hull_empty(spark):
    df = points_df(spark, [(0, 0)]).where("x > 1")
    assert convex_hull(df).count() == 0
    assert farthest_pair(df).count() == 0
    assert convex_hull_ring(df).count() == 0


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("parts", [1, 4, 17])
def test_hull_random_any_partitioning(spark, seed, parts):
    rnd = random.Random(seed)
    pts = [(rnd.randint(0, 30), rnd.randint(0, 30)) for _ in range(300)]
    df = points_df(spark, pts).repartition(parts)
    assert _set(convex_hull(df)) == {(float(x), float(y)) for x, y in brute.hull(pts)}


def test_hull_invariant_under_copies(spark):
    rnd = random.Random(3)
    pts = [(rnd.random(), rnd.random()) for _ in range(200)]
    a = _set(convex_hull(points_df(spark, pts)))
    b = _set(convex_hull(points_df(spark, pts * 5).repartition(7)))
    assert a == b


def test_ring_is_clockwise_from_smallest(spark):
    rnd = random.Random(11)
    pts = [(rnd.randint(-50, 50), rnd.randint(-50, 50)) for _ in range(400)]
    rows = sorted(convex_hull_ring(points_df(spark, pts).repartition(5)).collect(), key=lambda r: r.ord)
    ring = [(r.x, r.y) for r in rows]
    assert [r.ord for r in rows] == list(range(len(rows)))
    assert ring[0] == min(ring)
    assert set(ring) == {(float(x), float(y)) for x, y in brute.hull(pts)}
    n = len(ring)
    for i in range(n):
        assert brute.cross(ring[i], ring[(i + 1) % n], ring[(i + 2) % n]) < 0  # right turns


def test_chains(spark):
    pts = [(0, 0), (0, 3), (2, 5), (4, 3), (4, 1), (2, -1), (2, 2)]
    rows = hull_chains(points_df(spark, pts)).collect()
    up = sorted((r.x, r.y) for r in rows if r.chain == "upper")
    lo = sorted((r.x, r.y) for r in rows if r.chain == "lower")
    assert up == [(0.0, 3.0), (2.0, 5.0), (4.0, 3.0)]
    assert lo == [(0.0, 0.0), (2.0, -1.0), (4.0, 1.0)]


def test_tree_reduction(spark, monkeypatch):
    monkeypatch.setattr(H, "BASE_ROWS", 16)
    rnd = random.Random(5)
    pts = [(rnd.gauss(0, 1), rnd.gauss(0, 1)) for _ in range(2000)]
    got = _set(convex_hull(points_df(spark, pts).repartition(20)))
    assert got == {(float(x), float(y)) for x, y in brute.hull(pts)}


def _pair(df):
    rows = df.collect()
    return None if not rows else tuple(rows[0][c] for c in ("ax", "ay", "bx", "by", "d2"))


@pytest.mark.parametrize("seed", range(5))
def test_farthest_random_and_lattice(spark, seed):
    rnd = random.Random(seed)
    pts = [(rnd.randint(0, 6), rnd.randint(0, 6)) for _ in range(60)]  # many ties
    assert _pair(farthest_pair(points_df(spark, pts).repartition(3))) == brute.farthest(pts)
    pts = [(rnd.random(), rnd.random()) for _ in range(300)]
    assert _pair(farthest_pair(points_df(spark, pts))) == brute.farthest(pts)


def test_farthest_one_point(spark):
    assert _pair(farthest_pair(points_df(spark, [(2, 3), (2, 3)]))) == (2.0, 3.0, 2.0, 3.0, 0.0)


@pytest.mark.parametrize("n", [3, 4, 7, 64, 501])
def test_calipers_regular_polygons(n):
    ang = np.arange(n) * 2 * math.pi / n
    P = np.column_stack([np.round(1000 * np.cos(ang)), np.round(1000 * np.sin(ang))])
    upper, lower = H.chains(P[:, 0], P[:, 1])
    got = H.farthest_from_hull(upper, lower)
    pts = [tuple(p) for p in P.tolist()]
    assert tuple(float(v) for v in got) == brute.farthest(pts)


@pytest.mark.parametrize("seed", range(5))
def test_hull_closest_on_axes(spark, seed):
    rnd = random.Random(seed)
    pts = [(rnd.randint(0, 40), rnd.randint(0, 40)) for _ in range(200)]
    hv = brute.hull(pts)
    assert _pair(hull_closest_pair(points_df(spark, pts))) == brute.closest_on_axes(hv)


def test_hull_closest_rectangle(spark):
    pts = [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert _pair(hull_closest_pair(points_df(spark, pts))) == (0.0, 0.0, 1.0, 1.0, 2.0)
    assert hull_closest_pair(points_df(spark, [(0, 0), (0, 5)])).count() == 0


def _exact_hull(pts):
    """Strict hull in rational numbers."""
    from fractions import Fraction

    pts = sorted(set(pts))
    if len(pts) < 3:
        return set(pts)

    def half(seq):
        st = []
        for p in seq:
            while len(st) >= 2:
                (ox, oy), (ax, ay) = st[-2], st[-1]
                ox, oy, ax, ay, bx, by = map(Fraction, (ox, oy, ax, ay, *p))
                if (ax - ox) * (by - oy) - (ay - oy) * (bx - ox) > 0:
                    break
                st.pop()
            st.append(p)
        return st

    return set(half(pts)) | set(half(pts[::-1]))


@pytest.mark.parametrize("seed", range(6))
def test_nearly_collinear_doubles(spark, seed):
    rnd = random.Random(seed)
    pts = [(k * 0.1, k * 0.3) for k in (rnd.randrange(400) * 0.1 for _ in range(200))]
    want = _exact_hull(pts)
    for parts in (1, 4, 8, 17):
        assert _set(convex_hull(points_df(spark, pts).repartition(parts))) == want


def test_tolerance_does_not_depend_on_partitions(spark):
    import math

    pts = [(1e-3 * math.cos(i * math.tau / 400), 1e-3 * math.sin(i * math.tau / 400)) for i in range(400)]
    got = {_pair(hull_closest_pair(points_df(spark, pts).repartition(p))) for p in (1, 4, 8, 17)}
    assert len(got) == 1
