"""The hull family with more candidates than one task may hold."""

import math
import random

import numpy as np
import pytest

from planar.operators import hull as H
from planar.operators import hull_arcs as A
from planar.operators.hull import convex_hull, convex_hull_ring, farthest_pair, hull_chains, hull_closest_pair
from tests import brute
from tests.conftest import points_df
from tests.test_hull import LIMITS, _exact_hull, _pair, _set

PARTS = (1, 4, 17)


def circle(n, r=1e6):
    a = np.arange(n) * (math.tau / n)
    return [(round(r * math.cos(t)), round(r * math.sin(t))) for t in a]


def near_line(n, rnd):
    return [(k * 0.1, k * 0.3) for k in (rnd.randrange(400) * 0.1 for _ in range(n))]


CASES = {
    "circle": lambda rnd: circle(300),
    "parabola": lambda rnd: [(i, i * i) for i in range(-90, 90)],
    "lattice": lambda rnd: [(rnd.randint(0, 30), rnd.randint(0, 30)) for _ in range(400)],
    "square": lambda rnd: [(rnd.choice([0, 50]), rnd.randint(0, 50)) for _ in range(200)] + [(i, rnd.choice([0, 50])) for i in range(50)],
    "gauss": lambda rnd: [(rnd.gauss(0, 1), rnd.gauss(0, 1e-6)) for _ in range(600)],
    "near_line": lambda rnd: near_line(300, rnd),
    "corner": lambda rnd: [(0, 0), (1000, 0)] + [(i, 1000 * math.sqrt(1 - (i / 1000) ** 2)) for i in range(0, 1000, 7)],
    "half": lambda rnd: [(math.cos(t), math.sin(t)) for t in (rnd.random() * math.pi for _ in range(250))],
}


@pytest.mark.parametrize("name", list(CASES))
def test_vertices_ring_and_chains(spark, name):
    pts = CASES[name](random.Random(len(name)))
    want = _exact_hull([(float(x), float(y)) for x, y in pts])
    rings = set()
    for parts in PARTS:
        rows = sorted(convex_hull_ring(points_df(spark, pts).repartition(parts), base_rows=8).collect(), key=lambda r: r.ord)
        assert [r.ord for r in rows] == list(range(len(want))) and {(r.x, r.y) for r in rows} == want
        rings.add(tuple((r.x, r.y) for r in rows))
    df = points_df(spark, pts).repartition(5)
    rings.add(tuple((r.x, r.y) for r in sorted(convex_hull_ring(df).collect(), key=lambda r: r.ord)))
    assert len(rings) == 1
    assert _set(convex_hull(df, base_rows=8)) == want
    many, one = (sorted((r.chain, r.x, r.y) for r in hull_chains(df, base_rows=n).collect()) for n in (8, None))
    assert many == one


@pytest.mark.parametrize("name", ["circle", "lattice", "near_line", "corner", "half"])
def test_pairs(spark, name):
    pts = CASES[name](random.Random(len(name)))
    exact = [tuple(map(float, p)) for p in pts]
    far, near = set(), set()
    for parts in (1, 17):
        df = points_df(spark, pts).repartition(parts)
        far.add(_pair(farthest_pair(df, base_rows=8)))
        near.add(_pair(hull_closest_pair(df, eps=0.0, base_rows=8)))
    assert far == {brute.farthest(exact)}
    assert near == {brute.closest_on_axes(sorted(_exact_hull(exact)))}


@pytest.mark.parametrize("seed", range(4))
def test_farthest_with_ties(spark, seed):
    rnd = random.Random(seed)
    pts = [(rnd.randint(0, 9), rnd.randint(0, 9)) for _ in range(80)]
    assert _pair(farthest_pair(points_df(spark, pts).repartition(3), base_rows=4)) == brute.farthest(pts)


@pytest.mark.parametrize("name", list(LIMITS))
def test_limits(spark, name):
    pts = LIMITS[name] * 3
    df = points_df(spark, pts).repartition(9)
    want = {(float(x), float(y)) for x, y in brute.hull(pts)}
    assert _set(convex_hull(df, base_rows=1)) == want
    ring = sorted(convex_hull_ring(df, base_rows=1).collect(), key=lambda r: r.ord)
    assert [r.ord for r in ring] == list(range(len(want))) and (ring[0].x, ring[0].y) == min(want)
    assert _pair(farthest_pair(df, base_rows=1)) == _pair(farthest_pair(df))
    assert _pair(hull_closest_pair(df, base_rows=1)) == _pair(hull_closest_pair(df))


def test_tolerance_in_blocks_does_not_depend_on_partitions(spark):
    pts = [(1e-3 * math.cos(i * math.tau / 400), 1e-3 * math.sin(i * math.tau / 400)) for i in range(400)]
    got = {_pair(hull_closest_pair(points_df(spark, pts).repartition(p), base_rows=64)) for p in PARTS}
    assert len(got) == 1
    counts = {len(_set(convex_hull(points_df(spark, pts).repartition(p), eps=1e-9, base_rows=64))) for p in (1, 17)}
    assert len(counts) == 1 and counts.pop() < 400


def test_corners_that_are_no_vertices_are_given_up(spark):
    """Directions chosen by rounded products may miss the true extreme."""
    pts = [(float(i), 1e16 + 2.0 * (i % 3)) for i in range(64)] + [(float(i), -1e16 - i * (63 - i) // 16) for i in range(64)]
    want = _exact_hull(pts)
    for parts in PARTS:
        assert _set(convex_hull(points_df(spark, pts).repartition(parts), base_rows=4)) == want


def test_no_task_holds_more_than_its_share(spark):
    """A million points in convex position: arcs, blocks and slope ranges."""
    n, base = 1_000_000, 1 << 16
    ids = spark.range(n, numPartitions=8)
    df = ids.selectExpr("cast(id as double) - 500000 as x", "cast((id - 500000) * (id - 500000) as double) as y")
    c = H._candidates(df, "x", "y")
    assert c.count() == n
    chain = A.hull_chain(c, base, n, H.chains)
    assert chain.sizes == (2, n) and chain.rows.count() == n + 2
    frame, left = A._frame(c, base, n, H.chains)
    sizes = [r["count"] for r in left.mapInPandas(A._assign(frame), A.ASSIGNED).groupBy("side", "arc").count().collect()]
    assert max(sizes) <= base and len(sizes) >= n // base
    blocks = A._blocks(chain, before=True, after=True).groupBy("side", "block").count().collect()
    assert max(r["count"] for r in blocks) <= base + 2
    assert A.ring(chain).selectExpr("max(ord) m", "count(distinct ord) n").first() == (n - 1, n)
    assert _pair(A.closest_on_axes(chain)) == (-1.0, 1.0, 0.0, 0.0, 2.0)
    far = _pair(A.farthest(chain, lambda p: H.farthest_from_hull(*H.chains(p[:, 0], p[:, 1]))))
    assert far[:2] == (-500000.0, 2.5e11) and far[3] <= 1.0
