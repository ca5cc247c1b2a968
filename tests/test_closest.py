import random

import pytest

from planar.operators import closest as C
from planar.operators.closest import closest_pair
from tests import brute
from tests.conftest import points_df


def _pair(df):
    rows = df.collect()
    return None if not rows else tuple(rows[0][c] for c in ("ax", "ay", "bx", "by", "d2"))


def test_fewer_than_two(spark):
    assert _pair(closest_pair(points_df(spark, [(1, 1)] * 5))) is None
    assert _pair(closest_pair(points_df(spark, [(1, 1)]).where("x > 5"))) is None


@pytest.mark.parametrize("seed", range(4))
def test_small_random(spark, seed):
    rnd = random.Random(seed)
    pts = [(rnd.random(), rnd.random()) for _ in range(400)]
    assert _pair(closest_pair(points_df(spark, pts))) == brute.closest(pts)


@pytest.mark.parametrize("seed", range(3))
def test_lattice_ties_and_copies(spark, seed):
    rnd = random.Random(seed)
    pts = [(rnd.randint(0, 20), rnd.randint(0, 20)) for _ in range(300)]
    assert _pair(closest_pair(points_df(spark, pts + pts[:50]).repartition(6))) == brute.closest(pts)


@pytest.mark.parametrize("seed", range(3))
def test_distributed_path(spark, monkeypatch, seed):
    # Force the sample bound + grid join (and one level of recursion).
    monkeypatch.setattr(C, "BASE_ROWS", 40)
    rnd = random.Random(seed)
    pts = [(rnd.gauss(0, 1), rnd.gauss(0, 1)) for _ in range(900)]
    pts += [(0.5 + rnd.random() * 1e-3, 0.5 + rnd.random() * 1e-3) for _ in range(300)]  # dense cluster
    assert _pair(closest_pair(points_df(spark, pts).repartition(7))) == brute.closest(pts)


def test_tiny_distances(spark, monkeypatch):
    monkeypatch.setattr(C, "BASE_ROWS", 10)
    pts = [(1e6 + i * 1e-7, 5.0 + (i % 3) * 1e-7) for i in range(60)] + [(0.0, 0.0), (2e6, 3.0)]
    assert _pair(closest_pair(points_df(spark, pts))) == brute.closest(pts)


def test_collinear_vertical(spark, monkeypatch):
    monkeypatch.setattr(C, "BASE_ROWS", 10)
    pts = [(3.0, float(i * i)) for i in range(80)]
    assert _pair(closest_pair(points_df(spark, pts))) == brute.closest(pts)


@pytest.mark.parametrize("seed", range(4))
def test_grid_step_with_tight_bound(spark, seed):
    # The bound equals the true minimum, so the winning pair sits exactly at
    # the reach margin; lattice points also sit on cell borders.
    rnd = random.Random(seed)
    step = [1.0, 0.5, 3.0, 0.125][seed]
    pts = sorted({(rnd.randint(-30, 30) * step, rnd.randint(-30, 30) * step) for _ in range(500)})
    want = brute.closest(pts)
    x0, y0 = min(p[0] for p in pts), min(p[1] for p in pts)
    span = max(max(p[0] for p in pts) - x0, max(p[1] for p in pts) - y0)
    got = C._grid_pairs(points_df(spark, pts), want[4], x0, y0, span).first()
    assert tuple(got) == want


def test_heavy_copies_few_distinct(spark, monkeypatch):
    monkeypatch.setattr(C, "BASE_ROWS", 50)
    pts = [(1.0, 1.0)] * 3000 + [(4.0, 5.0)] * 2 + [(9.0, 9.0)]
    assert _pair(closest_pair(points_df(spark, pts).repartition(5))) == brute.closest(pts)


def test_fallback_bound_without_a_sample(spark, monkeypatch):
    # A sample too small to hold a pair: the extent bounds the distance.
    pts = [(0.0, 0.0), (3.0, 4.0), (10.0, 0.0)]
    monkeypatch.setattr(type(spark.range(1)), "sample", lambda self, **kw: self.limit(1))
    assert _pair(closest_pair(points_df(spark, pts).repartition(3), base_rows=2)) == brute.closest(pts)


def test_permuted_lattice(spark):
    # Neighbours in x and in y order are far apart: a sample's bound is needed.
    n, k = 4096, 1531
    pts = [(float(i), float(i * k % n)) for i in range(n)]
    assert _pair(closest_pair(points_df(spark, pts))) == brute.closest(pts)
