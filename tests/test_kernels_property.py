"""Property tests of the in-task numpy kernels against brute force."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from planar.operators import hull as H
from planar.operators.closest import local_closest
from tests import brute

lattice = st.lists(st.tuples(st.integers(-6, 6), st.integers(-6, 6)), min_size=1, max_size=60)
# Multiples of 1/8 up to 1000: every difference and cross product is exact in
# doubles, so brute force and the kernels must agree bit for bit.  (With
# arbitrary doubles near-collinear triples round differently per formula.)
dyadic = st.integers(-8000, 8000).map(lambda v: v / 8)
floats = st.lists(st.tuples(dyadic, dyadic), min_size=1, max_size=80)


def _arr(pts):
    P = np.array(pts, dtype=float).reshape(-1, 2)
    return P[:, 0], P[:, 1]


def _tuple(t):
    return None if t is None else tuple(float(v) for v in t)


@settings(max_examples=300, deadline=None)
@given(st.one_of(lattice, floats))
def test_hull_vertices(pts):
    x, y = _arr(pts)
    hx, hy = H.hull_vertices(x, y)
    assert set(zip(hx.tolist(), hy.tolist())) == {(float(a), float(b)) for a, b in brute.hull(pts)}


anything = st.floats(-1e6, 1e6, allow_nan=False) | st.integers(0, 40).map(lambda k: k * 0.1)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(anything, anything), min_size=1, max_size=120), st.integers(1, 7))
def test_hull_of_any_doubles_in_any_pieces(pts, pieces):
    from tests.test_hull import _exact_hull

    parts = [H.hull_vertices(*_arr(pts[i::pieces])) for i in range(pieces) if pts[i::pieces]]
    hx, hy = H.hull_vertices(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
    assert set(zip(hx.tolist(), hy.tolist())) == _exact_hull([(float(a), float(b)) for a, b in pts])


@settings(max_examples=300, deadline=None)
@given(st.one_of(lattice, floats))
def test_farthest(pts):
    x, y = _arr(pts)
    assert _tuple(H.farthest_from_hull(*H.chains(x, y))) == _tuple(brute.farthest(pts))


@settings(max_examples=300, deadline=None)
@given(st.one_of(lattice, floats))
def test_closest(pts):
    P = np.unique(np.array(pts, dtype=float).reshape(-1, 2), axis=0)
    assert _tuple(local_closest(P)) == _tuple(brute.closest(pts))


@settings(max_examples=300, deadline=None)
@given(lattice)
def test_closest_on_axes_of_hull(pts):
    x, y = _arr(pts)
    got = H.closest_on_axes_from_hull(*H.chains(x, y))
    assert _tuple(got) == _tuple(brute.closest_on_axes(brute.hull(pts)))


@settings(max_examples=200, deadline=None)
@given(lattice)
def test_ring_clockwise_from_smallest(pts):
    x, y = _arr(pts)
    ring = H._ring_clockwise(*H.chains(x, y))
    assert ring[0] == min(ring)
    assert len(set(ring)) == len(ring)
    n = len(ring)
    if n >= 3:
        for i in range(n):
            assert brute.cross(ring[i], ring[(i + 1) % n], ring[(i + 2) % n]) < 0
