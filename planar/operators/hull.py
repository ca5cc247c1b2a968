"""Convex hull and the pair queries that run on it.

Plan: every input partition reduces its points to their hull in
``mapInPandas`` (Arrow batches are folded in, so memory is one chunk plus a
hull; a vectorised interior filter discards most points before the chain
scan).  The hull of the union of these partial hulls is the hull of all
points: they are the candidates, written once and counted.  Up to
``BASE_ROWS`` of them are solved in one task; more (very many partitions, or
points in convex position) arc by arc, see ``hull_arcs``.

Turn tests are exact (see ``exact``), so the vertices do not depend on how
the points are split.

The hull is strict: points on an edge are not vertices.  The upper chain runs
over the highest point of each x column, from the leftmost to the rightmost
column; the lower chain likewise over the lowest points.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planar.functions.geometry import finite
from planar.operators import hull_arcs as arcs
from planar.operators.exact import TINY, TURN_ERROR, turn, turn_signs
from planar.operators.kernels import PAIR_SCHEMA, best_pair, cell_pairs, oriented_pairs
from planar.plans.session import ensure_checkpoint_dir, ship_package

BASE_ROWS = 1 << 16  # most candidates that one task solves
CHUNK = 1 << 16      # points buffered per task before reducing to a hull


# ---------------------------------------------------------------------------
# local geometry on numpy arrays (runs inside tasks)
# ---------------------------------------------------------------------------
def _columns(x: np.ndarray, y: np.ndarray):
    """Distinct x ascending, with the lowest and highest y of each."""
    order = np.lexsort((y, x))
    xs, ys = x[order], y[order]
    if len(xs) == 0:
        return xs, ys, ys
    brk = xs[1:] != xs[:-1]
    first = np.concatenate(([True], brk))
    last = np.concatenate((brk, [True]))
    return xs[first], ys[first], ys[last]


def _scan(xs: list, ys: list, upper: bool, eps: float) -> list[int]:
    """Monotone chain over points sorted by x (one point per x).  The turn
    test is exact; with ``eps`` it is the rounded cross product against the
    tolerance."""
    st: list[int] = []
    for i in range(len(xs)):
        px, py = xs[i], ys[i]
        while len(st) >= 2:
            o, a = st[-2], st[-1]
            if eps:
                c = (xs[a] - xs[o]) * (py - ys[o]) - (ys[a] - ys[o]) * (px - xs[o])
            else:
                c = turn(xs[o], ys[o], xs[a], ys[a], px, py)
            if (c >= -eps) if upper else (c <= eps):
                st.pop()
            else:
                break
        st.append(i)
    return st


SLOW_SHARE = 0.1  # rounds that drop a smaller share of the points leave the rest to the scan


def _chain(xs: np.ndarray, ys: np.ndarray, upper: bool) -> np.ndarray:
    """Places of the exact chain's vertices among points sorted by x (one per
    x).  A point on or below (above) the line between its neighbours is no
    vertex, whatever becomes of them, so whole rounds of points are dropped
    at once; when a round drops none, the rest is the chain."""
    at = np.arange(len(xs))
    while len(at) > 32:
        x, y = xs[at], ys[at]
        sign = turn_signs(x[:-2], y[:-2], x[1:-1], y[1:-1], x[2:], y[2:])
        stay = np.r_[True, sign < 0 if upper else sign > 0, True]
        left = int(stay.sum())
        if left == len(at):
            return at
        slow = len(at) - left < SLOW_SHARE * len(at)
        at = at[stay]
        if slow:
            break
    return at[_scan(xs[at].tolist(), ys[at].tolist(), upper, 0.0)]


def chains(x: np.ndarray, y: np.ndarray, eps: float = 0.0):
    """Upper and lower chains as ``(xs, ys)`` array pairs, left to right.
    ``eps`` thins the exact hull's chains, so it sees the same vertices
    however the points were split."""
    x, y = _prefilter(x, y)
    xs, lo_y, hi_y = _columns(x, y)
    up, lo = _chain(xs, hi_y, True), _chain(xs, lo_y, False)
    (ux, uy), (lx, ly) = (xs[up], hi_y[up]), (xs[lo], lo_y[lo])
    if eps:
        up, lo = _scan(ux.tolist(), uy.tolist(), True, eps), _scan(lx.tolist(), ly.tolist(), False, eps)
        return (ux[up], uy[up]), (lx[lo], ly[lo])
    return (ux, uy), (lx, ly)


def _ring_ccw(upper, lower) -> np.ndarray:
    """Counter-clockwise ring (no closing point) from the two chains."""
    (ux, uy), (lx, ly) = upper, lower
    pts = list(zip(lx.tolist(), ly.tolist())) + list(zip(ux.tolist()[::-1], uy.tolist()[::-1]))
    ring: list[tuple[float, float]] = []
    for p in pts:
        if not ring or ring[-1] != p:
            ring.append(p)
    if len(ring) > 1 and ring[0] == ring[-1]:
        ring.pop()
    return np.array(ring, dtype=float).reshape(-1, 2)


def _prefilter(x: np.ndarray, y: np.ndarray):
    """Drop points that are certainly inside the polygon of the eight extreme
    points (beyond any rounding of the test)."""
    if len(x) < 64:
        return x, y
    s, d = x + y, x - y
    idx = np.unique([x.argmin(), x.argmax(), y.argmin(), y.argmax(), s.argmin(), s.argmax(), d.argmin(), d.argmax()])
    ex, ey = x[idx], y[idx]
    xs, lo_y, hi_y = _columns(ex, ey)
    up, lo = _chain(xs, hi_y, True), _chain(xs, lo_y, False)
    poly = _ring_ccw((xs[up], hi_y[up]), (xs[lo], lo_y[lo]))
    if len(poly) < 3:
        return x, y
    inside = np.ones(len(x), dtype=bool)
    old = np.seterr(over="ignore", invalid="ignore")
    for i in range(len(poly)):
        (ox, oy), (ax, ay) = poly[i], poly[(i + 1) % len(poly)]
        l, r = (ax - ox) * (y - oy), (ay - oy) * (x - ox)
        size = np.abs(l) + np.abs(r)
        inside &= (l - r > TURN_ERROR * size) & (size > TINY) & (size < np.inf)
    np.seterr(**old)
    keep = ~inside
    return x[keep], y[keep]


def hull_vertices(x: np.ndarray, y: np.ndarray, eps: float = 0.0):
    (ux, uy), (lx, ly) = chains(x, y, eps)
    v = np.unique(np.column_stack([np.concatenate([ux, lx]), np.concatenate([uy, ly])]), axis=0)
    return v[:, 0], v[:, 1]


def _ring_clockwise(upper, lower) -> list[tuple[float, float]]:
    """Clockwise from the smallest point: upper chain left to right, then the
    lower chain right to left, each point once."""
    (ux, uy), (lx, ly) = upper, lower
    start = (float(lx[0]), float(ly[0]))
    out = [start]
    seen = {start}
    for p in zip(ux.tolist(), uy.tolist()):
        if p not in seen:
            out.append(p)
            seen.add(p)
    for p in reversed(list(zip(lx.tolist(), ly.tolist()))):
        if p not in seen:
            out.append(p)
            seen.add(p)
    return out


def antipodal_candidates(P: np.ndarray):
    """Vertex pairs containing every antipodal pair of a strictly convex
    counter-clockwise polygon (rotating calipers, with both neighbours of
    each caliper vertex added so parallel edges and rounding lose nothing)."""
    n = len(P)
    xs, ys = P[:, 0].tolist(), P[:, 1].tolist()

    def area(i, k, m):
        return abs((xs[k] - xs[i]) * (ys[m] - ys[i]) - (ys[k] - ys[i]) * (xs[m] - xs[i]))

    ii, jj = [], []
    j = 1
    for i in range(n):
        i2 = (i + 1) % n
        steps = 0
        while steps < n and area(i, i2, (j + 1) % n) > area(i, i2, j):
            j = (j + 1) % n
            steps += 1
        for k in (j - 1, j, j + 1):
            ii.extend((i, i2))
            jj.extend((k % n, k % n))
    return np.array(ii), np.array(jj)


def farthest_from_hull(upper, lower):
    ring = _ring_ccw(upper, lower)
    n = len(ring)
    if n == 0:
        return None
    if n == 1:
        p = ring[0]
        return (p[0], p[1], p[0], p[1], 0.0)
    if n == 2:
        i, j = np.array([0]), np.array([1])
    else:
        i, j = antipodal_candidates(ring)
        keep = i != j
        i, j = i[keep], j[keep]
    ax, ay, bx, by, d2 = oriented_pairs(ring, i, j)
    k = best_pair(ax, ay, bx, by, d2, largest=True)
    return (ax[k], ay[k], bx[k], by[k], d2[k])


def closest_on_axes_from_hull(upper, lower):
    """Closest pair of hull vertices whose x and y both differ; a is the one
    with the smaller x.  The bound comes from ring neighbours, so only pairs
    in adjacent grid cells are compared."""
    ring = _ring_ccw(upper, lower)
    n = len(ring)
    if n < 2:
        return None

    def qualified(i, j):
        return (ring[i, 0] != ring[j, 0]) & (ring[i, 1] != ring[j, 1])

    idx = np.arange(n)
    bi = np.concatenate([idx, idx])
    bj = np.concatenate([(idx + 1) % n, (idx + 2) % n])
    ok = (bi != bj) & qualified(bi, bj)
    span = max(np.ptp(ring[:, 0]), np.ptp(ring[:, 1]))
    if ok.any():
        d = ring[bi[ok]] - ring[bj[ok]]
        bound = float(np.min(d[:, 0] * d[:, 0] + d[:, 1] * d[:, 1]))
    else:
        bound = 2.0 * span * span
    w = max(math.sqrt(bound) * 1.01, span * 2.0**-40, np.finfo(float).tiny)
    i, j = cell_pairs(ring, w)
    ok = qualified(i, j)
    i, j = i[ok], j[ok]
    if len(i) == 0:
        return None
    swap = ring[i, 0] > ring[j, 0]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    ax, ay, bx, by = ring[i, 0], ring[i, 1], ring[j, 0], ring[j, 1]
    dx, dy = ax - bx, ay - by
    d2 = dx * dx + dy * dy
    k = best_pair(ax, ay, bx, by, d2, largest=False)
    return (ax[k], ay[k], bx[k], by[k], d2[k])


# ---------------------------------------------------------------------------
# Spark plumbing
# ---------------------------------------------------------------------------
def _partial():
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hx = np.empty(0)
        hy = np.empty(0)
        bufx, bufy, size = [hx], [hy], 0
        for pdf in batches:
            bufx.append(pdf["x"].to_numpy(dtype=float))
            bufy.append(pdf["y"].to_numpy(dtype=float))
            size += len(pdf)
            # Reduce once the buffer is CHUNK points and twice the last hull:
            # when the hull keeps most points (points in convex position) the
            # buffer doubles between reductions, so the work stays linear.
            if size >= max(CHUNK, 2 * len(hx)):
                hx, hy = hull_vertices(np.concatenate(bufx), np.concatenate(bufy))
                bufx, bufy, size = [hx], [hy], len(hx)
        x, y = np.concatenate(bufx), np.concatenate(bufy)
        if len(x):
            hx, hy = hull_vertices(x, y)
            yield pd.DataFrame({"x": hx, "y": hy})

    return run


def _candidates(points: DataFrame, x: str, y: str) -> DataFrame:
    """Every input partition's own hull, written once."""
    spark = points.sparkSession
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    pts = points.where(finite(x, y)).select(F.col(x).alias("x"), F.col(y).alias("y"))
    return pts.mapInPandas(_partial(), "x double, y double").checkpoint()


def _final(mode: str, eps: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = [b for b in batches if len(b)]
        if not frames:
            return
        pdf = pd.concat(frames)
        upper, lower = chains(pdf["x"].to_numpy(dtype=float), pdf["y"].to_numpy(dtype=float), eps)
        if mode == "vertices":
            v = np.unique(np.column_stack([np.concatenate([upper[0], lower[0]]),
                                           np.concatenate([upper[1], lower[1]])]), axis=0)
            yield pd.DataFrame({"x": v[:, 0], "y": v[:, 1]})
        elif mode == "ring":
            ring = _ring_clockwise(upper, lower)
            yield pd.DataFrame(
                {"ord": np.arange(len(ring), dtype=np.int32),
                 "x": [p[0] for p in ring], "y": [p[1] for p in ring]}
            )
        elif mode == "chains":
            yield pd.DataFrame(
                {"chain": ["upper"] * len(upper[0]) + ["lower"] * len(lower[0]),
                 "x": np.concatenate([upper[0], lower[0]]), "y": np.concatenate([upper[1], lower[1]])}
            )
        else:
            fn = farthest_from_hull if mode == "farthest" else closest_on_axes_from_hull
            best = fn(upper, lower)
            if best is not None:
                yield pd.DataFrame([best], columns=["ax", "ay", "bx", "by", "d2"]).astype(float)

    return run


_SCHEMAS = {
    "vertices": "x double, y double",
    "ring": "ord int, x double, y double",
    "chains": "chain string, x double, y double",
    "farthest": PAIR_SCHEMA,
    "closest_axes": PAIR_SCHEMA,
}


def _hull(points: DataFrame, mode: str, x: str, y: str, eps: float, base_rows: int | None) -> DataFrame:
    base = max(4, base_rows or BASE_ROWS)
    c = _candidates(points, x, y)
    count = c.count()
    if count <= base:
        return c.repartition(1).mapInPandas(_final(mode, eps), _SCHEMAS[mode])
    chain = arcs.hull_chain(c, base, count, chains)
    if eps:
        chain = arcs.thinned(chain, eps, _scan)
    if mode == "vertices":
        return arcs.vertices(chain)
    if mode == "ring":
        return arcs.ring(chain)
    if mode == "chains":
        return arcs.both_chains(chain)
    if mode == "farthest":
        return arcs.farthest(chain, lambda p: farthest_from_hull(*chains(p[:, 0], p[:, 1])))
    return arcs.closest_on_axes(chain)


def convex_hull(points: DataFrame, x: str = "x", y: str = "y", eps: float = 0.0, base_rows: int | None = None) -> DataFrame:
    """Distinct hull vertices ``(x, y)``.

    ``base_rows`` (65,536 by default) is the largest number of candidates
    (vertices of the input partitions' hulls) that one task solves on its
    own; more are solved arc by arc.  It bounds a task's memory; it changes
    no result, except that a tolerance ``eps`` is applied to blocks of that
    many vertices."""
    return _hull(points, "vertices", x, y, eps, base_rows)


def convex_hull_ring(points: DataFrame, x: str = "x", y: str = "y", eps: float = 0.0, base_rows: int | None = None) -> DataFrame:
    """Hull vertices ``(ord, x, y)`` clockwise from the smallest (x, y)."""
    return _hull(points, "ring", x, y, eps, base_rows)


def hull_chains(points: DataFrame, x: str = "x", y: str = "y", eps: float = 0.0, base_rows: int | None = None) -> DataFrame:
    """``(chain, x, y)`` for the upper and lower chains; the end points of
    the two chains coincide when an extreme x column holds one point."""
    return _hull(points, "chains", x, y, eps, base_rows)


def farthest_pair(points: DataFrame, x: str = "x", y: str = "y", base_rows: int | None = None) -> DataFrame:
    """``(ax, ay, bx, by, d2)``: the two points farthest apart, a < b in
    (x, y) order, ties to the smallest (ax, ay, bx, by).  The pair is always
    a pair of hull vertices touched by parallel lines (rotating calipers, or
    a join of slope ranges where the hull is large).  One point gives the
    pair (p, p) with d2 = 0."""
    return _hull(points, "farthest", x, y, 0.0, base_rows)


def hull_closest_pair(points: DataFrame, x: str = "x", y: str = "y", eps: float = 1e-9, base_rows: int | None = None) -> DataFrame:
    """Closest pair among hull vertices that differ in both x and y (a has
    the smaller x); ``eps`` is a tolerance on the turn test that thins the
    exact hull."""
    return _hull(points, "closest_axes", x, y, eps, base_rows)
