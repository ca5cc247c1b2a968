"""Plain-Python reference answers for small inputs (independent of planar)."""

from __future__ import annotations

import itertools


def cross(o, a, b):
    return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])


def hull(points):
    """Strict hull vertices by definition: p is a vertex when it is not
    inside or on the closed hull of the other distinct points."""
    pts = sorted(set(points))
    if len(pts) <= 2:
        return set(pts)
    out = set()
    for p in pts:
        others = [q for q in pts if q != p]
        if not _in_closed_hull(p, others):
            out.add(p)
    return out


def _in_closed_hull(p, pts):
    # Andrew's chain over the others (non-strict test via the hull polygon).
    pts = sorted(set(pts))
    if len(pts) == 1:
        return p == pts[0]
    lower, upper = [], []
    for q in pts:
        while len(lower) >= 2 and cross(lower[-2], lower[-1], q) <= 0:
            lower.pop()
        lower.append(q)
    for q in reversed(pts):
        while len(upper) >= 2 and cross(upper[-2], upper[-1], q) <= 0:
            upper.pop()
        upper.append(q)
    poly = lower[:-1] + upper[:-1]
    if len(poly) == 2:
        a, b = poly
        return cross(a, b, p) == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])
    return all(cross(poly[i], poly[(i + 1) % len(poly)], p) >= 0 for i in range(len(poly)))


def _d2(a, b):
    dx, dy = a[0] - b[0], a[1] - b[1]
    return dx * dx + dy * dy


def _pairs(points):
    pts = sorted(set(points))
    return [(a, b) for a, b in itertools.combinations(pts, 2)]


def closest(points):
    pairs = _pairs(points)
    if not pairs:
        return None
    a, b = min(pairs, key=lambda p: (_d2(*p), p[0], p[1]))
    return (a[0], a[1], b[0], b[1], _d2(a, b))


def farthest(points):
    pts = sorted(set(points))
    if len(pts) == 1:
        p = pts[0]
        return (p[0], p[1], p[0], p[1], 0.0)
    pairs = _pairs(points)
    if not pairs:
        return None
    a, b = min(pairs, key=lambda p: (-_d2(*p), p[0], p[1]))
    return (a[0], a[1], b[0], b[1], _d2(a, b))


def closest_on_axes(points):
    pts = sorted(set(points))
    best = None
    for a, b in itertools.combinations(pts, 2):
        if a[0] != b[0] and a[1] != b[1]:
            if a[0] > b[0]:
                a, b = b, a
            key = (_d2(a, b), a, b)
            if best is None or key < best:
                best = key
    if best is None:
        return None
    d2, a, b = best
    return (a[0], a[1], b[0], b[1], d2)


def norm(box):
    x1, y1, x2, y2 = box
    return min(x1, x2), min(y1, y2), max(x1, x2), max(y1, y2)


def heat(boxes, points):
    out = []
    for i, b in enumerate(boxes):
        a, c, e, d = norm(b)
        out.append((i, sum(1 for (x, y) in points if a < x < e and c < y < d)))
    return out


def containment(probes, boxes):
    out = []
    for i, (x1, y1, x2, y2) in enumerate(probes):
        for j, b in enumerate(boxes):
            a, c, e, d = norm(b)
            if a < x1 < e and a < x2 < e and c < y1 < d and c < y2 < d:
                out.append((i, j))
    return out


def union_vertices_raster(boxes):
    """Corners of the union of integer boxes via unit-cell coverage."""
    cov = set()
    for b in boxes:
        a, c, e, d = (int(v) for v in norm(b))
        for x in range(a, e):
            for y in range(c, d):
                cov.add((x, y))
    out = set()
    cand = {(x + dx, y + dy) for (x, y) in cov for dx in (0, 1) for dy in (0, 1)}
    for (x, y) in cand:
        sw, se = (x - 1, y - 1) in cov, (x, y - 1) in cov
        nw, ne = (x - 1, y) in cov, (x, y) in cov
        k = sw + se + nw + ne
        if k in (1, 3) or (sw and ne and not se and not nw) or (se and nw and not sw and not ne):
            out.add((float(x), float(y)))
    return out
