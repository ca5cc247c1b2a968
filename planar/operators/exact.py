"""Exact turn tests: the sign of ``(A - O) x (B - O)`` for doubles.

A rounded test decides where its error bound proves the sign.  The rest is
worked out exactly from error-free sums and products: the differences and
their errors, the two-part products of them, and the sign of their sum.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np

# A cross product of rounded differences has the sign it shows when it
# exceeds this share of its two products' magnitudes (and these are far from
# underflow).
TURN_ERROR = 3.3306690738754716e-16 * 1.01
TINY = 1e-280
# Products within these bounds keep all their parts clear of overflow and underflow.
SAFE_LOW, SAFE_HIGH = 1e-200, 1e280
SPLIT = 134217729.0  # 2^27 + 1


def _two_diff(a, b):
    d = a - b
    t = d - a
    return d, (a - (d - t)) - (b + t)


def _rational(ox, oy, ax, ay, bx, by) -> int:
    ox, oy, ax, ay, bx, by = map(Fraction, (ox, oy, ax, ay, bx, by))
    exact = (ax - ox) * (by - oy) - (ay - oy) * (bx - ox)
    return (exact > 0) - (exact < 0)


def turn(ox: float, oy: float, ax: float, ay: float, bx: float, by: float) -> float:
    """A number with the exact sign of ``(A - O) x (B - O)``."""
    p, q, r, s = ax - ox, by - oy, ay - oy, bx - ox
    left, right = p * q, r * s
    c, size = left - right, abs(left) + abs(right)
    if TINY < size < math.inf and abs(c) > TURN_ERROR * size:
        return c
    if not (SAFE_LOW < size < SAFE_HIGH):
        return float(_rational(ox, oy, ax, ay, bx, by))
    p, e = _two_diff(ax, ox)
    q, f = _two_diff(by, oy)
    r, g = _two_diff(ay, oy)
    s, h = _two_diff(bx, ox)
    terms = []
    for u, v, sign in ((p, q, 1.0), (p, f, 1.0), (e, q, 1.0), (e, f, 1.0), (r, s, -1.0), (r, h, -1.0), (g, s, -1.0), (g, h, -1.0)):
        if u and v:
            w = u * v
            if abs(w) < TINY:
                return float(_rational(ox, oy, ax, ay, bx, by))
            terms.append(sign * w)
            terms.append(sign * math.fma(u, v, -w))
    return math.fsum(terms)  # correctly rounded: its sign is exact


def _two_product(a, b):
    p = a * b
    t = SPLIT * a
    ah = t - (t - a)
    al = a - ah
    t = SPLIT * b
    bh = t - (t - b)
    bl = b - bh
    return p, ((ah * bh - p) + ah * bl + al * bh) + al * bl


def _sum_sign(terms) -> np.ndarray:
    """Signs of the exact sums of several arrays: the terms are added one by
    one to a sequence of parts that do not overlap, the last the largest."""
    parts: list[np.ndarray] = []
    for q in terms:
        for i, h in enumerate(parts):
            s = q + h
            t = s - q
            parts[i] = (q - (s - t)) + (h - t)
            q = s
        parts.append(q)
    sign = np.zeros(len(parts[0]))
    for h in parts:  # a later part outweighs all before it
        sign = np.where(h != 0, np.sign(h), sign)
    return sign


def turn_signs(ox, oy, ax, ay, bx, by) -> np.ndarray:
    """Exact signs of ``(A - O) x (B - O)`` for arrays (-1, 0 or 1)."""
    ox, oy, ax, ay, bx, by = np.broadcast_arrays(*(np.asarray(v, float) for v in (ox, oy, ax, ay, bx, by)))
    with np.errstate(all="ignore"):
        left, right = (ax - ox) * (by - oy), (ay - oy) * (bx - ox)
        c, size = left - right, np.abs(left) + np.abs(right)
        sign = np.sign(c)
        at = np.flatnonzero(~((size > TINY) & (size < np.inf) & (np.abs(c) > TURN_ERROR * size)))
        if len(at) == 0:
            return sign
        ox, oy, ax, ay, bx, by = (v[at] for v in (ox, oy, ax, ay, bx, by))
        (p, e), (q, f), (r, g), (s, h) = _two_diff(ax, ox), _two_diff(by, oy), _two_diff(ay, oy), _two_diff(bx, ox)
        zero = ((p == 0) | (q == 0)) & ((r == 0) | (s == 0))  # both products vanish exactly
        plain = (e == 0) & (f == 0) & (g == 0) & (h == 0)
        fits = np.abs(p * q) + np.abs(r * s)
        safe = (fits > SAFE_LOW) & (fits < SAFE_HIGH) & (np.maximum.reduce([np.abs(v) for v in (p, q, r, s)]) < SAFE_HIGH)
        # A product far below the other may lose parts: rational numbers decide.
        for u, v in ((p, q), (r, s)):
            w = np.abs(u * v)
            safe &= (w > SAFE_LOW) | (u == 0) | (v == 0)
        out = np.zeros(len(at))
        some = np.flatnonzero(plain & safe)
        if len(some):
            a, b = _two_product(p[some], q[some]), _two_product(r[some], s[some])
            out[some] = _sum_sign([a[1], -b[1], a[0], -b[0]])
        some = np.flatnonzero(~plain & safe)
        if len(some):
            p, e, q, f, r, g, s, h = (v[some] for v in (p, e, q, f, r, g, s, h))
            terms = []
            for u, v, k in ((e, f, 1), (g, h, -1), (p, f, 1), (e, q, 1), (r, h, -1), (g, s, -1), (p, q, 1), (r, s, -1)):
                w, z = _two_product(u, v)
                terms += [k * z, k * w]
            out[some] = _sum_sign(terms)
    for i in np.flatnonzero(~safe & ~(zero & plain)).tolist():
        out[i] = _rational(ox[i], oy[i], ax[i], ay[i], bx[i], by[i])
    sign = sign.copy()
    sign[at] = out
    return sign
