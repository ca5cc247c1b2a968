"""In-task numpy kernels shared by the pair operators.

They run inside one Spark task on data whose size the caller has bounded
(a hull, or at most ``BASE_ROWS`` points).
"""

from __future__ import annotations

import numpy as np
import pandas as pd

PAIR_SCHEMA = "ax double, ay double, bx double, by double, d2 double"


def best_pair(ax, ay, bx, by, d2, largest: bool):
    """Index of the pair with the smallest (or largest) d2, ties by (ax, ay, bx, by)."""
    key = -d2 if largest else d2
    order = np.lexsort((by, bx, ay, ax, key))
    return order[0]


def oriented_pairs(P: np.ndarray, i: np.ndarray, j: np.ndarray):
    """Pairs (i, j) as (a, b) with a < b in (x, y) order, and their d2."""
    ax, ay, bx, by = P[i, 0], P[i, 1], P[j, 0], P[j, 1]
    swap = (ax > bx) | ((ax == bx) & (ay > by))
    ax, bx = np.where(swap, bx, ax), np.where(swap, ax, bx)
    ay, by = np.where(swap, by, ay), np.where(swap, ay, by)
    dx, dy = ax - bx, ay - by
    return ax, ay, bx, by, dx * dx + dy * dy


def cell_pairs(P: np.ndarray, w: float):
    """Index pairs (i, j), i != j unordered, of points in the same or adjacent
    cells of side ``w`` (half neighbourhood, so each pair appears once)."""
    x0, y0 = P[:, 0].min(), P[:, 1].min()
    df = pd.DataFrame(
        {"i": np.arange(len(P)), "cx": np.floor((P[:, 0] - x0) / w).astype(np.int64),
         "cy": np.floor((P[:, 1] - y0) / w).astype(np.int64)}
    )
    out_i, out_j = [], []
    for dx, dy in ((0, 0), (1, 0), (-1, 1), (0, 1), (1, 1)):
        shifted = df.assign(cx=df.cx + dx, cy=df.cy + dy)
        m = shifted.merge(df, on=["cx", "cy"], suffixes=("_a", "_b"))
        if dx == 0 and dy == 0:
            m = m[m.i_a < m.i_b]
        out_i.append(m.i_a.to_numpy())
        out_j.append(m.i_b.to_numpy())
    return np.concatenate(out_i), np.concatenate(out_j)
