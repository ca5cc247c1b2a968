"""Closest pair of distinct points.

Plan:

1. Distinct points (copies collapse map-side), written once to the
   checkpoint folder: every later step reads them, not the source.
2. One aggregate over them: count and extent.
3. Upper bound: the exact closest pair of a random sample of about
   ``n**(2/3)`` of them, found by the same procedure; at most ``base_rows``
   points are ever solved inside one task.  With that bound as grid cell, the
   expected number of pairs compared is linear in ``n`` for any input
   distribution (Rabin's sampling argument), so hot regions do not turn
   quadratic.
4. Cells of side ``w`` = twice the bound: every pair at distance <= bound
   lies in the same or an adjacent cell.  Each point meets its own cell and
   those of four neighbours (half of the 3x3 block, so each pair meets once)
   that lie within the bound of it, as a hash equi-join; the result is
   ``min(struct(d2, ax, ay, bx, by))``, a global aggregate with partial
   aggregation in every task.

Ties go to the smallest (ax, ay, bx, by) with a < b in (x, y) order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planar.functions.geometry import dist2, finite
from planar.operators.kernels import PAIR_SCHEMA, best_pair, cell_pairs, oriented_pairs
from planar.plans.session import ensure_checkpoint_dir, ship_package

BASE_ROWS = 1 << 10  # most points solved inside one task, by default
SLACK = 1.01


def local_closest(P: np.ndarray):
    """Exact closest pair of distinct points held in one array."""
    n = len(P)
    if n < 2:
        return None
    best = math.inf
    for a, b in ((0, 1), (1, 0)):
        order = np.lexsort((P[:, b], P[:, a]))
        Q = P[order]
        d = Q[1:] - Q[:-1]
        best = min(best, float(np.min(d[:, 0] * d[:, 0] + d[:, 1] * d[:, 1])))
    span = max(np.ptp(P[:, 0]), np.ptp(P[:, 1]))
    w = max(math.sqrt(best) * SLACK, span * 2.0**-40, np.finfo(float).tiny)
    i, j = cell_pairs(P, w)
    ax, ay, bx, by, d2 = oriented_pairs(P, i, j)
    k = best_pair(ax, ay, bx, by, d2, largest=False)
    return (ax[k], ay[k], bx[k], by[k], d2[k])


def _local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    frames = [b for b in batches if len(b)]
    if not frames:
        return
    pdf = pd.concat(frames)
    best = local_closest(pdf[["x", "y"]].to_numpy(dtype=float))
    if best is not None:
        yield pd.DataFrame([best], columns=["ax", "ay", "bx", "by", "d2"]).astype(float)


CELL_FACTOR = 2.0  # cell side in units of the bound


def _grid_pairs(pts: DataFrame, bound: float, x0: float, y0: float, span: float, which: Column | None = None) -> DataFrame:
    """Closest pair among ``pts`` (of those that ``which`` accepts) given that
    some pair is within ``sqrt(bound)``.

    Cells are ``CELL_FACTOR`` times the bound, so a pair within the bound
    lies in the same or an adjacent cell, and a point has to meet a
    neighbour cell only if it lies within the bound of that side of its own
    cell: about 2.5 rows per point leave for the join instead of 5.
    """
    d = math.sqrt(bound)
    w = max(d * CELL_FACTOR * SLACK, span * 2.0**-40, np.finfo(float).tiny)
    # Reach toward a neighbour: the bound plus slack for rounding of the
    # in-cell offset (relative error below 2**-12 of w at the floor width).
    m = d * SLACK + w * 2.0**-10
    X, Y = F.col("x") - F.lit(x0), F.col("y") - F.lit(y0)
    cx, cy = F.floor(X / F.lit(w)), F.floor(Y / F.lit(w))
    ox, oy = X - cx * F.lit(w), Y - cy * F.lit(w)  # offset inside the cell
    right, top, left = ox >= F.lit(w - m), oy >= F.lit(w - m), ox <= F.lit(m)
    offsets = F.array(
        F.struct(F.lit(0).alias("dx"), F.lit(0).alias("dy"), F.lit(True).alias("need")),
        F.struct(F.lit(1).alias("dx"), F.lit(0).alias("dy"), right.alias("need")),
        F.struct(F.lit(-1).alias("dx"), F.lit(1).alias("dy"), (left & top).alias("need")),
        F.struct(F.lit(0).alias("dx"), F.lit(1).alias("dy"), top.alias("need")),
        F.struct(F.lit(1).alias("dx"), F.lit(1).alias("dy"), (right & top).alias("need")),
    )
    a = (
        pts.select(F.col("x").alias("ax"), F.col("y").alias("ay"), cx.alias("_cx"), cy.alias("_cy"), offsets.alias("_o"))
        .select("ax", "ay", "_cx", "_cy", F.inline("_o"))
        .where(F.col("need"))
        .select(
            "ax", "ay",
            (F.col("_cx") + F.col("dx")).alias("_kx"),
            (F.col("_cy") + F.col("dy")).alias("_ky"),
            ((F.col("dx") == 0) & (F.col("dy") == 0)).alias("_same"),
        )
    )
    b = pts.select(F.col("x").alias("bx"), F.col("y").alias("by"), cx.alias("_bx"), cy.alias("_by"))
    ax, ay, bx, by = F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")
    less = (ax < bx) | ((ax == bx) & (ay < by))
    cond = (F.col("_kx") == F.col("_bx")) & (F.col("_ky") == F.col("_by")) & (~F.col("_same") | less)
    if which is not None:
        cond = cond & which
    # d2 is symmetric bit for bit ((a-b) is exactly -(b-a)), so the bound
    # filter runs before the pair is put in (x, y) order.
    pairs = a.join(b, cond, "inner").withColumn("d2", dist2(ax, ay, bx, by)).where(F.col("d2") <= F.lit(bound))
    swap = ~less
    o = pairs.select(
        F.when(swap, bx).otherwise(ax).alias("ax"),
        F.when(swap, by).otherwise(ay).alias("ay"),
        F.when(swap, ax).otherwise(bx).alias("bx"),
        F.when(swap, ay).otherwise(by).alias("by"),
        "d2",
    )
    best = o.agg(
        F.min(F.struct("d2", "ax", "ay", "bx", "by")).alias("m")
    )
    return best.where(F.col("m").isNotNull()).select("m.ax", "m.ay", "m.bx", "m.by", "m.d2")


def _closest(pts: DataFrame, seed: int, base_rows: int) -> DataFrame:
    """Closest pair of the distinct points ``pts`` (cheap to read again)."""
    st = pts.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"),
    ).first()
    n = st["n"]
    if n < 2:
        return pts.sparkSession.createDataFrame([], PAIR_SCHEMA)
    if n <= base_rows:
        return pts.repartition(1).mapInPandas(_local, PAIR_SCHEMA)
    sample = pts.sample(withReplacement=False, fraction=n ** (-1.0 / 3.0), seed=seed).checkpoint()
    found = _closest(sample, seed + 1, base_rows).first()
    dx, dy = st["x1"] - st["x0"], st["y1"] - st["y0"]
    # A sample of fewer than two points (all but impossible) bounds nothing:
    # the extent's diagonal does.
    bound = found["d2"] if found is not None else dx * dx + dy * dy
    return _grid_pairs(pts, float(bound), st["x0"], st["y0"], max(dx, dy))


def closest_pair(points: DataFrame, x: str = "x", y: str = "y", seed: int = 42, base_rows: int | None = None) -> DataFrame:
    """``(ax, ay, bx, by, d2)`` for the two distinct points closest together;
    empty with fewer than two distinct points.

    ``base_rows`` (at least 2, by default 1,024) is the largest number of
    points that one task solves on its own; larger sets take the grid join.
    It bounds a task's memory (at most its square in compared pairs) and
    changes no result."""
    spark = points.sparkSession
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    valid = points.where(finite(x, y)).select(F.col(x).alias("x"), F.col(y).alias("y"))
    return _closest(valid.distinct().checkpoint(), seed, max(2, base_rows or BASE_ROWS))
