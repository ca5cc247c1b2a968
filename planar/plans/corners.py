"""Points per box from counts at the boxes' corners.

The points inside a box are a sum over its corners of the points to the left
of and below each.  Such a count has three parts, with the points cut into
strips of about equal size along x and along y: whole strips both ways (a
table of the strips' crossings), the x strip of the corner, and its y strip
left of that.  A point makes two rows and a box four, however many boxes
overlap and whatever their sizes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planar.plans.cells import answer_cells
from planar.plans.session import ship_package

STRIP = 1 << 15      # points of a strip
MOST_STRIPS = 1024   # strips an axis; more points make larger strips
PER_STRIP = 64       # sampled points a strip, for its borders only

BOX = ("xmin", "ymin", "xmax", "ymax")
_IN = ("a", "b", "c", "d")


def _pair(a: np.ndarray, b) -> np.ndarray:
    """Numbers that sort by ``a``, then ``b``."""
    out = np.empty(len(a), complex)
    out.real, out.imag = a, b
    return out


def _cuts(first: np.ndarray, then: np.ndarray, strips: int) -> np.ndarray:
    s = np.sort(_pair(first, then))
    return np.unique(s[np.arange(1, strips) * len(s) // strips]) if len(s) else s


def _strip(cuts: np.ndarray, v: np.ndarray, then=-np.inf) -> np.ndarray:
    return np.searchsorted(cuts, _pair(v, then), side="right")


class Below:
    """Weights of the points with ``a < X`` and ``b < Y``: blocks of powers of
    two of the points by ``a``, each sorted by ``b``."""

    def __init__(self, a: np.ndarray, b: np.ndarray, w: np.ndarray):
        order = np.argsort(a, kind="stable")
        self.a, b, w = a[order], b[order], w[order]
        self.b, n = np.sort(b), len(a)
        rank, at, self.n = np.searchsorted(self.b, b), np.arange(n), n
        self.levels = []
        for bit in range(n.bit_length()):
            keys = (at >> bit) * (n + 1) + rank
            o = np.argsort(keys)
            self.levels.append((keys[o], np.concatenate([[0], np.cumsum(w[o])])))

    def count(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        k, r = np.searchsorted(self.a, x), np.searchsorted(self.b, y)
        out = np.zeros(len(k), np.int64)
        for bit, (keys, total) in enumerate(self.levels):
            i = np.flatnonzero(k >> bit & 1)
            block = (k[i] >> bit) - 1  # the last whole block of the prefix of k rows that this bit stands for
            out[i] += total[np.searchsorted(keys, block * (self.n + 1) + r[i])] - total[block << bit]
        return out


def _columns(batch, names) -> list[np.ndarray]:
    return [batch.column(c).to_numpy() for c in names]


def corner_counts(boxes: DataFrame, points: DataFrame, strip: int | None = None) -> DataFrame:
    """``(xmin, ymin, xmax, ymax, n)``: the points strictly inside each box,
    for the boxes that hold any.  ``boxes``: distinct valid extents;
    ``points``: ``(px, py, w)`` with ``w`` copies each, distinct and finite."""
    spark = boxes.sparkSession
    ship_package(spark)
    points = points.select("px", "py", "w").checkpoint()
    boxes = boxes.select(*BOX).where((F.col("xmin") < F.col("xmax")) & (F.col("ymin") < F.col("ymax"))).checkpoint()
    n = points.count()
    strips = min(MOST_STRIPS, -(-n // (strip or STRIP)) or 1)
    share = min(1.0, PER_STRIP * strips / max(1, n))
    some = points.select("px", "py") if share == 1.0 else points.select("px", "py").sample(share, 1)
    sx, sy = _columns(some.toArrow(), ("px", "py"))
    cx, cy = _cuts(sx, sy, strips), _cuts(sy, sx, strips)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = _columns(batch, ("px", "py"))
            i, j = _strip(cx, x, y), _strip(cy, y, x)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), *batch.columns], names=["i", "j", *batch.schema.names])

    at = points.mapInArrow(place, "i long, j long, px double, py double, w long")
    held = at.select(F.explode(F.array(
        F.struct(F.lit(0).cast("long").alias("cx"), F.col("i").alias("cy"), F.col("px").alias("a"), F.col("py").alias("b"), "w"),
        F.struct(F.lit(1).cast("long").alias("cx"), F.col("j").alias("cy"), F.col("i").cast("double").alias("a"), F.col("py").alias("b"), "w"),
    )).alias("r")).select("r.cx", "r.cy", "r.a", "r.b", F.lit(0.0).alias("c"), F.lit(0.0).alias("d"), "r.w")
    found = at.groupBy("i", "j").agg(F.sum("w").alias("w")).toArrow()  # at most strips^2 rows
    i, j, w = _columns(found, ("i", "j", "w"))
    table = np.zeros((len(cx) + 2, len(cy) + 2), np.int64)  # weights of the strips before i and before j
    table[i + 1, j + 1] = w
    table = spark.sparkContext.broadcast(table.cumsum(0).cumsum(1))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table.value
        for batch in batches:
            xmin, ymin, xmax, ymax = _columns(batch, BOX)
            ix, jy = (_strip(cx, np.nextafter(xmin, np.inf)), _strip(cx, xmax)), (_strip(cy, np.nextafter(ymin, np.inf)), _strip(cy, ymax))
            whole = t[ix[1], jy[1]] - t[ix[0], jy[1]] - t[ix[1], jy[0]] + t[ix[0], jy[0]]
            for kind, strips_of, sign in ((0, ix[0], -1), (0, ix[1], 1), (1, jy[0], -1), (1, jy[1], 1), (2, ix[0], 0)):
                n = len(xmin)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, kind)), pa.array(strips_of), *batch.columns, pa.array(whole if kind == 2 else np.full(n, sign))],
                    names=["cx", "cy", *_IN, "w"],
                )

    asked = boxes.mapInArrow(ask, "cx long, cy long, a double, b double, c double, d double, w long")

    def answer(held, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if held is None:
            return
        (kind,) = batch.column("cx").slice(0, 1).to_pylist()
        xmin, ymin, xmax, ymax, sign = _columns(batch, (*_IN, "w"))
        left, low = np.nextafter(xmin, np.inf), np.nextafter(ymin, np.inf)
        if kind == 0:
            x = np.where(sign > 0, xmax, left)
            n = held.count(x, ymax) - held.count(x, low)
        else:
            y = np.where(sign > 0, ymax, low)
            n = held.count(_strip(cx, xmax), y) - held.count(_strip(cx, left), y)
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in _IN], pa.array(n * sign)], names=[*BOX, "n"])

    out = "xmin double, ymin double, xmax double, ymax double, n long"
    parts = answer_cells(held, asked.where("cx < 2"), ["a"], lambda rows: Below(*_columns(rows, ("a", "b", "w"))), answer, out)
    whole = asked.where("cx = 2").select(*[F.col(a).alias(b) for a, b in zip((*_IN, "w"), (*BOX, "n"))])
    return parts.unionByName(whole).where("n != 0").groupBy(*BOX).agg(F.sum("n").alias("n")).where("n > 0")
