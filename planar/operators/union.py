"""Vertices of the outline of a union of boxes.

Whether a point is a corner of the union is decided by the four quadrants
around it, so by the boxes near it alone.  Plan:

1. Valid boxes of positive area, distinct, written once to the checkpoint
   folder.
2. Boxes are dealt to the square cells that they touch.  A cell that some box
   covers has no corner in it and goes, with every box's row in it, as does
   one without a vertical or a horizontal edge: boxes inside others and the
   inside of dense heaps leave here.  A cell with more than ``CELL_WORK``
   pairs of edges is cut into ``BRANCH`` by ``BRANCH`` cells, round by round;
   what is left follows the outline.
3. Each remaining cell is swept on its own: its boxes' edges cut it into
   slabs, the depth of cover of every slab is a running sum, and corners are
   the crossings with one or three covered quadrants, or two diagonal ones.
   A point belongs to one cell, so the corners are distinct.

The output is the set of corner coordinates, unordered.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planar.functions.geometry import normalize_boxes
from planar.plans.grid import BRANCH, shuffled
from planar.plans.session import ensure_checkpoint_dir, ship_package

CELL_WORK = 1 << 20  # pairs of a vertical and a horizontal edge that one sweep takes
MOST_DEPTH = 24      # cuts of a cell
ROWS_PER_BOX = 2     # expected rows of a box in the first round
SWEEP = 1 << 22      # entries of the sweep's depth table held at a time

_BOX = ("xmin", "ymin", "xmax", "ymax")
_CELL = ("depth", "cx", "cy")


# --- one cell ------------------------------------------------------------------
def _axis(lo: np.ndarray, hi: np.ndarray, c0: float, c1: float):
    """Edges within the half-open cell, and per box the slabs between them
    that it covers, ``a .. b - 1`` (slab i ends at edge i)."""
    both = np.concatenate([lo, hi])
    edges = np.unique(both[(both >= c0) & (both < c1)])
    a = np.where(lo < c0, 0, np.searchsorted(edges, lo) + 1)
    b = np.where(hi >= c1, len(edges) + 1, np.searchsorted(edges, hi) + 1)
    return edges, a, b


def cell_corners(boxes: np.ndarray, x0: float, y0: float, x1: float, y1: float) -> tuple[np.ndarray, np.ndarray]:
    """Corners of the union within ``[x0, x1) x [y0, y1)``, from all boxes
    ``(xmin, ymin, xmax, ymax)`` that touch it."""
    X, a, b = _axis(boxes[:, 0], boxes[:, 2], x0, x1)
    Y, c, d = _axis(boxes[:, 1], boxes[:, 3], y0, y1)
    out_x, out_y = [], []
    if len(X) and len(Y):
        width = len(Y) + 2
        step = max(2, SWEEP // width)
        carry = np.zeros(width, np.int32)  # what the slabs before the chunk add up to
        last = None
        for s in range(0, len(X) + 1, step):
            n = min(step, len(X) + 1 - s)
            depth = np.zeros((n, width), np.int32)
            for at, sign in ((a, 1), (b, -1)):
                here = (at >= s) & (at < s + n)
                np.add.at(depth, (at[here] - s, c[here]), sign)
                np.add.at(depth, (at[here] - s, d[here]), -sign)
            depth[0] += carry
            np.cumsum(depth, axis=0, out=depth)
            carry = depth[-1].copy()
            covered = np.cumsum(depth, axis=1)[:, :-1] > 0
            first = s
            if last is not None:
                covered, first = np.vstack([last, covered]), s - 1
            last = covered[-1]
            west, east = covered[:-1], covered[1:]
            sw, nw, se, ne = west[:, :-1], west[:, 1:], east[:, :-1], east[:, 1:]
            k = sw.astype(np.int8) + nw + se + ne
            i, j = np.nonzero((k == 1) | (k == 3) | ((k == 2) & (sw == ne)))
            out_x.append(X[first + i])
            out_y.append(Y[j])
    return (np.concatenate(out_x), np.concatenate(out_y)) if out_x else (np.zeros(0), np.zeros(0))


def _sweep(level: int):
    """Corners of each cell from rows sorted by cell."""

    def corners(key, boxes: np.ndarray):
        depth, cx, cy = key
        side = float(BRANCH) ** (level - depth)
        return cell_corners(boxes, cx * side, cy * side, (cx + 1) * side, (cy + 1) * side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []  # the cell that may go on in the next batch
        for batch in batches:
            if batch.num_rows == 0:
                continue
            cells = np.column_stack([batch.column(i).to_numpy() for i in range(3)])
            boxes = np.column_stack([batch.column(i).to_numpy() for i in range(3, 7)])
            cuts = np.flatnonzero((cells[1:] != cells[:-1]).any(axis=1)) + 1
            xs, ys = [], []
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(cells)]):
                now = tuple(cells[s].tolist())
                if now != key:
                    if key is not None:
                        x, y = corners(key, np.concatenate(held))
                        xs.append(x)
                        ys.append(y)
                    key, held = now, []
                held.append(boxes[s:e])
            if xs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(xs)), pa.array(np.concatenate(ys))], names=["x", "y"])
        if key is not None:
            x, y = corners(key, np.concatenate(held))
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"])

    return run


# --- cells ---------------------------------------------------------------------
def _first_level(r: DataFrame) -> int | None:
    """The finest level on which boxes make ``ROWS_PER_BOX`` rows on average
    (a box of w by h about (w / c + 1) * (h / c + 1)); None without boxes."""
    w, h = F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")
    st = r.agg(
        F.count(F.lit(1)).alias("n"), F.sum(w).alias("w"), F.sum(h).alias("h"), F.max(w).alias("mw"), F.max(h).alias("mh"),
        F.max(F.greatest(*[F.abs(F.col(c)) for c in _BOX])).alias("reach"), F.sum((w / 1e150) * (h / 1e150)).alias("wh"),
    ).first()
    n = st["n"]
    if n == 0:
        return None
    # Cell numbers stay below 2**50: doubles and longs hold them exactly.
    low = max(math.ceil(math.log(st["reach"], BRANCH)) - 25, -500)
    high = max(low, math.ceil(math.log(max(st["mw"], st["mh"]), BRANCH)) + 1)

    def rows(level: int) -> float:
        c = float(BRANCH) ** level
        return (st["wh"] * (1e150 / c) * (1e150 / c)) / n + (st["w"] / c + st["h"] / c) / n + 1

    lo, hi = low, high
    while lo < hi:  # fewer rows on coarser levels
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if rows(mid) <= ROWS_PER_BOX else (mid + 1, hi)
    return lo


def _number(v: Column, side: float) -> Column:
    return F.floor(v / F.lit(side))


def outline_cells(r: DataFrame, level: int, most: float | None = None) -> DataFrame:
    """``(depth, cx, cy, box)`` for the cells that may hold corners: no box
    covers them, and edges of both directions run through them.  A cell of
    more than ``most`` pairs of edges (``CELL_WORK``) is cut again unless that
    did not halve them (many boxes may share a corner, or a line)."""
    most = float(most or CELL_WORK)
    xmin, ymin, xmax, ymax = (F.col(c) for c in _BOX)
    cx, cy = F.col("cx"), F.col("cy")
    side = float(BRANCH) ** level
    rows = (
        r.withColumn("cx", F.explode(F.sequence(_number(xmin, side), _number(xmax, side))))
        .withColumn("cy", F.explode(F.sequence(_number(ymin, side), _number(ymax, side))))
        .withColumn("was", F.lit(math.inf))
    )
    out, deepest = None, min(MOST_DEPTH, max(0, level + 500))
    for depth in range(deepest + 1):
        side = float(BRANCH) ** (level - depth)
        x0, x1, y0, y1 = cx * side, (cx + 1) * side, cy * side, (cy + 1) * side
        covers = (xmin < x0) & (x1 <= xmax) & (ymin < y0) & (y1 <= ymax)
        edges = lambda lo, hi, a, b: F.count_if(lo >= a) + F.count_if(hi < b)  # noqa: E731 - every box touches the cell
        cells = rows.groupBy("cx", "cy").agg(
            F.bool_or(covers).alias("covered"), (edges(xmin, xmax, x0, x1) * edges(ymin, ymax, y0, y1)).cast("double").alias("work")
        )
        rows = rows.join(shuffled(cells.where(~F.col("covered") & (F.col("work") > 0)).drop("covered")), ["cx", "cy"]).checkpoint()
        deep = (F.col("work") > most) & (F.col("work") <= F.col("was") / 2) if depth < deepest else F.lit(False)
        few = rows.where(~deep).select(F.lit(depth).cast("long").alias("depth"), "cx", "cy", *_BOX)
        out = few if out is None else out.unionByName(few)
        rows = rows.where(deep).withColumn("was", F.col("work")).drop("work")
        if rows.isEmpty():
            break
        step = F.sequence(F.lit(0), F.lit(BRANCH - 1))
        half = float(BRANCH) ** (level - depth - 1)
        rows = (
            rows.withColumn("i", F.explode(step)).withColumn("cx", cx * BRANCH + F.col("i")).drop("i")
            .where((xmax >= cx * half) & (xmin < (cx + 1) * half))
            .withColumn("j", F.explode(step)).withColumn("cy", cy * BRANCH + F.col("j")).drop("j")
            .where((ymax >= cy * half) & (ymin < (cy + 1) * half))
        )
    return out


def box_union_vertices(
    boxes: DataFrame, corners: tuple[str, str, str, str] = ("x1", "y1", "x2", "y2"), snap_scale: float | None = None
) -> DataFrame:
    """``(x, y)`` of the corners of the union's outline, distinct.

    With ``snap_scale`` corners are first rounded to multiples of
    ``1 / snap_scale``; by default coordinates are taken as they are."""
    spark = boxes.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    if snap_scale is not None:
        boxes = boxes.select(*[(F.round(F.col(c) * F.lit(float(snap_scale))) / F.lit(float(snap_scale))).alias(c) for c in corners])
    r = (
        normalize_boxes(boxes, *corners)
        .where((F.col("xmin") < F.col("xmax")) & (F.col("ymin") < F.col("ymax")))
        .select(*_BOX)
        .distinct()
        .checkpoint()
    )
    level = _first_level(r)
    if level is None:
        return r.select(F.col("xmin").alias("x"), F.col("ymin").alias("y")).where(F.lit(False))
    cells = outline_cells(r, level).select(*_CELL, *_BOX)
    return cells.repartition(*_CELL).sortWithinPartitions(*_CELL).mapInArrow(_sweep(level), "x double, y double")
