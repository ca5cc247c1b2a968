"""Multi-level grid: 2-D range joins planned as equi-joins.

Spark plans a pure range condition as a nested loop (``CartesianProduct`` or
``BroadcastNestedLoopJoin``).  Adding a cell key turns it into a hash or
sort-merge equi-join with the range test as residual condition.

Cell sides are powers of ``BRANCH`` on an absolute scale, chosen per axis
from a box's own size: on its own level ``(lx, ly)``, with cells of
``BRANCH**lx`` by ``BRANCH**ly``, a box is at most ``SPAN`` cells wide and
high.  Neither the extent nor the other boxes' sizes matter: a far-off box,
large boxes among small ones, and long thin boxes each get cells of their own
size.  A point gets one cell on each level that holds boxes, so levels with
few boxes are given up where that costs less than the copies it saves: their
boxes move to a coarser level or to one that is a step finer.  What it costs
follows from sums over the boxes of a level (see ``choose_levels``).  A box
and a point inside it meet in exactly one cell: no duplicates, no
``distinct`` afterwards.

All of that comes from one grouped aggregation over the box side (a row per
own level).  When its row count and widest row prove the exploded box side
small, it is broadcast and the point side is never shuffled; otherwise both
sides are hash-partitioned on the cell (AQE splits hot cells), and a point is
copied only to levels where a filter of the cells that hold boxes lets it
through, so that points without a box leave no row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from planar.plans.blocks import deal, meets, point_blocks
from planar.plans.session import conf_bytes, ship_package

BRANCH = 4          # cell side factor between levels (power of two: exact scaling)
SPAN = 2            # a box is at most SPAN cells wide on its level
FINER = 1           # a box may live this many levels below its own, per axis
MAX_LEVELS = 256    # most levels on which points look for boxes
PAIR_LEVELS = 24    # most levels of a box-box join
MOST_PLACES = 4096  # entries of the table from own levels to levels
HUGE = 1e290
COPY_COST = 4.0     # a point's copy against one comparison
TRIM = 0.05         # share of the boxes at either end that may lie far off
FAR = 3.0           # times the others' spread that they count for
PLACES = [(i + 0.5) / 20 for i in range(20)]  # quantiles of a level's boxes that tell where they lie
BLOCK_OVERLAP = 256.0  # boxes over a place from which points go in blocks where pairs are the result
BLOCK_COPIES = 32.0  # times as much a copy costs then
FILTER_LEVELS = 4   # levels from which the filter of occupied cells pays
FILTER_BITS = 27    # its most bits: 16 MB

BROADCAST_CONF = "spark.planar.broadcastBytes"
DEFAULT_BROADCAST = 32 << 20


@dataclass(frozen=True)
class Grid:
    """``levels``: levels on which points look for boxes; ``home``: the level
    of each own level's boxes; ``low``: the finest own level of each axis
    (boxes of size zero have it); ``cells``: bound of the box cells; ``overlap``: boxes over a
    place of the extent, added up over the own levels' extents.  For
    box-box joins ``pair_low``, ``step`` and ``pair_levels``: the finest level
    of each axis, the step between levels, the levels.  Then the extent, rows of each planned side, the widest of all rows
    and ``crowd``: boxes over a place of the area where nearly all of them lie, however far off the others are.
    ``own`` and ``extent``: what levels are chosen by."""

    x0: float
    y0: float
    x1: float
    y1: float
    low: tuple[int, int]
    pair_low: tuple[int, int]
    step: tuple[int, int]
    pair_levels: tuple[tuple[int, int], ...]
    levels: tuple[tuple[int, int], ...]
    home: dict[tuple[int, int], tuple[int, int]] = field(hash=False)
    cells: int
    overlap: float
    counts: tuple[int, ...]
    row_bytes: int = 64
    crowd: float = 0.0
    own: dict[tuple[int, int], np.ndarray] = field(default_factory=dict, compare=False)
    extent: float = 0.0

    def for_blocks(self) -> Grid:
        """The plan with fewer and coarser levels, for points in blocks: most
        pairs of a cell that lie apart are then not compared."""
        home, cells = choose_levels(self.own, self.extent, COPY_COST * BLOCK_COPIES)
        return replace(self, levels=tuple(sorted(set(home.values()))), home=home, cells=cells)

    def inside(self, x: Column, y: Column) -> Column:
        return (x >= F.lit(self.x0)) & (x <= F.lit(self.x1)) & (y >= F.lit(self.y0)) & (y <= F.lit(self.y1))

    def pair_level_of(self, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> tuple[Column, Column]:
        return (
            _level(xmax - xmin, self.pair_low[0], self.step[0]),
            _level(ymax - ymin, self.pair_low[1], self.step[1]),
        )

    def with_level(self, df: DataFrame, xmin: Column, ymin: Column, xmax: Column, ymax: Column, name: str) -> DataFrame:
        """``df`` with the place in ``levels`` of each planned box's level."""
        at = {lv: i for i, lv in enumerate(self.levels)}
        x0, y0 = (min(k[i] for k in self.home) for i in (0, 1))
        nx, ny = (max(k[i] for k in self.home) - v + 1 for i, v in ((0, x0), (1, y0)))
        # Own levels as columns of their own, so that each is worked out once.
        df = df.withColumns({
            "_ox": _level(xmax - xmin, self.low[0], 1) - F.lit(x0), "_oy": _level(ymax - ymin, self.low[1], 1) - F.lit(y0),
        })
        place = F.col("_ox") * ny + F.col("_oy")
        home = {(lx - x0) * ny + ly - y0: at[lv] for (lx, ly), lv in self.home.items()}
        if nx * ny <= MOST_PLACES:
            level = F.get(F.array(*[F.lit(home.get(i, -1)) for i in range(nx * ny)]), place)
        else:
            level = F.element_at(F.create_map(*[F.lit(v) for kv in home.items() for v in kv]), place)
        return df.withColumn(name, level).drop("_ox", "_oy")

    def _pick(self, axis: int, place: Column) -> Column:
        return F.get(F.array(*[F.lit(lv[axis]) for lv in self.levels]), place)

    def point_cells(self, df: DataFrame, x: str, y: str, prefix: str = "_p", occupied: Occupied | None = None) -> DataFrame:
        """One row per (point, level) with ``{prefix}l, {prefix}x, {prefix}y``
        keys; with ``occupied`` only where the filter finds the cell.  Points
        outside the boxes' extent are dropped (they can meet no box)."""
        X, Y = F.col(x), F.col(y)
        df = df.where(self.inside(X, Y))
        if occupied is not None:
            place = f"{prefix}l"
            df = df.withColumn(place, F.explode(occupied.levels_of(X, Y)))
            lx, ly = self._pick(0, F.col(place)), self._pick(1, F.col(place))
            return df.withColumns({f"{prefix}x": _cell(X, lx), f"{prefix}y": _cell(Y, ly)})
        keys = [
            F.struct(F.lit(i).alias(f"{prefix}l"), _cell(X, lx).alias(f"{prefix}x"), _cell(Y, ly).alias(f"{prefix}y"))
            for i, (lx, ly) in enumerate(self.levels)
        ]
        return df.select("*", F.inline(F.array(*keys)))

    def box_cells(self, df: DataFrame, xmin: str, ymin: str, xmax: str, ymax: str, prefix: str = "_b") -> DataFrame:
        """One row per (box, covered cell) on the box's level."""
        kl, kx, ky = (f"{prefix}{c}" for c in "lxy")
        a, b, c, d = F.col(xmin), F.col(ymin), F.col(xmax), F.col(ymax)
        df = self.with_level(df, a, b, c, d, kl)
        lx, ly = self._pick(0, F.col(kl)), self._pick(1, F.col(kl))
        df = df.withColumn(kx, F.explode(F.sequence(_cell(a, lx), _cell(c, lx))))
        return df.withColumn(ky, F.explode(F.sequence(_cell(b, ly), _cell(d, ly))))

    def pair_cells(self, df: DataFrame, xmin: str, ymin: str, xmax: str, ymax: str, prefix: str = "_b") -> DataFrame:
        """One row per (box, covered cell) on the box's own level and every
        combination of coarser levels of the two axes (a pair meets on the
        coarser level of both, per axis); its own is kept in ``{prefix}n`` and
        ``{prefix}o``."""
        kl, km, kx, ky, kn, ko = (f"{prefix}{c}" for c in "lmxyno")
        a, b, c, d = F.col(xmin), F.col(ymin), F.col(xmax), F.col(ymax)
        lx, ly = self.pair_level_of(a, b, c, d)
        axes = [sorted({lv[k] for lv in self.pair_levels} | {self.pair_low[k]}) for k in (0, 1)]
        df = df.withColumns({kn: lx, ko: ly})
        for col, own, present in ((kl, kn, axes[0]), (km, ko, axes[1])):
            df = df.withColumn(col, F.explode(_at_least(present, F.col(own))))
        df = df.withColumn(kx, F.explode(F.sequence(_cell(a, F.col(kl)), _cell(c, F.col(kl)))))
        return df.withColumn(ky, F.explode(F.sequence(_cell(b, F.col(km)), _cell(d, F.col(km)))))


def _hash_cells(level, cx, cy) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = cx.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + cy.astype(np.int64).view(np.uint64)
        h = h * np.uint64(0xBF58476D1CE4E5B9) + np.asarray(level).astype(np.uint64) * np.uint64(0x94D049BB133111EB)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


class Occupied:
    """Filter of the cells that hold boxes: a bit table with eight bits per
    cell or more.  It may let an empty cell through, never refuses one that
    holds a box."""

    def __init__(self, grid: Grid, cells: DataFrame, bits: int, prefix: str = "_b"):
        ship_package(cells.sparkSession)
        self.bits, self.sides = bits, [(float(BRANCH) ** lx, float(BRANCH) ** ly) for lx, ly in grid.levels]
        top = 64 - bits

        @F.pandas_udf("long")
        def place(level: pd.Series, cx: pd.Series, cy: pd.Series) -> pd.Series:
            return pd.Series((_hash_cells(level.to_numpy(), cx.to_numpy(), cy.to_numpy()) >> np.uint64(top)).astype(np.int64))

        words = (
            cells.select(place(f"{prefix}l", f"{prefix}x", f"{prefix}y").alias("p"))
            .groupBy(F.expr("cast(shiftright(p, 6) as int)").alias("w"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("b"))
            .toArrow()  # at most 2^(bits - 6) rows
        )
        table = np.zeros(1 << (bits - 6), np.int64)
        table[words["w"].to_numpy()] = words["b"].to_numpy()
        self.table = cells.sparkSession.sparkContext.broadcast(table.view(np.uint64))

    def levels_of(self, x: Column, y: Column) -> Column:
        sides, top, table = self.sides, np.uint64(64 - self.bits), self.table

        @F.pandas_udf("array<int>")
        def held(px: pd.Series, py: pd.Series) -> pd.Series:
            vx, vy, bits = px.to_numpy(), py.to_numpy(), table.value
            hit = np.zeros((len(vx), len(sides)), bool)
            for i, (sx, sy) in enumerate(sides):
                p = _hash_cells(i, np.floor(vx / sx), np.floor(vy / sy)) >> top
                hit[:, i] = (bits[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
            row, level = np.nonzero(hit)
            return pd.Series(np.split(level.astype(np.int32), np.searchsorted(row, np.arange(1, len(vx)))) if len(vx) else [])

        return held(x, y)


def _at_least(levels: list[int], own: Column) -> Column:
    return F.filter(F.array(*map(F.lit, levels)), lambda v: v >= own)


def _cell(v: Column, level: Column | int) -> Column:
    """Cell index; the side is a power of two, so the division is exact."""
    return F.floor(v / F.pow(F.lit(float(BRANCH)), F.lit(level) if isinstance(level, int) else level))


def _level(size: Column, low: int, step: int) -> Column:
    """Finest level (a multiple of ``step``, not below ``low``) on which
    ``size`` spans at most ``SPAN`` cells; rounding of the logarithm can only
    add a cell or pick the next level."""
    up = F.ceil(F.least(F.log2(size / F.lit(float(SPAN))), F.lit(1024.0)) / F.lit(math.log2(BRANCH) * step)) * F.lit(step)
    return F.when(size > 0, F.greatest(up, F.lit(low))).otherwise(F.lit(low)).cast("int")


def _round_up(level: int, step: int) -> int:
    return -(-level // step) * step


def _width(df: DataFrame, skip: set[str]) -> Column:
    """Bytes of a row's columns: 8 for a fixed-width one, the length in bytes
    of a string or binary, the text form of anything nested."""
    total = F.lit(0)
    for f in df.schema.fields:
        if f.name in skip or not isinstance(f.dataType, (StringType, BinaryType, ArrayType, MapType, StructType)):
            total = total + F.lit(8)
        else:
            c = F.col(f"`{f.name}`")
            text = c if isinstance(f.dataType, (StringType, BinaryType)) else F.to_json(c)
            total = total + F.lit(8) + F.coalesce(F.octet_length(text), F.lit(0))
    return total


def plan_grid(*sides: tuple[DataFrame, str, str, str, str]) -> Grid | None:
    """Size a grid for the union of the given box sides.

    Each side is ``(df, xmin, ymin, xmax, ymax)`` of valid, normalised boxes
    (points are boxes of size zero).  Returns ``None`` when all are empty.

    One aggregation grouped by level yields everything: it combines map-side,
    finishes in parallel, and returns a row per level (levels follow the
    exponents of doubles, so their number is bounded whatever the input).
    """
    u = None
    for i, (df, a, b, c, d) in enumerate(sides):
        part = df.select(
            F.lit(i).alias("_s"), *[F.col(v).cast("double").alias(n) for v, n in ((a, "_a"), (b, "_b"), (c, "_c"), (d, "_d"))],
            _width(df, {a, b, c, d}).alias("_w"),
        )
        u = part if u is None else u.unionByName(part)
    w, h = F.col("_c") - F.col("_a"), F.col("_d") - F.col("_b")
    # Levels of positive sizes; null for size zero.
    raw = lambda v: F.when(v > 0, _level(v, -1000, 1))
    found = (
        u.groupBy(raw(w).alias("lx"), raw(h).alias("ly"))
        .agg(
            F.min("_a").alias("x0"), F.min("_b").alias("y0"), F.max("_c").alias("x1"), F.max("_d").alias("y1"),
            F.max("_w").alias("w"), F.sum(w).alias("sw"), F.sum(h).alias("sh"), F.sum(w * h).alias("swh"),
            *[F.percentile_approx(lo / 2 + hi / 2, PLACES, 1000).alias(n) for lo, hi, n in ((F.col("_a"), F.col("_c"), "qx"), (F.col("_b"), F.col("_d"), "qy"))],
            *[F.count_if(F.col("_s") == i).alias(f"n{i}") for i in range(len(sides))],
        )
        .collect()
    )
    if not found:
        return None
    box = [min(r["x0"] for r in found), min(r["y0"] for r in found), max(r["x1"] for r in found), max(r["y1"] for r in found)]
    counts = tuple(sum(r[f"n{i}"] for r in found) for i in range(len(sides)))
    low, step = [], [1, 1]
    for k, name in enumerate(("lx", "ly")):
        seen = [r[name] for r in found if r[name] is not None]
        reach = max(abs(box[k]), abs(box[k + 2]))
        # Indices stay below 2**50: doubles and longs hold them exactly.
        safe = math.ceil(math.log(reach, BRANCH)) - 25 if reach > 0 else -500
        # Sizes of zero only: about one box per cell if they were spread out.
        spread = box[k + 2] - box[k]
        even = math.ceil(math.log(spread / max(1, sum(counts)), BRANCH)) if spread > 0 else safe
        low.append(max(safe, min(seen) if seen else even, -500))

    def rounded() -> set[tuple[int, int]]:
        out = set()
        for r in found:
            out.add(tuple(
                max(_round_up(low[k], step[k]), _round_up(r[n], step[k])) if r[n] is not None else _round_up(low[k], step[k])
                for k, n in enumerate(("lx", "ly"))
            ))
        return out

    own: dict[tuple[int, int], np.ndarray] = {}
    for r in found:
        k = tuple(max(low[i], r[n]) if r[n] is not None else low[i] for i, n in enumerate(("lx", "ly")))
        n = sum(r[f"n{i}"] for i in range(len(sides)))
        own[k] = own.get(k, 0) + np.array([n, r["sw"], r["sh"], r["swh"]], float)
    spreads = ((r["swh"], (r["x1"] - r["x0"]) * (r["y1"] - r["y0"])) for r in found)
    overlap = sum(area / spread for area, spread in spreads if 0 < spread < math.inf)
    n = [sum(r[f"n{i}"] for i in range(len(sides))) for r in found]
    wide, high = (_spread([r[c] for r in found], n, box[k + 2] - box[k]) for k, c in enumerate(("qx", "qy")))
    home, cells = choose_levels(own, wide * high)
    crowd = sum(min(r["swh"] / (wide * high), k) for r, k in zip(found, n)) if 0 < wide * high < math.inf else 0.0
    pairs = rounded()
    while len(pairs) > max(4, PAIR_LEVELS):  # steps wide enough leave two per axis
        k = 0 if len({lv[0] for lv in pairs}) >= len({lv[1] for lv in pairs}) else 1
        step[k] *= 2
        pairs = rounded()
    pair_low = tuple(_round_up(v, s) for v, s in zip(low, step))
    return Grid(
        *map(float, box), tuple(low), pair_low, tuple(step), tuple(sorted(pairs)), tuple(sorted(set(home.values()))), home, cells, overlap, counts,
        max(r["w"] for r in found), crowd, own, wide * high,
    )


def _spread(places: list[list[float]], n: list[int], most: float) -> float:
    """How far the boxes spread along an axis, from quantiles of each level's
    ``n`` boxes: ``most``, or ``FAR`` times the spread without ``TRIM`` of them
    at either end where that is less (a few far-off boxes then count for
    little); ``most`` where it is nothing."""
    v, share = np.concatenate(places), np.repeat(np.array(n, float) / len(PLACES), [len(p) for p in places])
    order = np.argsort(v)
    v, below = v[order], np.cumsum(share[order]) - share[order] / 2
    lo, hi = np.interp([TRIM * sum(n), (1 - TRIM) * sum(n)], below, v)
    return min(FAR * (hi - lo), most) if hi > lo else most


def choose_levels(own: dict, extent: float, copy_cost: float | None = None) -> tuple[dict, int]:
    """The level on which the boxes of each own level live, and a bound of
    their cells.  ``extent``: the area over which nearly all boxes spread.

    ``own``: per own level the number of boxes and the sums of widths,
    heights and areas.  A box of ``w`` by ``h`` on cells of ``a`` by ``b`` is
    compared with the points of about ``(w + a) * (h + b)``, so comparisons,
    as areas of points, follow from the sums exactly.  Points are copied to
    each level over the extent or the area that all boxes compare, whichever
    is less (a copy costs ``copy_cost`` comparisons, ``COPY_COST`` if not given); a box's cells count as
    copies too, for as many points as boxes.  Levels are given up one by one,
    best first, while that lowers the sum or more than ``MAX_LEVELS`` are
    left."""
    copy_cost = COPY_COST if copy_cost is None else copy_cost
    keys = sorted(own)
    stats = np.array([own[k] for k in keys])
    top = (max(k[0] for k in keys), max(k[1] for k in keys))
    levels = sorted({*keys, top})
    side = np.array([[float(BRANCH) ** v for v in lv] for lv in levels])
    n, sw, sh, swh = (stats[:, i : i + 1] for i in range(4))
    a, b = side[:, 0], side[:, 1]
    rows = np.arange(len(keys))
    with np.errstate(all="ignore"):
        area = np.nan_to_num(swh + sw * b + sh * a + n * a * b, nan=HUGE, posinf=HUGE)
        wide, high, both = (np.nan_to_num(v, nan=HUGE, posinf=HUGE) for v in (sw / a, sh / b, swh / (a * b)))
        cells = both + wide + high + n
        most = np.minimum(both + 2 * (wide + high) + 4 * n, n * (SPAN * BRANCH**FINER + 1) ** 2)  # no box covers more
        reach = area[rows, [levels.index(k) for k in keys]].sum()
        covered = min(extent, reach) if extent > 0 else reach
        cost = np.minimum(area + copy_cost * covered / n.sum() * cells, HUGE)
    cost[[[k[0] - lv[0] > FINER or k[1] - lv[1] > FINER for lv in levels] for k in keys]] = np.inf
    left, last = np.ones(len(levels), bool), levels.index(top)
    while True:
        masked = np.where(left, cost, np.inf)
        best = masked.argmin(axis=1)
        held = np.bincount(best, minlength=len(levels)) > 0
        left = held | (np.arange(len(levels)) == last)  # no box gains by an empty level
        first = masked[rows, best]
        masked = np.where(left, cost, np.inf)
        masked[rows, best] = np.inf
        second = masked.min(axis=1)
        # What a level's boxes cost more elsewhere, against a copy of the points.
        change = np.bincount(best, np.minimum(second, 2 * HUGE) - first, len(levels)) - copy_cost * covered
        change += copy_cost * covered * (not held[last]) * (np.bincount(best, masked.argmin(axis=1) == last, len(levels)) > 0)
        change[~held | (np.bincount(best, ~np.isfinite(second), len(levels)) > 0)] = np.inf
        change[last] = np.inf
        k = int(change.argmin())
        if not np.isfinite(change[k]) or (change[k] > 0 and held.sum() <= MAX_LEVELS):
            break
        left[k] = False
    return {k: levels[i] for k, i in zip(keys, best)}, int(most[rows, best].sum()) + 1


def _empty(a: DataFrame, b: DataFrame) -> DataFrame:
    """No rows, with the columns of ``a`` followed by those of ``b``."""
    schema = StructType(list(a.schema.fields) + list(b.schema.fields))
    return a.sparkSession.createDataFrame([], schema)


def _max_broadcast(spark) -> int:
    return conf_bytes(spark, BROADCAST_CONF, DEFAULT_BROADCAST)


def fits_broadcast(df: DataFrame, rows_bound: int, row_bytes: int) -> bool:
    """Whether ``rows_bound`` rows of at most ``row_bytes`` bytes (plus the
    cell key and row overhead) fit the broadcast budget."""
    limit = _max_broadcast(df.sparkSession)
    return limit > 0 and rows_bound * (row_bytes + 64) <= limit


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, to be joined by a shuffle.  Spark estimates a side by the size
    of its file and would broadcast a small file's rows however many cells
    each of them makes."""
    return df.hint("merge")


HELPERS = ["_bl", "_bx", "_by", "_pl", "_px", "_py"]


def box_point_join(
    boxes: DataFrame,
    points: DataFrame,
    residual: Column,
    box: tuple[str, str, str, str] = ("xmin", "ymin", "xmax", "ymax"),
    point: tuple[str, str] = ("px", "py"),
    how: str = "inner",
    grid: Grid | None = None,
    blocks: bool = False,
) -> DataFrame:
    """Join boxes with points under ``residual`` (which must imply the point
    lies in the closed box).

    ``boxes`` and ``points`` must have disjoint column names.  ``how`` is
    ``inner`` (box columns + point columns) or ``left_anti`` (points with no
    matching box; ``points`` must be distinct rows).  ``grid``: a plan for
    ``boxes`` or a set that holds them.  ``blocks``: points may go in blocks
    (``plans/blocks.py``), which pays where the pairs themselves are the
    result; not for streams, as they are sorted and counted.
    """
    if grid is None:
        grid = plan_grid((boxes, *box))
    if grid is None:
        if how == "left_anti":
            return points
        return _empty(boxes, points)
    small = fits_broadcast(boxes, grid.cells, grid.row_bytes)
    blocks = blocks and not small and grid.crowd >= BLOCK_OVERLAP
    if blocks:
        grid = grid.for_blocks()
    bc = cells = grid.box_cells(boxes, *box, prefix="_b")
    keys = (F.col("_bl") == F.col("_pl")) & (F.col("_bx") == F.col("_px")) & (F.col("_by") == F.col("_py"))
    occupied = None
    if small:
        bc = F.broadcast(bc)
    else:
        bits = max(12, (8 * grid.cells).bit_length())
        if len(grid.levels) >= FILTER_LEVELS and bits <= FILTER_BITS:
            occupied = Occupied(grid, bc, bits)
        bc = shuffled(bc)
    pc = grid.point_cells(points, *point, prefix="_p", occupied=occupied)
    if blocks:
        sides = tuple(F.pow(F.lit(float(BRANCH)), grid._pick(i, F.col("_pl"))) for i in (0, 1))
        held = point_blocks(pc, point, HELPERS[3:], sides)
        held, bc = deal(held, cells, pc, HELPERS[3:], HELPERS[:3])
        met = held.join(shuffled(bc), keys & (F.col("_pn") == F.col("_bn")) & meets(*box))
        return met.select(*boxes.columns, F.inline("_points")).where(residual).select(*points.columns, *boxes.columns)
    if how == "inner":
        return pc.join(bc, keys & residual, "inner").drop(*HELPERS)
    if how == "left_anti":
        # A point has a copy per level: those that match on any level first,
        # then one join takes them out, however many levels there are.
        hit = pc.join(bc, keys & residual, "left_semi").select(*points.columns).distinct()
        return points.join(shuffled(hit), list(points.columns), "left_anti")
    raise ValueError(f"unsupported join type {how!r}")


def box_box_join(
    a: DataFrame,
    b: DataFrame,
    residual: Column,
    ref_x: Column,
    ref_y: Column,
    abox: tuple[str, str, str, str],
    bbox: tuple[str, str, str, str],
    grid: Grid | None = None,
) -> DataFrame:
    """Inner join of two box sets under ``residual``, which must imply the
    closed boxes intersect.

    ``ref_x, ref_y`` name one point of the intersection (e.g. its lower left
    corner); the pair is kept only in the cell holding it, on the coarser of
    the two boxes' levels (per axis), so each pair is produced once.
    """
    if grid is None:
        grid = plan_grid((a, *abox), (b, *bbox))
    if grid is None:
        return _empty(a, b)
    ac = grid.pair_cells(a, *abox, prefix="_a")
    bc = grid.pair_cells(b, *bbox, prefix="_b")
    same = F.lit(True)
    for k in "lmxy":
        same = same & (F.col(f"_a{k}") == F.col(f"_b{k}"))
    cond = (
        same
        & (F.col("_al") == F.greatest("_an", "_bn")) & (F.col("_am") == F.greatest("_ao", "_bo"))
        & residual
        & (_cell(ref_x, F.col("_al")) == F.col("_ax")) & (_cell(ref_y, F.col("_am")) == F.col("_ay"))
    )
    return ac.join(shuffled(bc), cond, "inner").drop(*[f"_{s}{k}" for s in "ab" for k in "lmxyno"])
