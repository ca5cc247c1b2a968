"""Convex hull of a candidate set that one task should not hold, arc by arc.

1. Extreme points: the exact ends of the x range and the farthest point in
   each of many directions, by a plain aggregate.  Their own hull, a polygon
   of input points, is the frame; every candidate inside it is no vertex.
2. A candidate outside belongs to the arc of the frame's edge below (above)
   it, that is to an x range of the upper (lower) chain.  Arcs with more than
   ``base_rows`` candidates are split at their farthest point, round by
   round, until none is left.
3. Each arc's chain is one group.  A corner of the frame is a hull vertex
   unless rounding picked a neighbour of the farthest point: the exact turn
   at every corner is checked against the vertices beside it, and corners
   that fail are given up and their arcs joined.  Locally convex everywhere
   is convex, so what is left is the exact hull.
4. A vertex's rank in its chain is its place in its arc plus the arcs before:
   a table of one row per arc.

The pair queries read the ranked chains in blocks of ``base_rows`` ranks.
The driver holds rows per arc and per block, never vertices.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planar.operators.closest import _grid_pairs
from planar.operators.exact import turn, turn_signs
from planar.operators.kernels import PAIR_SCHEMA, best_pair, oriented_pairs

UPPER, LOWER = 0, 1
LEAST_DIRECTIONS, MOST_DIRECTIONS = 64, 1024
MOST_ROUNDS = 200  # each round halves an arc at its farthest point
WIDE = 1e-14  # relative slack of slopes, well above their rounding

Chains = Callable[[np.ndarray, np.ndarray], tuple]


# --- frame -------------------------------------------------------------------
def _ends(c: DataFrame):
    """Extent and the exact ends of the two chains."""
    x, y = F.col("x"), F.col("y")
    return c.agg(
        F.max(F.struct((-x).alias("k"), y.alias("x"))).alias("ul"), F.max(F.struct((-x).alias("k"), (-y).alias("x"))).alias("ll"),
        F.max(F.struct(x.alias("k"), y.alias("x"))).alias("ur"), F.max(F.struct(x.alias("k"), (-y).alias("x"))).alias("lr"),
        F.min("y").alias("y0"), F.max("y").alias("y1"),
    ).first()


def _extremes(directions: np.ndarray):
    """Each task's farthest point in every direction."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = np.full(len(directions), -np.inf)
        at = np.zeros((len(directions), 2))
        for pdf in batches:
            if len(pdf) == 0:
                continue
            p = pdf[["x", "y"]].to_numpy(dtype=float)
            for a in range(0, len(directions), 64):
                dots = p @ directions[a : a + 64].T
                i = dots.argmax(axis=0)
                top = dots[i, np.arange(dots.shape[1])]
                better = np.flatnonzero(top > best[a : a + 64])
                best[a + better] = top[better]
                at[a + better] = p[i[better]]
        ok = np.flatnonzero(best > -np.inf)
        yield pd.DataFrame({"k": ok.astype(np.int32), "d": best[ok], "x": at[ok, 0], "y": at[ok, 1]})

    return run


@dataclass(frozen=True)
class Frame:
    """Corners of the upper and lower chain, left to right."""

    chains: tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]

    def outside(self, x: np.ndarray, y: np.ndarray, side: int):
        """Places of the points beyond the frame on one side, their arcs, and
        their (rounded) distances from the edge."""
        cx, cy = self.chains[side]
        if len(cx) < 2:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        arc = np.clip(np.searchsorted(cx, x, side="right") - 1, 0, len(cx) - 2)
        ax, ay, bx, by = cx[arc], cy[arc], cx[arc + 1], cy[arc + 1]
        sign = turn_signs(ax, ay, bx, by, x, y)
        at = np.flatnonzero(sign > 0 if side == UPPER else sign < 0)
        with np.errstate(all="ignore"):
            d = np.abs((bx - ax) * (y - ay) - (by - ay) * (x - ax))[at] / np.hypot(bx - ax, by - ay)[at]
        return at, arc[at], np.nan_to_num(d)


def _assign(frame: Frame):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x, y = pdf["x"].to_numpy(dtype=float), pdf["y"].to_numpy(dtype=float)
            for side in (UPPER, LOWER):
                at, arc, d = frame.outside(x, y, side)
                yield pd.DataFrame(
                    {"side": np.full(len(at), side, np.int32), "arc": arc.astype(np.int32), "x": x[at], "y": y[at], "d": d}
                )

    return run


ASSIGNED = "side int, arc int, x double, y double, d double"


def _frame(c: DataFrame, base_rows: int, count: int, chains: Chains) -> tuple[Frame, DataFrame]:
    """The frame whose arcs hold at most ``base_rows`` candidates each, and
    the candidates outside it, distinct."""
    e = _ends(c)
    corners = [(-e["ul"]["k"], e["ul"]["x"]), (-e["ll"]["k"], -e["ll"]["x"]), (e["ur"]["k"], e["ur"]["x"]), (e["lr"]["k"], -e["lr"]["x"])]
    n = max(LEAST_DIRECTIONS, min(MOST_DIRECTIONS, 4 * count // base_rows))
    angle = np.arange(n) * (math.tau / n)
    scale = [1.0 / max(hi - lo, np.finfo(float).tiny) for lo, hi in ((corners[0][0], corners[2][0]), (e["y0"], e["y1"]))]
    directions = np.column_stack([np.cos(angle) * min(scale[0], 1e300), np.sin(angle) * min(scale[1], 1e300)])
    far = c.mapInPandas(_extremes(directions), "k int, d double, x double, y double").groupBy("k").agg(F.max(F.struct("d", "x", "y")).alias("p"))
    corners += [(r["p"]["x"], r["p"]["y"]) for r in far.collect()]  # one row per direction
    for k in range(MOST_ROUNDS):
        p = np.array(corners)
        frame = Frame(chains(p[:, 0], p[:, 1]))
        if k == 0:  # the points inside stay behind for good
            c = c.mapInPandas(_assign(frame), ASSIGNED).select("x", "y").distinct().checkpoint()
        large = (
            c.mapInPandas(_assign(frame), ASSIGNED).groupBy("side", "arc").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("d", "x", "y")).alias("p"))
            .where(F.col("n") > base_rows).collect()  # fewer rows than candidates / base_rows
        )
        if not large:
            break
        corners = [(x, y) for cx, cy in frame.chains for x, y in zip(cx.tolist(), cy.tolist())]
        corners += [(r["p"]["x"], r["p"]["y"]) for r in large]
    return frame, c


# --- arcs --------------------------------------------------------------------
def _arc_chain(frame: Frame, chains: Chains):
    """The vertices of one arc between its two corners (places from 1); a
    corner that turns out not to be a vertex leaves a row with place 0 (left)
    or -1 (right)."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        side, arc = int(key[0]), int(key[1])
        cx, cy = (v[arc : arc + 2] for v in frame.chains[side])
        x, y = chains(np.r_[cx, pdf["x"].to_numpy(dtype=float)], np.r_[cy, pdf["y"].to_numpy(dtype=float)])[side]
        inner = ~(((x == cx[0]) & (y == cy[0])) | ((x == cx[1]) & (y == cy[1])))
        pos = np.arange(1, int(inner.sum()) + 1)
        lost = [p for p, ok in ((0, x[0] == cx[0] and y[0] == cy[0]), (-1, x[-1] == cx[1] and y[-1] == cy[1])) if not ok]
        return pd.DataFrame(
            {"side": side, "arc": arc, "pos": np.r_[pos, lost].astype(np.int32),
             "x": np.r_[x[inner], [0.0] * len(lost)], "y": np.r_[y[inner], [0.0] * len(lost)]}
        ).astype({"side": np.int32, "arc": np.int32})

    return run


ARCS = "side int, arc int, pos int, x double, y double"


def _failed(frame: Frame, summary: dict) -> list[tuple[int, int]]:
    """Corners that are not vertices: lost by an arc, or without a strict
    turn between the vertices beside them."""
    out = []
    for side in (UPPER, LOWER):
        cx, cy = (v.tolist() for v in frame.chains[side])
        for j in range(1, len(cx) - 1):
            before, after = summary.get((side, j - 1)), summary.get((side, j))
            if (before and before["lost"] in (-1, 2)) or (after and after["lost"] in (0, 2)):
                out.append((side, j))
                continue
            o = (before["last"]["x"], before["last"]["y"]) if before and before["n"] else (cx[j - 1], cy[j - 1])
            b = (after["first"]["x"], after["first"]["y"]) if after and after["n"] else (cx[j + 1], cy[j + 1])
            t = turn(*o, cx[j], cy[j], *b)
            if (t >= 0) if side == UPPER else (t <= 0):
                out.append((side, j))
    return out


@dataclass(frozen=True)
class Chain:
    """The hull's two chains: ``(side, rank, x, y)``, ranks from 0 left to
    right, and their lengths; ``ends``: whether they share their first and
    last vertex."""

    rows: DataFrame
    sizes: tuple[int, int]
    ends: tuple[bool, bool]
    base_rows: int


def _ranked(rows: DataFrame, counts: dict[tuple[int, int], int]) -> tuple[DataFrame, tuple[int, int]]:
    """Ranks of ``(side, arc, pos, x, y)`` from a table of the rows before
    each arc (one row per arc)."""
    table, sizes = [], [0, 0]
    for (side, arc), n in sorted(counts.items()):
        table.append((side, arc, sizes[side]))
        sizes[side] += n
    before = F.broadcast(rows.sparkSession.createDataFrame(table, "side int, arc int, before long"))
    ranked = rows.join(before, ["side", "arc"]).select("side", (F.col("before") + F.col("pos")).alias("rank"), "x", "y")
    return ranked, (sizes[0], sizes[1])


def hull_chain(c: DataFrame, base_rows: int, count: int, chains: Chains) -> Chain:
    """The hull of the candidates ``c`` (finite ``x, y``, cheap to read
    again, at least one row)."""
    frame, c = _frame(c, base_rows, count, chains)
    while True:
        arcs = (
            c.mapInPandas(_assign(frame), ASSIGNED).groupBy("side", "arc").applyInPandas(_arc_chain(frame, chains), ARCS).checkpoint()
        )
        inner = F.col("pos") > 0
        point = F.struct("pos", "x", "y")
        summary = {
            (r["side"], r["arc"]): r
            for r in arcs.groupBy("side", "arc").agg(
                F.count_if(inner).alias("n"), F.min(F.when(inner, point)).alias("first"), F.max(F.when(inner, point)).alias("last"),
                # 0, -1: one corner is lost; 2: both; null: none.
                F.when(F.count_if(~inner) == 2, F.lit(2)).otherwise(F.min(F.when(~inner, F.col("pos")))).alias("lost"),
            ).collect()
        }
        failed = set(_failed(frame, summary))
        if not failed:
            break
        frame = Frame(tuple(
            tuple(np.delete(v, [j for s, j in failed if s == side]) for v in frame.chains[side]) for side in (UPPER, LOWER)
        ))
    corners = [
        (side, j, 0, x, y) for side in (UPPER, LOWER) for j, (x, y) in enumerate(zip(*(v.tolist() for v in frame.chains[side])))
    ]
    rows = arcs.unionByName(c.sparkSession.createDataFrame(corners, ARCS))
    counts = {(side, j): 1 + (summary[side, j]["n"] if (side, j) in summary else 0) for side, j, *_ in corners}
    ranked, sizes = _ranked(rows, counts)
    (ux, uy), (lx, ly) = frame.chains
    ends = (bool(uy[0] == ly[0]), bool(uy[-1] == ly[-1]))
    return Chain(ranked, sizes, ends, base_rows)


def thinned(chain: Chain, eps: float, scan) -> Chain:
    """The chain without the vertices that a scan with tolerance ``eps`` drops,
    in blocks of ``base_rows`` ranks whose first vertices stay (ranks belong
    to the exact hull, so the blocks are the same however it was computed)."""
    size = chain.base_rows

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank")
        x, y, rank = pdf["x"].to_numpy(), pdf["y"].to_numpy(), pdf["rank"].to_numpy()
        at = np.array(scan(x.tolist(), y.tolist(), int(key[0]) == UPPER, eps))
        at = at[rank[at] // size == int(key[1])]
        return pd.DataFrame(
            {"side": int(key[0]), "arc": int(key[1]), "pos": np.arange(len(at)), "x": x[at], "y": y[at]}
        ).astype({"side": np.int32, "arc": np.int32, "pos": np.int32})

    rows = _blocks(chain, after=True).groupBy("side", "block").applyInPandas(run, ARCS).checkpoint()
    counts = {(r["side"], r["arc"]): r["count"] for r in rows.groupBy("side", "arc").count().collect()}  # one row per block
    ranked, sizes = _ranked(rows, counts)
    return Chain(ranked, sizes, chain.ends, chain.base_rows)


def _blocks(chain: Chain, before: bool = False, after: bool = False, reach: int = 1) -> DataFrame:
    """Rows with their block of ranks; with ``before`` (``after``) a block
    also gets the last (first) ``reach`` rows of the block before (after)."""
    size, rank = chain.base_rows, F.col("rank")
    own = F.floor(rank / size).cast("int")
    blocks = [own]
    if after:
        blocks.append(F.when((rank % size < reach) & (rank >= size), own - 1))
    if before:
        blocks.append(F.when(rank % size >= size - reach, own + 1))
    return chain.rows.withColumn("block", F.explode(F.array_compact(F.array(*blocks))))


# --- outputs -----------------------------------------------------------------
def vertices(chain: Chain) -> DataFrame:
    side, rank = F.col("side"), F.col("rank")
    shared = F.lit(False)
    if chain.ends[0]:
        shared = shared | (rank == 0)
    if chain.ends[1]:
        shared = shared | (rank == chain.sizes[LOWER] - 1)
    return chain.rows.where((side == UPPER) | ~shared).select("x", "y")


def ring(chain: Chain) -> DataFrame:
    """Clockwise from the smallest point: the upper chain, then the lower one
    backwards."""
    (nu, nl), (left, right), rank = chain.sizes, chain.ends, F.col("rank")
    first = 0 if left else 1  # the upper chain's first place
    up = chain.rows.where(F.col("side") == UPPER).select((rank + first).alias("ord"), "x", "y")
    low = chain.rows.where(F.col("side") == LOWER)
    if left:
        low = low.where(rank > 0)
    if right:
        low = low.where(rank < nl - 1)
    back = F.lit(first + nu + nl - 1 - int(right)) - rank
    low = low.select(F.when(rank == 0, F.lit(0)).otherwise(back).alias("ord"), "x", "y")
    return up.unionByName(low).select(F.col("ord").cast("int").alias("ord"), "x", "y")


def both_chains(chain: Chain) -> DataFrame:
    name = F.when(F.col("side") == UPPER, F.lit("upper")).otherwise(F.lit("lower"))
    return chain.rows.select(name.alias("chain"), "x", "y")


# --- farthest pair -------------------------------------------------------------
def _slopes(size: int):
    """Per vertex the range of slopes between its two edges: a line of a slope
    in it touches the hull there."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        side, block = int(key[0]), int(key[1])
        pdf = pdf.sort_values("rank")
        x, y, rank = (pdf[c].to_numpy() for c in ("x", "y", "rank"))
        with np.errstate(all="ignore"):
            s = np.diff(y) / np.diff(x)
        sign = 1.0 if side == UPPER else -1.0
        before, after = np.r_[sign * np.inf, s], np.r_[s, -sign * np.inf]
        lo, hi = np.minimum(before, after), np.maximum(before, after)
        own = rank // size == block
        return pd.DataFrame(
            {"side": side, "rank": rank, "lo": lo, "hi": hi, "x": x, "y": y}
        )[own].astype({"side": np.int32})

    return run


def _stretch(v: np.ndarray, sign: float) -> np.ndarray:
    with np.errstate(invalid="ignore"):
        return np.where(np.isfinite(v), v + sign * (np.abs(v) * WIDE + np.finfo(float).tiny), v)


def _antipodal(pdf: pd.DataFrame) -> pd.DataFrame:
    """The farthest pair of an upper and a lower vertex whose slope ranges
    meet; both sides' ranges follow one another, so the pairs are about as
    many as the vertices."""
    up, low = (pdf[pdf["side"] == s].sort_values(["lo", "hi"]) for s in (UPPER, LOWER))
    empty = pd.DataFrame(columns=["ax", "ay", "bx", "by", "d2"]).astype(float)
    if len(up) == 0 or len(low) == 0:
        return empty
    first = np.searchsorted(np.maximum.accumulate(low["hi"].to_numpy()), _stretch(up["lo"].to_numpy(), -1.0), side="left")
    last = np.searchsorted(low["lo"].to_numpy(), _stretch(up["hi"].to_numpy(), 1.0), side="right")
    n = np.maximum(last - first, 0)
    if n.sum() == 0:
        return empty
    i = np.repeat(np.arange(len(up)), n)
    j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    p = np.r_[up[["x", "y"]].to_numpy(), low[["x", "y"]].to_numpy()]
    pair = oriented_pairs(p, i, j + len(up))
    k = best_pair(*pair, largest=True)
    return pd.DataFrame([[v[k] for v in pair]], columns=empty.columns)


def farthest(chain: Chain, hull_farthest) -> DataFrame:
    """The farthest pair is antipodal: an upper and a lower vertex touched by
    lines of one slope.  Vertices meet in ranges of slopes bounded by those of
    the blocks' first vertices."""
    spark, size = chain.rows.sparkSession, chain.base_rows
    s = (
        _blocks(chain, before=True, after=True).groupBy("side", "block")
        .applyInPandas(_slopes(size), "side int, rank long, lo double, hi double, x double, y double").checkpoint()
    )
    marks = s.where((F.col("rank") % size == 0) | (F.col("rank") == F.when(F.col("side") == UPPER, chain.sizes[0] - 1).otherwise(chain.sizes[1] - 1)))
    marks = marks.collect()  # one row per block and two per chain
    # The ends' own pairs (an upper end may be farthest from another), and a
    # lower bound: vertices nearer than it to every corner of the extent go.
    p = np.array([(r["x"], r["y"]) for r in marks])
    some = hull_farthest(p)
    box = s.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).first()
    dx = F.greatest(F.col("x") - box["x0"], F.lit(box["x1"]) - F.col("x"))
    dy = F.greatest(F.col("y") - box["y0"], F.lit(box["y1"]) - F.col("y"))
    s = s.where(dx * dx + dy * dy >= F.lit(float(some[4]) * (1.0 - 1e-12)))
    bounds = np.unique([v for r in marks for v in (r["lo"], r["hi"]) if math.isfinite(v)])

    @F.pandas_udf("array<int>")
    def ranges(lo: pd.Series, hi: pd.Series) -> pd.Series:
        a = np.searchsorted(bounds, _stretch(lo.to_numpy(), -2.0), side="left")
        b = np.searchsorted(bounds, _stretch(hi.to_numpy(), 2.0), side="right")
        return pd.Series([list(range(i, j + 1)) for i, j in zip(a.tolist(), b.tolist())])

    best = (
        s.select("side", "lo", "hi", "x", "y", F.explode(ranges("lo", "hi")).alias("k"))
        .groupBy("k").applyInPandas(_antipodal, PAIR_SCHEMA)
        .unionByName(spark.createDataFrame([tuple(map(float, some))], PAIR_SCHEMA))
    )
    top = best.agg(F.min(F.struct((-F.col("d2")).alias("k"), "ax", "ay", "bx", "by", "d2")).alias("m"))
    return top.select("m.ax", "m.ay", "m.bx", "m.by", "m.d2")


# --- closest pair on both axes ---------------------------------------------------
def _near(pdf: pd.DataFrame) -> pd.DataFrame:
    """The smallest distance of vertices one or two places apart that differ
    on both axes."""
    pdf = pdf.sort_values("rank")
    x, y = pdf["x"].to_numpy(), pdf["y"].to_numpy()
    best = []
    for k in (1, 2):
        dx, dy = x[k:] - x[:-k], y[k:] - y[:-k]
        ok = (dx != 0) & (dy != 0)
        if ok.any():
            best.append(float((dx[ok] * dx[ok] + dy[ok] * dy[ok]).min()))
    return pd.DataFrame({"d2": [min(best)] if best else []}).astype(float)


def closest_on_axes(chain: Chain) -> DataFrame:
    """Closest pair of vertices that differ on both axes: a bound from
    neighbours, then a join of cells of that size."""
    pts = vertices(chain).checkpoint()
    near = _blocks(chain, after=True, reach=2).groupBy("side", "block").applyInPandas(_near, "d2 double").agg(F.min("d2").alias("d2")).first()["d2"]
    box = pts.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).first()
    dx, dy = box["x1"] - box["x0"], box["y1"] - box["y0"]
    bound = near if near is not None else dx * dx + dy * dy
    differ = (F.col("ax") != F.col("bx")) & (F.col("ay") != F.col("by"))
    return _grid_pairs(pts, float(bound), box["x0"], box["y0"], max(dx, dy), differ)
