"""Box/point range joins: point-in-box pairs, heat map, containment.

All of them run on the grid equi-join of ``planar.plans.grid``.  Copies
(identical coordinates) are collapsed before the join where the result only
depends on coordinates, and joined back afterwards, so a hot group of copies
costs one row in the join instead of one per copy.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from planar.functions.geometry import box_in_box, finite, normalize_boxes, point_in_box
from planar.plans.cells import CELL, answer_cells
from planar.plans.corners import corner_counts
from planar.plans.grid import Grid, box_point_join, fits_broadcast, plan_grid, shuffled
from planar.plans.nested import nested_counts
from planar.plans.session import ensure_checkpoint_dir, ship_package

_BOX = ("xmin", "ymin", "xmax", "ymax")
_EXTENT_BYTES = 64  # four doubles and their cell key
RUN_ROWS = 1 << 16   # ids of a list that are sorted in one group
NEST_OVERLAP = 8.0   # boxes over a place from which nested counts may pay
NEST_MATCHES = 3e7   # expected matches from which they do
CORNER_BOXES = 1 << 14  # boxes from which counts at their corners take the place of nested ones
LIST_MATCHES = 1e6   # expected matches from which lists are made cell by cell
LIST_BOXES = 1 << 20  # most boxes of a cell that one task holds for that
LIST_PAIRS = 1 << 22  # pairs of a probe and a box that it compares at a time


def _boxes(boxes: DataFrame, x1: str, y1: str, x2: str, y2: str) -> DataFrame:
    return normalize_boxes(boxes, x1, y1, x2, y2)


def point_in_box_join(
    boxes: DataFrame,
    points: DataFrame,
    box_id: str = "id",
    point_id: str = "id",
    x: str = "x",
    y: str = "y",
    corners: tuple[str, str, str, str] = ("x1", "y1", "x2", "y2"),
) -> DataFrame:
    """Pairs ``(box_id, point_id)`` with the point strictly inside the box.

    Where boxes overlap ``BLOCK_OVERLAP``-fold or more and are not broadcast,
    points go in blocks (``plans/blocks.py``): the same pairs, in an order in
    which their files are several times smaller."""
    b = _boxes(boxes, *corners).select(F.col(box_id).alias("box_id"), *_BOX)
    p = points.where(finite(x, y)).select(
        F.col(point_id).alias("point_id"), F.col(x).alias("px"), F.col(y).alias("py")
    )
    cond = point_in_box("px", "py", *_BOX)
    return box_point_join(b, p, cond, blocks=True).select("box_id", "point_id")


def heat_map(
    boxes: DataFrame,
    points: DataFrame,
    box_id: str = "id",
    x: str = "x",
    y: str = "y",
    corners: tuple[str, str, str, str] = ("x1", "y1", "x2", "y2"),
    nest_matches: float = NEST_MATCHES,
    corner_boxes: int = CORNER_BOXES,
) -> DataFrame:
    """Number of points strictly inside each box: ``(id, n)``, one row per
    valid box row, zeros kept.

    Plan: distinct box extents are exploded to grid cells; points are matched
    on their cell.  When the box side is proven small it is broadcast and
    points stream through without any shuffle; otherwise points are first
    pre-aggregated to ``(x, y, copies)`` (map-side, so a hot group of copies
    is one row per task) and both sides shuffle on the cell.  Counts per box
    extent are then joined back to every box row.

    Where boxes overlap ``NEST_OVERLAP``-fold or more and about
    ``nest_matches`` points or more would be met, points are counted per cell
    instead (``nested_counts``), so that the work follows the boxes' borders
    and not the matches.  From ``corner_boxes`` boxes on, whose borders are
    too many for that, they are counted at the boxes' corners
    (``corner_counts``).  All ways give the same counts.
    """
    b = _boxes(boxes, *corners).select(F.col(box_id).alias("id"), *_BOX)
    grid = plan_grid((b, *_BOX))
    ub = b.select(*_BOX).distinct()
    p = points.where(finite(x, y)).select(F.col(x).alias("px"), F.col(y).alias("py"))
    if grid is None:
        return b.select("id", F.lit(0).cast("long").alias("n"))
    weighted = p.groupBy("px", "py").agg(F.count(F.lit(1)).alias("w"))
    if grid.overlap >= NEST_OVERLAP and grid.overlap * points.count() >= nest_matches:
        ensure_checkpoint_dir(boxes.sparkSession)
        many = grid.counts[0] >= corner_boxes
        counts = corner_counts(ub, weighted) if many else nested_counts(ub, weighted, grid)
    else:
        if fits_broadcast(ub, grid.cells, _EXTENT_BYTES):
            weighted = p.withColumn("w", F.lit(1).cast("long"))
        pairs = box_point_join(ub, weighted, point_in_box("px", "py", *_BOX), grid=replace(grid, row_bytes=_EXTENT_BYTES))
        counts = pairs.groupBy(*_BOX).agg(F.sum("w").alias("n"))
    small = fits_broadcast(counts, grid.counts[0], _EXTENT_BYTES + 8)
    counts = F.broadcast(counts) if small else shuffled(counts)
    return b.join(counts, list(_BOX), "left").select(
        "id", F.coalesce(F.col("n"), F.lit(0).cast("long")).alias("n")
    )


def _probes(probes: DataFrame, corners: tuple[str, str, str, str]) -> DataFrame:
    x1, y1, x2, y2 = corners
    return probes.where(finite(x1, y1, x2, y2)).select(
        F.col(x1).alias("qx1"), F.col(y1).alias("qy1"), F.col(x2).alias("qx2"), F.col(y2).alias("qy2"),
        *[c for c in probes.columns if c not in corners],
    )


def containment_join(
    probes: DataFrame,
    boxes: DataFrame,
    probe_id: str = "id",
    box_id: str = "id",
    probe_corners: tuple[str, str, str, str] = ("x1", "y1", "x2", "y2"),
    box_corners: tuple[str, str, str, str] = ("x1", "y1", "x2", "y2"),
) -> DataFrame:
    """Pairs ``(probe_id, box_id)`` where both probe corners lie strictly
    inside the box.  Probes are matched on the cell of their first corner:
    if the predicate holds that corner is in the box, so every pair is met
    exactly once."""
    q = _probes(probes.select(F.col(probe_id).alias("probe_id"), *probe_corners), probe_corners)
    b = _boxes(boxes, *box_corners).select(F.col(box_id).alias("box_id"), *_BOX)
    cond = box_in_box("qx1", "qy1", "qx2", "qy2", *_BOX)
    return box_point_join(b, q, cond, point=("qx1", "qy1")).select("probe_id", "box_id")


def _numbered(b: DataFrame, size: int) -> DataFrame:
    """Boxes with ``_run``: their place in (xmin, id) order divided by
    ``size``, from one sort and a table of the rows before each partition."""
    at = F.col("_at")
    s = b.sort("xmin", "box_id").withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    part, place = F.shiftright(at, 33), at.bitwiseAND(F.lit((1 << 33) - 1))
    total, table = 0, []
    for r in sorted(s.groupBy(part.alias("part")).count().collect(), key=lambda r: r["part"]):  # one row per partition
        table.append((r["part"], total))
        total += r["count"]
    before = F.broadcast(b.sparkSession.createDataFrame(table, "_part long, _before long"))
    return (
        s.join(before, part == F.col("_part"))
        .withColumn("_run", F.floor((F.col("_before") + place) / size)).drop("_at", "_part", "_before")
    )


def _hold(boxes: pa.Table):
    """Corners and id texts of a cell's boxes, in list order."""
    return [boxes[c].to_numpy() for c in ("a", "b", "c", "d")], boxes["text"].combine_chunks()


def _list(held, probes: pa.RecordBatch):
    """``(id, ids)`` of the probes, sorted so that copies follow one another."""
    ids, q = probes.column("pid"), np.column_stack([probes.column(c).to_numpy() for c in ("a", "b", "c", "d")])
    if held is None:
        yield pa.RecordBatch.from_arrays([ids, pa.array([""] * len(q), pa.string())], names=["id", "ids"])
        return
    (xmin, ymin, xmax, ymax), text = held
    first = np.concatenate([[True], (q[1:] != q[:-1]).any(axis=1)])
    group, q = np.cumsum(first) - 1, q[first]
    step = max(1, LIST_PAIRS // len(xmin))
    for s in range(0, len(q), step):
        x1, y1, x2, y2 = (v[:, None] for v in q[s : s + step].T)
        inside = (np.minimum(x1, x2) > xmin) & (np.maximum(x1, x2) < xmax) & (np.minimum(y1, y2) > ymin) & (np.maximum(y1, y2) < ymax)
        ends = np.concatenate([[0], np.cumsum(inside.sum(axis=1))]).astype(np.int32)
        lists = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), text.take(pa.array(np.nonzero(inside)[1]))), ",")
        i, j = np.searchsorted(group, [s, s + step])
        for u in range(i, j, max(1, step)):
            v = min(j, u + max(1, step))
            yield pa.RecordBatch.from_arrays([ids.slice(u, v - u), lists.take(pa.array(group[u:v] - s))], names=["id", "ids"])


def _lists_by_cell(probes: DataFrame, b: DataFrame, grid: Grid, probe_id: str, corners: tuple[str, str, str, str]) -> DataFrame | None:
    """The lists of ``containment_lists``, made cell by cell without a row per
    pair; None where a cell holds too many boxes.  ``grid`` has one level."""
    held = grid.box_cells(b.where(F.col("box_id").isNotNull()), *_BOX).select(
        F.col("_bx").alias("cx"), F.col("_by").alias("cy"), F.col("xmin").alias("a"), F.col("ymin").alias("b"),
        F.col("xmax").alias("c"), F.col("ymax").alias("d"), "box_id", F.col("box_id").cast("string").alias("text"),
        F.lit(None).cast(probes.schema[probe_id].dataType).alias("pid"),
    )
    most = held.groupBy(*CELL).count().agg(F.max("count")).first()[0]
    if (most or 0) > LIST_BOXES:
        return None
    ship_package(probes.sparkSession)
    q = [F.col(c).cast("double") for c in corners]
    met = F.coalesce(finite(*corners) & grid.inside(q[0], q[1]), F.lit(False))
    p = probes.select(F.col(probe_id).alias("pid"), *[c.alias(n) for c, n in zip(q, "abcd")], met.alias("_met"))
    cells = grid.point_cells(p.where("_met").drop("_met"), "a", "b").select(
        F.col("_px").alias("cx"), F.col("_py").alias("cy"), "a", "b", "c", "d",
        F.lit(None).cast(b.schema["box_id"].dataType).alias("box_id"), F.lit(None).cast("string").alias("text"), "pid",
    )
    schema = StructType([StructField("id", probes.schema[probe_id].dataType), StructField("ids", StringType())])
    lists = answer_cells(held, cells, ["a", "box_id", "b", "c", "d"], _hold, _list, schema)
    return lists.select("id", F.coalesce("ids", F.lit("")).alias("ids")).unionByName(p.where(~F.col("_met")).select(F.col("pid").alias("id"), F.lit("").alias("ids")))


def containment_lists(
    probes: DataFrame,
    boxes: DataFrame,
    probe_id: str = "id",
    box_id: str = "id",
    probe_corners: tuple[str, str, str, str] = ("x1", "y1", "x2", "y2"),
    box_corners: tuple[str, str, str, str] = ("x1", "y1", "x2", "y2"),
    run_rows: int = RUN_ROWS,
    list_matches: float = LIST_MATCHES,
) -> DataFrame:
    """One row per probe row: ``(id, ids)`` with the ids of the boxes that
    strictly contain it, comma-joined in ascending (box xmin, box id) order;
    empty when none.

    Lists depend only on the probe's corners, so they are computed once per
    distinct corner tuple and joined back to all probe rows.  Lists longer
    than ``run_rows`` can only occur among more boxes than that; then boxes
    are numbered in list order, and a list is put together from runs of
    ``run_rows`` numbers: a probe inside very many boxes is sorted in groups
    of at most that many, and only the finished runs meet in its row.

    Where about ``list_matches`` pairs or more are to be expected and the
    boxes share one level of the grid, lists are made cell by cell instead
    (``plans/cells.py``): boxes and probes are shuffled, pairs and lists are
    not.  Both ways give the same lists.
    """
    x1, y1, x2, y2 = probe_corners
    dq = _probes(probes.select(*probe_corners), probe_corners).distinct()
    b = _boxes(boxes, *box_corners).select(F.col(box_id).alias("box_id"), *_BOX)
    grid = plan_grid((b, *_BOX))
    if grid is not None and len(grid.levels) == 1 and grid.overlap * probes.count() >= list_matches:
        made = _lists_by_cell(probes, b, grid, probe_id, probe_corners)
        if made is not None:
            return made
    cond = box_in_box("qx1", "qy1", "qx2", "qy2", *_BOX)
    key = ["qx1", "qy1", "qx2", "qy2"]
    text = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("xmin", "box_id"))), lambda s: s["box_id"].cast("string")), ","
    )
    if grid is None or grid.counts[0] <= run_rows:
        lists = box_point_join(b, dq, cond, point=("qx1", "qy1"), grid=grid).groupBy(*key).agg(text.alias("_l"))
    else:
        ensure_checkpoint_dir(probes.sparkSession)
        pairs = box_point_join(_numbered(b, run_rows), dq, cond, point=("qx1", "qy1"), grid=replace(grid, row_bytes=grid.row_bytes + 8))
        runs = pairs.groupBy(*key, "_run").agg(text.alias("_l"))
        whole = F.array_sort(F.collect_list(F.struct("_run", "_l")))
        lists = runs.groupBy(*key).agg(F.array_join(F.transform(whole, lambda s: s["_l"]), ",").alias("_l"))
    on = (
        (F.col(x1) == F.col("qx1")) & (F.col(y1) == F.col("qy1"))
        & (F.col(x2) == F.col("qx2")) & (F.col(y2) == F.col("qy2"))
    )
    return probes.join(shuffled(lists), on, "left").select(
        F.col(probe_id).alias("id"), F.coalesce("_l", F.lit("")).alias("ids")
    )
