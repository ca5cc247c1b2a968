"""Points per box by nested cell counts.

Joining every point with every box that holds it makes as many rows as there
are matches.  Here points are counted per cell first.  A cell wholly inside a
box gives its whole count as one row; a cell that the box's border crosses is
cut into ``BRANCH`` by ``BRANCH`` cells as long as it holds more than ``leaf``
points, and only the points of what is left meet the box.  Rows follow the
borders of the boxes, not what lies inside them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planar.functions.geometry import point_in_box
from planar.plans.grid import BRANCH, Grid, shuffled

LEAF = 64        # points of a crossed cell that meet the box one by one
MOST_DEPTH = 8   # cuts of a cell (its side goes down by BRANCH each time)

BOX = ("xmin", "ymin", "xmax", "ymax")
CELL = ("l", "cx", "cy")


def _side(grid: Grid, axis: int, depth: int) -> Column:
    """Cell side at a depth on a row's level: a power of two, so that edges
    and cell numbers are exact."""
    return F.get(F.array(*[F.lit(float(BRANCH) ** (lv[axis] - depth)) for lv in grid.levels]), F.col("l"))


def _next(grid: Grid, depth: int) -> list[Column]:
    return [F.floor(F.col("px") / _side(grid, 0, depth)).alias("cx"), F.floor(F.col("py") / _side(grid, 1, depth)).alias("cy")]


def nested_counts(boxes: DataFrame, points: DataFrame, grid: Grid, leaf: int = LEAF) -> DataFrame:
    """``(xmin, ymin, xmax, ymax, n)``: the points strictly inside each box,
    for the boxes that hold any.  ``boxes``: distinct valid extents, planned
    by ``grid``; ``points``: ``(px, py, w)`` with ``w`` copies each, finite.

    Intermediate rows are written to the checkpoint folder; the number of
    rounds follows the densest crossed cell (``MOST_DEPTH`` at most, beyond
    which points meet the box directly)."""
    boxes = boxes.checkpoint()
    rows = grid.box_cells(boxes, *BOX, prefix="_b").select(
        *BOX, F.col("_bl").alias("l"), F.col("_bx").alias("cx"), F.col("_by").alias("cy")
    )
    at = grid.point_cells(points, "px", "py", prefix="_p").select(
        F.col("_pl").alias("l"), "px", "py", "w", F.col("_px").alias("cx"), F.col("_py").alias("cy")
    )
    found = None
    for depth in range(MOST_DEPTH + 1):
        at = at.checkpoint()
        counts = at.groupBy(*CELL).agg(F.sum("w").alias("n"), F.count(F.lit(1)).alias("m"))
        x0, y0 = F.col("cx") * _side(grid, 0, depth), F.col("cy") * _side(grid, 1, depth)
        x1, y1 = (F.col("cx") + 1) * _side(grid, 0, depth), (F.col("cy") + 1) * _side(grid, 1, depth)
        # A cell holds its lower edges, not its upper ones.
        whole = (F.col("xmin") < x0) & (x1 <= F.col("xmax")) & (F.col("ymin") < y0) & (y1 <= F.col("ymax"))
        rows = rows.join(shuffled(counts), list(CELL)).withColumn("whole", whole).checkpoint()
        inside = rows.where("whole").select(*BOX, "n")
        deep = ~F.col("whole") & (F.col("m") > leaf) if depth < MOST_DEPTH else F.lit(False)
        few = rows.where(~F.col("whole") & ~deep).select(*BOX, *CELL)
        met = few.join(shuffled(at), list(CELL)).where(point_in_box("px", "py", *BOX)).select(*BOX, F.col("w").alias("n"))
        part = inside.unionByName(met).groupBy(*BOX).agg(F.sum("n").alias("n"))
        found = part if found is None else found.unionByName(part)
        rows = rows.where(deep).select(*BOX, *CELL)
        if rows.isEmpty():
            break
        cells = rows.select(*CELL).distinct()
        at = at.join(shuffled(cells), list(CELL), "left_semi").select("l", "px", "py", "w", *_next(grid, depth + 1))
        step = F.sequence(F.lit(0), F.lit(BRANCH - 1))
        rows = (
            rows.withColumn("i", F.explode(step)).withColumn("j", F.explode(step))
            .select(*BOX, "l", (F.col("cx") * BRANCH + F.col("i")).alias("cx"), (F.col("cy") * BRANCH + F.col("j")).alias("cy"))
        )
        sx, sy = _side(grid, 0, depth + 1), _side(grid, 1, depth + 1)
        rows = rows.where(
            (F.col("cx") * sx < F.col("xmax")) & ((F.col("cx") + 1) * sx > F.col("xmin"))
            & (F.col("cy") * sy < F.col("ymax")) & ((F.col("cy") + 1) * sy > F.col("ymin"))
        )
    return found.groupBy(*BOX).agg(F.sum("n").alias("n"))
