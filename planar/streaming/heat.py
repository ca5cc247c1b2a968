"""The point-in-box join and heat map over a stream of points.

The reference has no streaming; these are the batch operators applied to a
Structured Streaming source.  Boxes are a static DataFrame: the grid is
planned once from them (two small batch jobs) and their cells are the
static side of a stream-static equi-join, so each micro-batch of points is
matched without any state.  The heat map adds a streaming aggregation
(running count per box row; state is one row per box that has been hit).

Boxes that no point has hit yet do not appear in the streaming counts;
left-join the static boxes to the sink table to show them with 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planar.functions.geometry import finite, normalize_boxes, point_in_box
from planar.plans.grid import box_point_join, plan_grid

_BOX = ("xmin", "ymin", "xmax", "ymax")


def point_in_box_stream(
    boxes: DataFrame,
    points: DataFrame,
    box_id: str = "id",
    x: str = "x",
    y: str = "y",
    corners: tuple[str, str, str, str] = ("x1", "y1", "x2", "y2"),
) -> DataFrame:
    """Streaming ``(box_id, <point columns>)`` for points strictly inside a box."""
    b = normalize_boxes(boxes, *corners).select(F.col(box_id).alias("box_id"), *_BOX)
    grid = plan_grid((b, *_BOX))
    p = points.where(finite(x, y)).withColumnsRenamed({x: "px", y: "py"})
    if grid is None:
        return p.select(F.lit(None).cast(b.schema["box_id"].dataType).alias("box_id"), "*").where(F.lit(False))
    pairs = box_point_join(b, p, point_in_box("px", "py", *_BOX), grid=grid)
    return pairs.drop(*_BOX).withColumnsRenamed({"px": x, "py": y})


def heat_map_stream(
    boxes: DataFrame,
    points: DataFrame,
    box_id: str = "id",
    x: str = "x",
    y: str = "y",
    corners: tuple[str, str, str, str] = ("x1", "y1", "x2", "y2"),
) -> DataFrame:
    """Running ``(id, n)`` per box id hit so far; use ``update`` or
    ``complete`` output mode."""
    pairs = point_in_box_stream(boxes, points.select(x, y), box_id, x, y, corners)
    return pairs.groupBy(F.col("box_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
