"""Planar point and box analytics as PySpark DataFrame functions.

Points are ``(x DOUBLE, y DOUBLE)`` columns, boxes are ``(x1, y1, x2, y2)``
with corners in any order.  Every operator takes and returns DataFrames;
nothing is collected on the driver except bounded scalars (extent, grid
size, a distance bound).
"""

from planar.functions.geometry import (
    box_in_box,
    box_ring,
    cross,
    dist2,
    finite,
    normalize_boxes,
    point_in_box,
)
from planar.operators.closest import closest_pair
from planar.operators.hull import (
    convex_hull,
    convex_hull_ring,
    farthest_pair,
    hull_chains,
    hull_closest_pair,
)
from planar.operators.joins import (
    containment_join,
    containment_lists,
    heat_map,
    point_in_box_join,
)
from planar.operators.range_query import range_query
from planar.operators.stats import distinct_points, extent
from planar.operators.union import box_union_vertices
from planar.sources.text import read_boxes, read_points, split_rejects, write_lines
from planar.streaming import heat_map_stream, point_in_box_stream

__all__ = [
    "box_in_box",
    "box_ring",
    "box_union_vertices",
    "closest_pair",
    "containment_join",
    "containment_lists",
    "convex_hull",
    "convex_hull_ring",
    "cross",
    "dist2",
    "distinct_points",
    "extent",
    "farthest_pair",
    "finite",
    "heat_map",
    "heat_map_stream",
    "hull_chains",
    "hull_closest_pair",
    "normalize_boxes",
    "point_in_box",
    "point_in_box_join",
    "point_in_box_stream",
    "range_query",
    "read_boxes",
    "read_points",
    "split_rejects",
    "write_lines",
]
