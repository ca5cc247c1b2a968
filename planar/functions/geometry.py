"""Column expressions for planar geometry.

Everything here builds plain Catalyst expressions, so it stays inside
whole-stage codegen and parquet pushdown.  Distances are squared and
written as ``dx*dx + dy*dy`` (never ``pow``) so that every engine computes
the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

_INF = float("inf")


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(*cols: ColumnOrName) -> Column:
    """True when every column is non-null and finite.

    ``abs(v) < inf`` is false for NaN in Spark (NaN sorts above +inf) and
    null for null, so one comparison per column covers all three cases.
    The result is never null.
    """
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.abs(_c(c)) < F.lit(_INF))
    return F.coalesce(cond, F.lit(False))


def normalize_boxes(
    df: DataFrame,
    x1: str = "x1",
    y1: str = "y1",
    x2: str = "x2",
    y2: str = "y2",
) -> DataFrame:
    """Keep valid boxes and add ``xmin, ymin, xmax, ymax`` (corner order free)."""
    return df.where(finite(x1, y1, x2, y2)).withColumns(
        {
            "xmin": F.least(x1, x2),
            "ymin": F.least(y1, y2),
            "xmax": F.greatest(x1, x2),
            "ymax": F.greatest(y1, y2),
        }
    )


def cross(
    ox: ColumnOrName, oy: ColumnOrName,
    ax: ColumnOrName, ay: ColumnOrName,
    bx: ColumnOrName, by: ColumnOrName,
) -> Column:
    """Orientation ``(A - O) x (B - O)``; positive for a left turn."""
    ox, oy, ax, ay, bx, by = map(_c, (ox, oy, ax, ay, bx, by))
    return (ax - ox) * (by - oy) - (ay - oy) * (bx - ox)


def dist2(ax: ColumnOrName, ay: ColumnOrName, bx: ColumnOrName, by: ColumnOrName) -> Column:
    """Squared Euclidean distance."""
    ax, ay, bx, by = map(_c, (ax, ay, bx, by))
    dx = ax - bx
    dy = ay - by
    return dx * dx + dy * dy


def box_ring(xmin: ColumnOrName, ymin: ColumnOrName, xmax: ColumnOrName, ymax: ColumnOrName) -> Column:
    """Closed ring of a box: five points counter-clockwise from the lower left."""
    xmin, ymin, xmax, ymax = map(_c, (xmin, ymin, xmax, ymax))
    corners = [(xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin)]
    return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in corners])


def point_in_box(
    px: ColumnOrName, py: ColumnOrName,
    xmin: ColumnOrName, ymin: ColumnOrName, xmax: ColumnOrName, ymax: ColumnOrName,
    closed: bool = False,
) -> Column:
    """Point inside a normalised box; edges excluded unless ``closed``."""
    px, py, xmin, ymin, xmax, ymax = map(_c, (px, py, xmin, ymin, xmax, ymax))
    if closed:
        return (xmin <= px) & (px <= xmax) & (ymin <= py) & (py <= ymax)
    return (xmin < px) & (px < xmax) & (ymin < py) & (py < ymax)


def box_in_box(
    qx1: ColumnOrName, qy1: ColumnOrName, qx2: ColumnOrName, qy2: ColumnOrName,
    xmin: ColumnOrName, ymin: ColumnOrName, xmax: ColumnOrName, ymax: ColumnOrName,
) -> Column:
    """Both corners of probe ``q`` strictly inside a normalised box."""
    return point_in_box(qx1, qy1, xmin, ymin, xmax, ymax) & point_in_box(
        qx2, qy2, xmin, ymin, xmax, ymax
    )
