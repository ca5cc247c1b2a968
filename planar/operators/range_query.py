"""Range query: boxes lying inside a query window, edges included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def range_query(
    boxes: DataFrame,
    window: Sequence[float],
    x1: str = "x1",
    y1: str = "y1",
    x2: str = "x2",
    y2: str = "y2",
) -> DataFrame:
    """Rows of ``boxes`` whose extent lies in ``window = (ax, ay, bx, by)``.

    The window is normalised once on the driver.  The predicate is four
    plain ``BETWEEN``s on the raw corner columns rather than
    ``least/greatest``, so Catalyst pushes it into the parquet scan as
    range filters, and NaN or null corners fail it (``NaN <= hi`` is
    false in Spark).  Output keeps the corners as given.
    """
    ax, ay, bx, by = (float(v) for v in window)
    lx, hx = min(ax, bx), max(ax, bx)
    ly, hy = min(ay, by), max(ay, by)
    return boxes.where(
        F.col(x1).between(lx, hx)
        & F.col(x2).between(lx, hx)
        & F.col(y1).between(ly, hy)
        & F.col(y2).between(ly, hy)
    )
