"""Small aggregates: extent of a point set and distinct points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planar.functions.geometry import finite


def extent(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """One row ``(xmin, ymin, xmax, ymax)`` over the valid points.

    A global aggregate: every task reduces its rows to one partial row,
    only those cross the network.
    """
    return points.where(finite(x, y)).agg(
        F.min(x).alias("xmin"),
        F.min(y).alias("ymin"),
        F.max(x).alias("xmax"),
        F.max(y).alias("ymax"),
    )


def distinct_points(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Distinct valid ``(x, y)``; copies collapse map-side before the shuffle."""
    return points.where(finite(x, y)).select(F.col(x).alias("x"), F.col(y).alias("y")).distinct()
