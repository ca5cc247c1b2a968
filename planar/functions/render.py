"""Text renderings of results, one ``line`` column each.

Doubles are rendered with Spark's ``cast(double as string)``, which prints
like the JVM (``1.0``, ``1.0E10``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _s(c: str) -> Column:
    return F.col(c).cast("string")


# Fixed output layouts (must stay exactly as written):
#   range query  "ID: <id>  Coordinates:  <x1>, <y1>;   <x2>,  <y2>"
#   hull vertex  "<x>,  <y>"
#   pair point   "<x>,<y>"  (two lines per pair)
#   union vertex "(<x>, <y>, NaN)"
#   heat map     "(<id>,<n>)"
#   join         "<id>: <id1>,<id2>,..."  ("<id>: " when empty)


def format_range(df: DataFrame) -> DataFrame:
    return df.select(
        F.concat(
            F.lit("ID: "), _s("id"), F.lit("  Coordinates:  "), _s("x1"), F.lit(", "), _s("y1"),
            F.lit(";   "), _s("x2"), F.lit(",  "), _s("y2"),
        ).alias("line")
    )


def format_hull(df: DataFrame) -> DataFrame:
    return df.select(F.concat(_s("x"), F.lit(",  "), _s("y")).alias("line"))


def format_pair(df: DataFrame) -> DataFrame:
    a = F.concat(_s("ax"), F.lit(","), _s("ay"))
    b = F.concat(_s("bx"), F.lit(","), _s("by"))
    return df.select(F.explode(F.array(a, b)).alias("line"))


def format_vertices(df: DataFrame) -> DataFrame:
    return df.select(F.concat(F.lit("("), _s("x"), F.lit(", "), _s("y"), F.lit(", NaN)")).alias("line"))


def format_heat(df: DataFrame) -> DataFrame:
    return df.select(F.concat(F.lit("("), _s("id"), F.lit(","), _s("n"), F.lit(")")).alias("line"))


def format_join(df: DataFrame) -> DataFrame:
    return df.select(F.concat(_s("id"), F.lit(": "), F.col("ids")).alias("line"))
