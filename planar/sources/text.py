"""Delimited text sources for points and boxes, reject handling, text sink.

Lines are read with ``spark.read.text`` and split with ``split`` + ``get`` +
``try_cast``: extra trailing fields are tolerated, missing or unparsable
ones become NULL, and the row goes to the rejects instead of failing the job.
Fields are trimmed.  A row is good when its id (if any) is present and all
coordinates are finite.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from planar.functions.geometry import finite


def _fields(sep: str) -> Column:
    # \Q..\E quotes the separator for the JVM regex used by split().
    return F.split(F.col("value"), "\\Q" + sep + "\\E", -1)


def _num(f: Column, i: int) -> Column:
    return F.trim(F.get(f, i)).try_cast("double")


def parse_lines(
    lines: DataFrame,
    coords: dict[str, int],
    id_col: int | None = None,
    sep: str = ",",
) -> DataFrame:
    """Parse a ``value`` text column into id + coordinate columns, keeping
    the raw line in ``line`` and a ``_good`` flag."""
    f = _fields(sep)
    cols = [F.col("value").alias("line")]
    if id_col is not None:
        cols.append(F.trim(F.get(f, id_col)).alias("id"))
    cols += [_num(f, i).alias(name) for name, i in coords.items()]
    parsed = lines.select(*cols)
    good = finite(*coords)
    if id_col is not None:
        good = good & F.col("id").isNotNull() & (F.col("id") != "")
    return parsed.withColumn("_good", good)


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good rows without the raw line, rejected raw lines as ``line``)``."""
    good = parsed.where(F.col("_good")).drop("_good", "line")
    bad = parsed.where(~F.col("_good")).select("line")
    return good, bad


def ingest(parsed: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write parsed lines below ``path`` in one pass, good rows and rejected
    lines apart, and return both as read from there: ``(good, rejects)`` as
    by ``split_rejects``.  The text is read and parsed once; a rerun replaces
    what an earlier one wrote."""
    rows = parsed.withColumn("line", F.when(~F.col("_good"), F.col("line")))
    rows.write.mode("overwrite").partitionBy("_good").parquet(path)
    return split_rejects(parsed.sparkSession.read.schema(rows.schema).parquet(path))


def _finish(parsed: DataFrame, on_error: str) -> DataFrame:
    if on_error == "reject":
        return split_rejects(parsed)[0]
    if on_error == "fail":
        msg = F.concat(F.lit("malformed row: "), F.col("line"))
        checked = parsed.withColumn("_chk", F.when(~F.col("_good"), F.raise_error(msg)))
        return checked.where(F.col("_good") | F.col("_chk").isNull()).drop("_good", "line", "_chk")
    raise ValueError("on_error must be 'reject' or 'fail'")


def read_boxes(
    spark: SparkSession,
    path: str | DataFrame,
    id_col: int | None = 1,
    first_coord: int = 2,
    sep: str = ",",
    on_error: str = "reject",
) -> DataFrame:
    """Boxes ``(id, x1, y1, x2, y2)`` from delimited text; corners in any order.

    ``path`` is a path, or a DataFrame whose ``value`` column holds the lines.
    Defaults: id in field 1, corners from field 2 (field 0 ignored).  Inputs
    with the id first: ``id_col=0, first_coord=1``.
    """
    parsed = parse_boxes(spark, path, id_col, first_coord, sep)
    return _finish(parsed, on_error)


def _lines(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    return path if isinstance(path, DataFrame) else spark.read.text(path)


def parse_boxes(spark, path, id_col=1, first_coord=2, sep=","):
    coords = {n: first_coord + k for k, n in enumerate(("x1", "y1", "x2", "y2"))}
    return parse_lines(_lines(spark, path), coords, id_col, sep)


def read_points(
    spark: SparkSession,
    path: str | DataFrame,
    x_col: int = 2,
    y_col: int = 3,
    sep: str = ",",
    id_col: int | None = None,
    on_error: str = "reject",
) -> DataFrame:
    """Points ``([id,] x, y)`` from delimited text.  Defaults read the first
    corner of a box row (fields 2 and 3); plain ``x, y`` lines are
    ``sep=', ', x_col=0, y_col=1``."""
    parsed = parse_points(spark, path, x_col, y_col, sep, id_col)
    return _finish(parsed, on_error)


def parse_points(spark, path, x_col=2, y_col=3, sep=",", id_col=None):
    return parse_lines(_lines(spark, path), {"x": x_col, "y": y_col}, id_col, sep)


def one_part(df: DataFrame) -> DataFrame:
    """The rows of a one-column DataFrame as lines, in one partition."""
    if len(df.columns) != 1:
        raise ValueError("expected exactly one (string) column")
    return df.select(F.col(df.columns[0]).cast("string").alias("value")).repartition(1)


def write_lines(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite ``path`` with the rows of a one-column string DataFrame.

    ``single_file`` shuffles to one partition first (``repartition(1)``,
    not ``coalesce(1)``, so the upstream stage keeps its parallelism).
    """
    if len(df.columns) != 1:
        raise ValueError("write_lines expects exactly one (string) column")
    out = one_part(df) if single_file else df.select(F.col(df.columns[0]).cast("string").alias("value"))
    out.write.mode("overwrite").text(path)
