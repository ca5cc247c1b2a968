"""Points that go through a join in blocks.

Where many boxes hold a point, nearly all rows of a join are pairs that
follow from one another: the next point of the place lies in the same boxes.
Here the points of a cell are sorted along a curve and packed, some
neighbours to a row.  Boxes meet the blocks whose bounds they overlap, and
the pairs come out block by block, box by box: a box's id stands still while
the points of the block pass, and the next box has the same points again.
That is the order in which columns of a file are smallest, and most pairs of
a box and a point that lie apart are never compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from planar.plans.session import ship_package

BLOCK = 128            # most points of a block
GROUP_BOXES = 1 << 12  # boxes that a block meets at once
TASK_PAIRS = 1 << 27   # most pairs of a point and a box of one cell in a task
LEAST_PAIRS = 1 << 22  # pairs from which there is one more task, up to spark.sql.shuffle.partitions
CURVE_BITS = 16        # bits of each axis that order a cell's points
SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))  # steps that put a zero before each of them

_EDGES = ("_x0", "_y0", "_x1", "_y1")


def _along(v: Column, side: Column, cell: Column) -> Column:
    """Place of a coordinate in its cell, in steps of the curve."""
    top = (1 << CURVE_BITS) - 1
    return F.greatest(F.lit(0), F.least(F.lit(top), F.floor((v / side - cell) * (top + 1)))).cast("long")


def point_blocks(points: DataFrame, point: tuple[str, str], keys: list[str], sides: tuple[Column, Column], size: int | None = None) -> DataFrame:
    """``keys``, the bounds of a block's points and ``_points``: their rows.

    ``keys``: level and cell of each point; ``sides``: its cell's sides.  A
    sort by key and curve deals cells of any size to all tasks; it goes on
    with the other columns, so that a task run again makes the same blocks."""
    ship_package(points.sparkSession)
    size = size or BLOCK
    _, cx, cy = map(F.col, keys)
    held = [c for c in points.columns if c not in keys]
    rows = points.withColumns({n: _along(F.col(c).cast("double"), *at) for n, c, *at in (("_u", point[0], sides[0], cx), ("_v", point[1], sides[1], cy))})
    for shift, mask in SPREAD:
        rows = rows.withColumns({c: F.col(c).bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask).cast("long")) for c in ("_u", "_v")})
    rows = rows.withColumn("_curve", F.shiftleft("_v", 1).bitwiseOR(F.col("_u"))).drop("_u", "_v").sort(*keys, "_curve", *held)
    rows = rows.withColumns({n: F.col(c).cast("double") for n, c in zip(("_x", "_y"), point)})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            at = np.column_stack([batch.column(k).to_numpy() for k in keys])
            new = np.concatenate([[True], (at[1:] != at[:-1]).any(axis=1)])
            place = np.arange(len(at))
            place -= np.maximum.accumulate(np.where(new, place, 0))
            cuts = np.flatnonzero(place % size == 0)
            x, y = (batch.column(c).to_numpy() for c in ("_x", "_y"))
            edges = [f.reduceat(v, cuts) for f, v in ((np.minimum, x), (np.minimum, y), (np.maximum, x), (np.maximum, y))]
            each = pa.StructArray.from_arrays([batch.column(c) for c in held], names=held)
            lists = pa.ListArray.from_arrays(pa.array(np.append(cuts, len(at)), pa.int32()), each)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k).take(pa.array(cuts)) for k in keys], *map(pa.array, edges), lists], names=[*keys, *_EDGES, "_points"]
            )

    schema = points.schema
    return rows.mapInArrow(pack, StructType([
        *[schema[k] for k in keys], *[StructField(e, DoubleType()) for e in _EDGES],
        StructField("_points", ArrayType(StructType([schema[c] for c in held]), containsNull=False)),
    ]))


def deal(
    blocks: DataFrame, boxes: DataFrame, points: DataFrame, keys: list[str], box_keys: list[str], most: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Blocks and boxes with ``_pn`` and ``_bn``, dealt by these and the cell,
    since what a task does are pairs and not bytes.  A cell of very many is
    dealt as a numbered table, groups of its blocks by groups of about
    ``GROUP_BOXES`` boxes; each block goes to all groups of boxes and each box
    to all groups of blocks.  So few boxes because the rows that a block makes
    with its cell's boxes are in memory together.

    ``points``: the rows that ``blocks`` were made of."""
    most = most or TASK_PAIRS
    spark = blocks.sparkSession
    n = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("_np"))
    m = boxes.groupBy(*box_keys).agg(F.count(F.lit(1)).alias("_nb"))
    cells = n.join(m.hint("merge"), [F.col(a) == F.col(b) for a, b in zip(keys, box_keys)])
    pairs = F.col("_np").cast("double") * F.col("_nb")
    i = F.ceil(F.least(F.col("_nb"), F.lit(GROUP_BOXES)) * F.col("_np") / most).cast("int")
    j = F.ceil(F.col("_nb") / GROUP_BOXES).cast("int")
    hot = F.when((i > 1) | (j > 1), F.struct(*keys, i.alias("_i"), j.alias("_j")))
    found = cells.agg(F.sum(pairs).alias("pairs"), F.collect_list(hot).alias("hot")).first()  # a cell per group's boxes or task's pairs at most
    total, hot = found["pairs"] or 0, found["hot"]
    tasks = max(min(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total / LEAST_PAIRS)), 2 * int(total / most)) + 1
    schema = StructType([*[points.schema[k] for k in keys], StructField("_i", IntegerType()), StructField("_j", IntegerType())])
    table = spark.createDataFrame(hot, schema)

    def dealt(df: DataFrame, at: list[str], own: str, all_: str) -> DataFrame:
        many = table.withColumnsRenamed(dict(zip(keys, at)))
        rest = [c for c in df.columns if c not in at and c not in _EDGES]
        df = df.join(F.broadcast(many), at, "left").fillna(1, ["_i", "_j"])
        df = df.withColumn("_own", F.pmod(F.xxhash64(*rest), F.col(own)).cast("int"))
        return df.withColumn("_each", F.explode(F.sequence(F.lit(0), F.col(all_) - 1)))

    number = lambda i, j: F.col(i) * F.col("_j") + F.col(j)
    rest = ["_i", "_j", "_own", "_each"]
    blocks = dealt(blocks, keys, "_i", "_j").withColumn("_pn", number("_own", "_each")).drop(*rest)
    boxes = dealt(boxes, box_keys, "_j", "_i").withColumn("_bn", number("_each", "_own")).drop(*rest)
    return blocks.repartition(tasks, *keys, "_pn"), boxes.repartition(tasks, *box_keys, "_bn")


def meets(xmin: str, ymin: str, xmax: str, ymax: str) -> Column:
    """Whether a block's bounds and a box have a place in common."""
    x0, y0, x1, y1 = map(F.col, _EDGES)
    return (x0 <= F.col(xmax)) & (x1 >= F.col(xmin)) & (y0 <= F.col(ymax)) & (y1 >= F.col(ymin))
