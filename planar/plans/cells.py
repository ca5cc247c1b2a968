"""Tasks that hold one side of a cell and stream the other past it.

Pairs that only serve to be gathered again (the list of boxes around a probe)
cost a shuffled row each when they are joined and grouped.  Here both sides
are dealt to cells by a shuffle, the held rows of a cell come first, and each
batch of streamed rows is answered from them: what is shuffled follows the
input, not the pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1 << 18  # streamed rows of a cell that one task answers

CELL = ("cx", "cy")


def spread_hot(held: DataFrame, streamed: DataFrame, hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``copy``: the rows of a cell with more than
    ``hot_rows`` streamed rows are dealt to several copies of the held ones
    (``streamed`` must give the same rows in the same order when read again)."""
    n = streamed.groupBy(*CELL).count().where(F.col("count") > hot_rows)
    hot = n.select(*CELL, F.ceil(F.col("count") / hot_rows).alias("_k")).collect()  # at most a row per hot_rows rows
    if not hot:
        return held.withColumn("copy", F.lit(0)), streamed.withColumn("copy", F.lit(0))
    k = F.broadcast(held.sparkSession.createDataFrame(hot, "cx long, cy long, _k long"))
    many = F.coalesce("_k", F.lit(1))
    return (
        held.join(k, list(CELL), "left").withColumn("copy", F.explode(F.sequence(F.lit(0), (many - 1).cast("int")))).drop("_k"),
        streamed.withColumn("_at", F.monotonically_increasing_id()).join(k, list(CELL), "left")
        .withColumn("copy", F.pmod("_at", many).cast("int")).drop("_k", "_at"),
    )


def answer_cells(
    held: DataFrame, streamed: DataFrame, order: list[str], build: Callable, answer: Callable, schema: str, hot_rows: int | None = None
) -> DataFrame:
    """``answer(build(held rows), streamed batch)`` for each cell.

    Both sides have the columns ``cx, cy`` (long) and the same others; within
    a cell the rows follow ``order``.  ``build`` and ``answer`` get Arrow
    tables and batches, ``answer`` yields batches of ``schema``; streamed rows
    of a cell without held rows get ``None``."""
    held, streamed = spread_hot(held, streamed, hot_rows or HOT_ROWS)
    keys = [*CELL, "copy"]
    rows = held.withColumn("streamed", F.lit(False)).unionByName(streamed.withColumn("streamed", F.lit(True)))
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "streamed", *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, made = None, [], None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            at = np.column_stack([batch.column(k).to_numpy() for k in keys])
            late = batch.column("streamed").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((at[1:] != at[:-1]).any(axis=1) | (late[1:] != late[:-1])) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
                now = tuple(at[s].tolist())
                if now != key:
                    key, parts, made = now, [], None
                if not late[s]:
                    parts.append(batch.slice(s, e - s))
                    continue
                if parts:
                    made, parts = build(pa.Table.from_batches(parts)), []
                yield from answer(made, batch.slice(s, e - s))

    return rows.mapInArrow(run, schema)
