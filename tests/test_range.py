import os

from planar.functions.geometry import box_ring, normalize_boxes
from planar.operators.range_query import range_query
from tests.conftest import boxes_df


def test_edges_included_and_corner_order_kept(spark):
    boxes = [(0, 0, 1, 1), (1, 1, 0, 0), (-0.5, 0, 1, 1), (0, 0, 2, 2), (2, 2, 1, 1), (float("nan"), 0, 1, 1)]
    got = sorted((r.id, r.x1, r.y1) for r in range_query(boxes_df(spark, boxes), (2, 2, 0, 0)).collect())
    assert got == [(0, 0.0, 0.0), (1, 1.0, 1.0), (3, 0.0, 0.0), (4, 2.0, 2.0)]


def test_filter_reaches_parquet_scan(spark, scratch):
    path = os.path.join(scratch, "b.parquet")
    boxes_df(spark, [(0, 0, 1, 1), (5, 5, 6, 6)]).write.parquet(path)
    df = range_query(spark.read.parquet(path), (-1, -1, 2, 2)).select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(x1)" in plan and "GreaterThanOrEqual(x1,-1.0)" in plan
    assert [r.id for r in df.collect()] == [0]


def test_normalize_and_ring(spark):
    b = normalize_boxes(boxes_df(spark, [(3, 4, 1, 2)])).first()
    assert (b.xmin, b.ymin, b.xmax, b.ymax) == (1.0, 2.0, 3.0, 4.0)
    ring = boxes_df(spark, [(3, 4, 1, 2)]).select(box_ring("x2", "y2", "x1", "y1").alias("r")).first().r
    assert [(p.x, p.y) for p in ring] == [(1.0, 2.0), (3.0, 2.0), (3.0, 4.0), (1.0, 4.0), (1.0, 2.0)]
