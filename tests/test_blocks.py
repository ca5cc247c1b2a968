"""Points that go through a join in blocks: the same pairs, in small files."""

import os
import random

import pytest
from pyspark.sql import functions as F

from planar.functions.geometry import point_in_box
from planar.operators.joins import point_in_box_join
from planar.plans import blocks as B
from planar.plans import grid as G
from tests.conftest import boxes_df, points_df


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    spark.conf.set(G.BROADCAST_CONF, "0")
    monkeypatch.setattr(G, "BLOCK_OVERLAP", 2.0)  # the real one takes more boxes than a test
    yield
    spark.conf.unset(G.BROADCAST_CONF)


def _heap(seed, boxes, points):
    """Boxes between two points of a heap, as between two embeddings."""
    rnd = random.Random(seed)
    b = [tuple(rnd.gauss(0, 0.1) for _ in range(4)) for _ in range(boxes)]
    return b, [(rnd.gauss(0, 0.1), rnd.gauss(0, 0.1)) for _ in range(points)]


def _inside(b, x, y):
    return min(b[0], b[2]) < x < max(b[0], b[2]) and min(b[1], b[3]) < y < max(b[1], b[3])


def _bytes(df, path):
    df.coalesce(1).write.parquet(path)
    return sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.endswith(".parquet"))


@pytest.mark.parametrize("far", [0.0, 1e7])
def test_pairs_of_overlapping_boxes_take_little_room(spark, scratch, no_broadcast, far):
    """Far more pairs than input: a box's id stands still while points of a
    block pass, so that a pair takes far less than its two numbers."""
    boxes, pts = _heap(1, 1500, 1500)
    boxes[0] = tuple(v + far for v in boxes[0])
    df = point_in_box_join(boxes_df(spark, boxes), points_df(spark, pts, with_id=True))
    rows = [tuple(r) for r in df.collect()]
    want = {(i, k) for i, b in enumerate(boxes) for k, (x, y) in enumerate(pts) if _inside(b, x, y)}
    assert len(rows) == len(want) and set(rows) == want
    assert 8 * sum(a[0] != b[0] and a[1] != b[1] for a, b in zip(rows, rows[1:])) < len(rows)
    plain = spark.createDataFrame(sorted(rows, key=lambda r: (r[1], r[0])), df.schema)  # point by point
    assert _bytes(df, f"{scratch}/a") < 0.6 * _bytes(plain, f"{scratch}/b")


@pytest.mark.parametrize("size,group,most", [(1, 7, 50), (16, 1 << 12, 400), (64, 100, 1 << 27)])
def test_cells_are_dealt_to_tasks(spark, monkeypatch, no_broadcast, size, group, most):
    """Hot cells in many groups of blocks and boxes: each pair once, with
    copies of points and boxes, null ids and ids that repeat."""
    monkeypatch.setattr(B, "BLOCK", size)
    monkeypatch.setattr(B, "GROUP_BOXES", group)
    monkeypatch.setattr(B, "TASK_PAIRS", most)
    boxes, pts = _heap(2, 300, 250)
    boxes += boxes[:9] + [(0.0, 0.0, 0.0, 0.3)]
    pts += pts[:5] * 30 + [(boxes[3][0], boxes[4][1])]
    ids = F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 200)
    b, p = (df.withColumn("id", ids) for df in (boxes_df(spark, boxes), points_df(spark, pts, with_id=True)))
    of = lambda i: None if i % 11 == 0 else i % 200
    want = [(of(i), of(k)) for i, c in enumerate(boxes) for k, (x, y) in enumerate(pts) if _inside(c, x, y)]
    got = point_in_box_join(b, p)
    assert got.columns == ["box_id", "point_id"]
    assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_other_types_go_through_blocks(spark, no_broadcast):
    """Decimal coordinates, ids of any type and columns beside them."""
    boxes, pts = _heap(3, 200, 150)
    b = boxes_df(spark, boxes).select("id", *[F.col(c).cast("decimal(20,6)").alias(c) for c in ("x1", "y1", "x2", "y2")])
    p = points_df(spark, pts, with_id=True).select(
        F.struct(F.col("id").alias("n"), F.lit("a").alias("t")).alias("id"), F.col("x").cast("decimal(20,6)").alias("x"), F.col("y").cast("float").alias("y")
    )
    got = point_in_box_join(b, p)
    assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
    near = F.broadcast(p.selectExpr("id.n as point_id", "x as px", "y as py"))
    box = b.selectExpr("id as box_id", "least(x1, x2) as xmin", "least(y1, y2) as ymin", "greatest(x1, x2) as xmax", "greatest(y1, y2) as ymax")
    want = box.crossJoin(near).where(point_in_box("px", "py", "xmin", "ymin", "xmax", "ymax")).select("box_id", "point_id")
    assert sorted(map(tuple, got.select("box_id", "point_id.n").collect())) == sorted(map(tuple, want.collect()))


def test_boxes_apart_need_no_blocks(spark, no_broadcast):
    boxes = [(x, y, x + 3, y + 3) for x in range(0, 100, 5) for y in range(0, 100, 5)]
    df = point_in_box_join(boxes_df(spark, boxes), points_df(spark, [(51.5, 51.5), (54.0, 54.0)], with_id=True))
    assert "MapInArrow" not in df._jdf.queryExecution().executedPlan().toString()
    assert [r.point_id for r in df.collect()] == [0]


def test_one_far_box_does_not_hide_a_crowd(spark, no_broadcast):
    """Boxes of one size, one of them far off: the others still overlap."""
    rnd = random.Random(4)
    boxes = [(x, y, x + 0.3, y + 0.3) for x, y in ((rnd.random(), rnd.random()) for _ in range(200))]
    boxes[0] = tuple(v + 1e7 for v in boxes[0])
    pts = [(rnd.random(), rnd.random()) for _ in range(100)]
    got = point_in_box_join(boxes_df(spark, boxes), points_df(spark, pts, with_id=True))
    assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect())) == [(i, k) for i, b in enumerate(boxes) for k, (x, y) in enumerate(pts) if _inside(b, x, y)]


def test_a_huge_box_makes_no_crowd(spark, no_broadcast):
    boxes = [(x, y, x + 3, y + 3) for x in range(0, 100, 5) for y in range(0, 100, 5)] + [(-1e7, -1e7, 1e7, 1e7)]
    df = point_in_box_join(boxes_df(spark, boxes), points_df(spark, [(51.5, 51.5), (54.0, 54.0)], with_id=True))
    assert "MapInArrow" not in df._jdf.queryExecution().executedPlan().toString()
    assert len(df.collect()) == 3
