"""A third of all points in one grid cell, shuffle path: AQE splits the hot
cell and the result is still exact."""

import random

import pytest

from planar.operators.joins import heat_map, point_in_box_join
from tests import brute
from tests.conftest import boxes_df, points_df

SKEW_CONF = {
    "spark.planar.broadcastBytes": "0",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _data():
    rnd = random.Random(1)
    boxes = [(x, y, x + 3, y + 3) for x in range(0, 100, 5) for y in range(0, 100, 5)]
    pts = [(rnd.uniform(0, 100), rnd.uniform(0, 100)) for _ in range(4000)]
    pts += [(51 + rnd.random(), 51 + rnd.random()) for _ in range(2000)]  # the hot cell
    return boxes, pts


def test_hot_cell_is_split_and_exact(spark, skew_conf):
    boxes, pts = _data()
    df = point_in_box_join(boxes_df(spark, boxes), points_df(spark, pts, with_id=True))
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
    assert len(rows) == sum(n for _, n in brute.heat(boxes, pts))


def test_heat_map_shuffle_path_with_hot_cell(spark, skew_conf):
    boxes, pts = _data()
    pts += [pts[-1]] * 1500  # plus a hot group of exact copies
    got = sorted((r.id, r.n) for r in heat_map(boxes_df(spark, boxes), points_df(spark, pts)).collect())
    assert got == brute.heat(boxes, pts)
