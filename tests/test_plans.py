"""Plan shape: range joins run as equi-joins, never as nested loops."""

import re

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as E
from planar.operators import closest as C
from planar.operators import hull as H
from planar.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def _executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _equi_join_only(plan, name):
    assert "CartesianProduct" not in plan, name
    assert "BroadcastNestedLoopJoin" not in plan, name
    assert "HashJoin" in plan or "SortMergeJoin" in plan, name


def test_joins_are_equi_joins(spark):
    for name in ("heat_map", "point_in_box_join", "containment_join", "containment_lists"):
        _equi_join_only(_executed(E.queries()[name](spark, SF)), name)
    # The union's last step sweeps cells: one shuffle, no join of any kind.
    plan = _executed(E.queries()["box_union_vertices_part"](spark, SF))
    assert "Join" not in plan and "CartesianProduct" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_closest_pair_grid_is_an_equi_join(spark, monkeypatch):
    monkeypatch.setattr(C, "BASE_ROWS", 100)  # take the sampled-bound path
    _equi_join_only(_executed(E.queries()["closest_pair_ord"](spark, SF)), "closest_pair_ord")


def test_hull_moves_only_partial_hulls(spark):
    plan = _executed(E.queries()["convex_hull_line"](spark, SF))
    # The partitions' hulls are written first; the final step reads them.
    assert plan.count("MapInPandas") == 1 and "FileScan" not in plan
    assert "RoundRobinPartitioning(1)" in plan or "SinglePartition" in plan
    points = fx.points_line(spark, SF)
    assert H._candidates(points, "x", "y").count() < points.count() / 10


def _brute_closest(pts):
    pts = np.unique(pts, axis=0)
    best = None
    for i in range(len(pts) - 1):
        d = pts[i + 1:] - pts[i]
        d2 = d[:, 0] * d[:, 0] + d[:, 1] * d[:, 1]
        k = int(np.argmin(d2))  # first minimum: smallest b in (x, y) order
        cand = (float(d2[k]), *pts[i], *pts[i + 1 + k])
        if best is None or cand < best:
            best = cand
    d2, ax, ay, bx, by = best
    return (ax, ay, bx, by, d2)


def test_closest_pair_line_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(C, "BASE_ROWS", 500)
    got = tuple(E.queries()["closest_pair_line"](spark, SF).first())
    rows = spark.read.parquet(f"{SF}/lineitem.parquet").selectExpr("l_quantity", "round(l_extendedprice*100)").collect()
    assert got == _brute_closest(np.array([tuple(r) for r in rows], dtype=float))


def test_heat_map_prunes_and_pushes_into_the_point_scan(spark, scratch):
    import os

    from planar.operators.joins import heat_map
    from tests.conftest import boxes_df, points_df

    path = os.path.join(scratch, "pts.parquet")
    points_df(spark, [(i % 50, i // 50) for i in range(500)], with_id=True).withColumn("payload", F.lit("z")).write.parquet(path)
    df = heat_map(boxes_df(spark, [(1, 1, 5, 5), (10, 2, 20, 4)]), spark.read.parquet(path))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [l for l in plan.splitlines() if "FileScan parquet" in l]
    assert scans
    for scan in scans:
        assert re.search(r"FileScan parquet \[x#\d+,y#\d+\]", scan)  # id and payload pruned
        assert "GreaterThanOrEqual(x,1.0)" in scan and "LessThanOrEqual(x,20.0)" in scan  # box extent pushed


def _no_broadcast(spark, monkeypatch, make):
    """Runs ``make()`` without the broadcast budget and returns the joins of
    its own and all checkpointed plans."""
    from pyspark.sql.classic.dataframe import DataFrame

    plans, keep = [], DataFrame.checkpoint

    def checkpoint(self, *a, **k):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return keep(self, *a, **k)

    monkeypatch.setattr(DataFrame, "checkpoint", checkpoint)
    spark.conf.set("spark.planar.broadcastBytes", "0")
    try:
        plans.append(_executed(make()))
    finally:
        spark.conf.unset("spark.planar.broadcastBytes")
    return plans


def test_joins_broadcast_no_side_on_its_file_size(spark, monkeypatch):
    """Spark takes a small file for a small side, whatever its boxes make."""
    for name in ("containment_join", "point_in_box_join", "containment_lists", "heat_map"):
        for plan in _no_broadcast(spark, monkeypatch, lambda: E.queries()[name](spark, SF)):  # noqa: B023
            assert "BroadcastHashJoin" not in plan, name


def test_heat_map_by_cells_broadcasts_no_side_on_its_file_size(spark, monkeypatch):
    from planar.operators.joins import heat_map

    make = lambda: heat_map(fx.boxes_part(spark, SF), fx.points_ev(spark, SF), nest_matches=0.0)
    monkeypatch.setattr("planar.operators.joins.NEST_OVERLAP", 0.0)
    plans = _no_broadcast(spark, monkeypatch, make)
    assert len(plans) > 1 and not any("BroadcastHashJoin" in p for p in plans)


def test_union_broadcasts_no_side_on_its_file_size(spark, monkeypatch):
    plans = _no_broadcast(spark, monkeypatch, lambda: E.queries()["box_union_vertices_part"](spark, SF))
    assert any("SortMergeJoin" in p for p in plans) and not any("BroadcastHashJoin" in p for p in plans)
