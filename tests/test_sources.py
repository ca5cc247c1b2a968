import os

import pytest

from planar.functions import render
from planar.sources.text import parse_boxes, read_boxes, read_points, split_rejects, write_lines

BOXES_CSV = "1,a,1,2,3,4\n2,b,3,4,1,2\n3,c,1,2,3,4,extra\n4,d,1\n5,e,zz,2,3,4\n6,f,NaN,2,3,4\n7,g, 1.5 ,2,3,4\n\n"


def _write(dirname, name, text):
    path = os.path.join(dirname, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_box_scan_and_rejects(spark, scratch):
    path = _write(scratch, "boxes.csv", BOXES_CSV)
    good, bad = split_rejects(parse_boxes(spark, path, id_col=1, first_coord=2))
    rows = sorted(good.collect(), key=lambda r: r.id)
    assert [r.id for r in rows] == ["a", "b", "c", "g"]
    assert (rows[3].x1, rows[3].y1, rows[3].x2, rows[3].y2) == (1.5, 2.0, 3.0, 4.0)
    assert (rows[1].x1, rows[1].y1) == (3.0, 4.0)  # corners kept as given
    assert sorted(r.line for r in bad.collect()) == sorted(["", "4,d,1", "5,e,zz,2,3,4", "6,f,NaN,2,3,4"])
    assert read_boxes(spark, path).count() == 4


def test_fail_mode_raises(spark, scratch):
    path = _write(scratch, "boxes.csv", BOXES_CSV)
    with pytest.raises(Exception):
        read_boxes(spark, path, on_error="fail").collect()


def test_join_inputs_id_first_trimmed(spark, scratch):
    path = _write(scratch, "q.csv", " p1 , 1.0, 2.0 ,3.0,4.0\np2,5,6,7,8\n")
    rows = sorted(read_boxes(spark, path, id_col=0, first_coord=1).collect(), key=lambda r: r.id)
    assert [r.id for r in rows] == ["p1", "p2"]
    assert rows[0].y1 == 2.0


def test_points_comma_blank(spark, scratch):
    path = _write(scratch, "points.txt", "1.0, 2.0\n3.5, -4.25\nbad\n")
    rows = sorted((r.x, r.y) for r in read_points(spark, path, sep=", ", x_col=0, y_col=1).collect())
    assert rows == [(1.0, 2.0), (3.5, -4.25)]


def test_points_first_corner(spark, scratch):
    path = _write(scratch, "box_rows.csv", "0,7,1.5,2.5,9,9\n")
    assert [(r.x, r.y) for r in read_points(spark, path).collect()] == [(1.5, 2.5)]


def test_write_lines_single_file(spark, scratch):
    path = _write(scratch, "boxes.csv", BOXES_CSV)
    boxes = read_boxes(spark, path)
    out = os.path.join(scratch, "out")
    write_lines(render.format_range(boxes.where("id = 'a'")), out, single_file=True)
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) == 1
    with open(os.path.join(out, parts[0])) as f:
        assert f.read().strip() == "ID: a  Coordinates:  1.0, 2.0;   3.0,  4.0"
    write_lines(render.format_range(boxes), out)  # overwrite
    assert spark.read.text(out).count() == 4


def test_renderings(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0, 25.0)], "ax double, ay double, bx double, by double, d2 double")
    assert [r.line for r in render.format_pair(df).collect()] == ["1.0,2.0", "3.0,4.0"]
    v = spark.createDataFrame([(1e10, -0.5)], "x double, y double")
    assert render.format_vertices(v).first().line == "(1.0E10, -0.5, NaN)"
    assert render.format_hull(v).first().line == "1.0E10,  -0.5"
    h = spark.createDataFrame([(7, 0)], "id long, n long")
    assert render.format_heat(h).first().line == "(7,0)"
    j = spark.createDataFrame([(3, "")], "id long, ids string")
    assert render.format_join(j).first().line == "3: "


def test_text_to_heat_map_lines(spark, scratch):
    from planar.operators.joins import containment_lists, heat_map

    boxes = _write(scratch, "rects.csv", "0,r1,0,0,10,10\n0,r2,20,20,5,5\n0,r3,30,30,31,31\nbroken\n")
    pts = _write(scratch, "pts.csv", "0,p,1,1\n0,p,6,6\n0,p,8,9\n0,p,10,5\n")
    out = os.path.join(scratch, "heat")
    heat = heat_map(read_boxes(spark, boxes), read_points(spark, pts))
    write_lines(render.format_heat(heat), out, single_file=True)
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["(r1,3)", "(r2,2)", "(r3,0)"]

    probes = _write(scratch, "probes.csv", "q1, 6,6,7,7\nq2,1,1,1,1\nq3,40,40,41,41\n")
    lists = containment_lists(read_boxes(spark, probes, id_col=0, first_coord=1), read_boxes(spark, boxes))
    got = sorted(r.line for r in render.format_join(lists).collect())
    assert got == ["q1: r1,r2", "q2: r1", "q3: "]


def test_ingest_writes_good_rows_and_rejects_in_one_pass(spark, scratch):
    import os

    from planar.sources.text import ingest, parse_boxes

    path = os.path.join(scratch, "in")
    lines = ["0,a,1,2,3,4", "0,b,1,2,3", "junk", "", "0,,1,2,3,4", "0,c,1,nan,3,4", "0, d , 5,6,7,8,extra"]
    spark.createDataFrame([(v,) for v in lines], "value string").repartition(3).write.text(path)
    out = os.path.join(scratch, "out")
    for _ in range(2):  # a rerun replaces the rows
        good, bad = ingest(parse_boxes(spark, path), out)
        assert sorted(tuple(r) for r in good.collect()) == [("a", 1.0, 2.0, 3.0, 4.0), ("d", 5.0, 6.0, 7.0, 8.0)]
        assert sorted(r.line for r in bad.collect()) == sorted(["0,b,1,2,3", "junk", "", "0,,1,2,3,4", "0,c,1,nan,3,4"])
    # The rows come from the folder, each kind from its own part of it.
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "FileScan parquet" in plan and "FileScan text" not in plan
    good, bad = ingest(parse_boxes(spark, spark.createDataFrame([], "value string")), os.path.join(scratch, "none"))
    assert good.count() == bad.count() == 0
