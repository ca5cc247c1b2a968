import random

import numpy as np
import pytest

from planar.operators import union as U
from planar.operators.union import box_union_vertices
from tests import brute
from tests.conftest import boxes_df

SHAPES = {
    "touching": [(0, 0, 2, 2), (2, 0, 4, 2)],
    "corner_touch": [(0, 0, 2, 2), (2, 2, 4, 4)],
    "nested": [(0, 0, 10, 10), (2, 2, 4, 4)],
    "cross": [(0, 2, 6, 4), (2, 0, 4, 6)],
    "hole": [(0, 0, 6, 2), (0, 4, 6, 6), (0, 0, 2, 6), (4, 0, 6, 6)],
    "zero_area": [(0, 0, 0, 5), (1, 1, 3, 1)],
    "swapped": [(2, 2, 0, 0), (3, 1, 1, 3)],
}

EXPECTED = {"touching": 4, "corner_touch": 7, "nested": 4, "cross": 12, "hole": 8, "zero_area": 0}


def _verts(spark, boxes):
    return {(r.x, r.y) for r in box_union_vertices(boxes_df(spark, boxes)).collect()}


@pytest.mark.parametrize("name", list(SHAPES))
def test_shapes(spark, name):
    got = _verts(spark, SHAPES[name])
    assert got == brute.union_vertices_raster(SHAPES[name])
    if name in EXPECTED:
        assert len(got) == EXPECTED[name]


def test_corner_touch_keeps_shared_point(spark):
    assert (2.0, 2.0) in _verts(spark, SHAPES["corner_touch"])


@pytest.mark.parametrize("seed", range(5))
def test_random_lattice_against_raster(spark, seed):
    rnd = random.Random(seed)
    boxes = []
    for _ in range(30):
        x, y = rnd.randint(0, 34), rnd.randint(0, 34)
        boxes.append((x, y, x + rnd.randint(0, 4), y + rnd.randint(0, 4)))
    boxes.append((0, 0, 38, 1))  # one long box
    assert _verts(spark, boxes) == brute.union_vertices_raster(boxes)


@pytest.mark.parametrize("seed", range(3))
def test_small_cells_and_slabs(spark, monkeypatch, seed):
    monkeypatch.setattr(U, "CELL_WORK", 10)
    rnd = random.Random(seed)
    boxes = [(x, y, x + rnd.randint(1, 9), y + rnd.randint(1, 9)) for x, y in ((rnd.randint(0, 30), rnd.randint(0, 30)) for _ in range(60))]
    boxes += [(4, 4, 8, 8), (8, 8, 12, 12), (4, 8, 8, 9), (16, 0, 17, 38), (0, 16, 38, 17)]
    assert _verts(spark, boxes) == brute.union_vertices_raster(boxes)


@pytest.mark.parametrize("sweep", [1, 50, 1 << 22])
def test_cell_corners_in_chunks(monkeypatch, sweep):
    monkeypatch.setattr(U, "SWEEP", sweep)
    rnd = random.Random(9)
    for _ in range(20):
        boxes = [(x, y, x + rnd.randint(1, 6), y + rnd.randint(1, 6)) for x, y in ((rnd.randint(0, 20), rnd.randint(0, 20)) for _ in range(25))]
        got = set()
        for cx in range(0, 32, 8):
            for cy in range(0, 32, 8):
                near = np.array([b for b in boxes if b[2] >= cx and b[0] < cx + 8 and b[3] >= cy and b[1] < cy + 8], float).reshape(-1, 4)
                x, y = U.cell_corners(near, cx, cy, cx + 8, cy + 8)
                here = list(zip(x.tolist(), y.tolist()))
                assert len(here) == len(set(here)) and got.isdisjoint(here)
                got |= set(here)
        assert got == brute.union_vertices_raster(boxes)


def _rows(spark, boxes):
    from planar.functions.geometry import normalize_boxes

    r = normalize_boxes(boxes_df(spark, boxes)).select("xmin", "ymin", "xmax", "ymax").distinct()
    return U.outline_cells(r, U._first_level(r)).count()


def test_rows_follow_the_outline(spark):
    """Nested boxes leave the rows of the outermost outline only; their
    number does not grow with the boxes inside."""
    nested = lambda n: [(i / n, i / n, 200 - i / n, 200 - i / n) for i in range(n)]
    few, many = _rows(spark, nested(50)), _rows(spark, nested(1000))
    assert many <= 40 * 1000 and many <= 25 * few
    assert _verts(spark, nested(1000)) == {(0.0, 0.0), (0.0, 200.0), (200.0, 0.0), (200.0, 200.0)}
    inside = [(10.0, 10.0, 190.0, 190.0)] + [(x, y, x + 3, y + 3) for x, y in ((20 + i * 0.01, 20 + i % 150) for i in range(1000))]
    assert _rows(spark, inside) <= 2000
    assert _verts(spark, inside) == {(10.0, 10.0), (10.0, 190.0), (190.0, 10.0), (190.0, 190.0)}


def test_many_boxes_at_one_corner(spark):
    boxes = [(0, 0, 1 + i, 1 + (400 - i)) for i in range(400)]  # a staircase: every box touches the origin
    want = {(0.0, 0.0), (0.0, 401.0), (400.0, 0.0)}
    for i in range(400):
        want.add((1.0 + i, 401.0 - i))
        if i < 399:
            want.add((1.0 + i, 400.0 - i))
    assert _verts(spark, boxes) == want


def test_far_apart_and_tiny_boxes(spark):
    boxes = [(0, 0, 1e-7, 1e-7), (0, 0, 2e-7, 5e-8), (1e9, 1e9, 1e9 + 1, 1e9 + 1), (-1e12, 0, -1e12 + 0.5, 1e6)]
    got = _verts(spark, boxes)
    assert len(got) == 6 + 4 + 4 and (1e-7, 5e-8) in got
