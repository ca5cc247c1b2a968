
import random

import pytest

from planar.operators.closest import closest_pair
from planar.operators.joins import containment_lists, heat_map
from planar.operators.union import box_union_vertices
from tests import brute
from tests.conftest import boxes_df, points_df

rnd = random.Random(13)
BOXES = [(rnd.randint(0, 40), rnd.randint(0, 40), rnd.randint(0, 40), rnd.randint(0, 40)) for _ in range(60)]
BOXES += [(5, 5, 5, 20), (7, 7, 7, 7)]  # zero-area boxes: contain nothing, add no corner
POINTS = [(rnd.uniform(0, 40), rnd.uniform(0, 40)) for _ in range(900)] + [(7.0, 7.0)] * 5


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_heat_map(spark, parts):
    got = heat_map(boxes_df(spark, BOXES).repartition(parts), points_df(spark, POINTS).repartition(parts))
    assert sorted((r.id, r.n) for r in got.collect()) == brute.heat(BOXES, POINTS)


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_containment_lists(spark, parts):
    probes = [(x, y, x + 1, y + 1) for x, y in POINTS[:200]]
    got = containment_lists(boxes_df(spark, probes).repartition(parts), boxes_df(spark, BOXES).repartition(parts))
    want = {i: [] for i in range(len(probes))}
    for i, j in brute.containment(probes, BOXES):
        want[i].append(j)
    want = {i: ",".join(str(j) for j in sorted(js, key=lambda j: (brute.norm(BOXES[j])[0], j))) for i, js in want.items()}
    assert {r.id: r.ids for r in got.collect()} == want


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_closest_pair(spark, parts):
    row = closest_pair(points_df(spark, POINTS).repartition(parts)).first()
    assert tuple(row) == brute.closest(POINTS)


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_union(spark, parts):
    got = {(r.x, r.y) for r in box_union_vertices(boxes_df(spark, BOXES).repartition(parts)).collect()}
    assert got == brute.union_vertices_raster(BOXES)
