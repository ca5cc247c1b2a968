import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from planar.plans.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, app="planar-tests")
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)


def points_df(spark, pts, with_id=False):
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(pts)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    return df if with_id else df.select("x", "y")


def boxes_df(spark, boxes):
    rows = [(i, float(a), float(b), float(c), float(d)) for i, (a, b, c, d) in enumerate(boxes)]
    return spark.createDataFrame(rows, "id long, x1 double, y1 double, x2 double, y2 double")
