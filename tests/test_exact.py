import math
import random
import time

import numpy as np
import pytest

from planar.operators.exact import _rational, turn, turn_signs
from planar.operators.hull import hull_vertices


def triple(rnd):
    kind = rnd.randrange(6)
    if kind == 0:  # nearly on a line through the origin
        return [(v * 0.1, v * 0.3) for v in (rnd.randrange(400) * 0.1 for _ in range(3))]
    if kind == 1:
        return [(float(rnd.randrange(5)), float(rnd.randrange(5))) for _ in range(3)]
    if kind == 2:
        k = 10.0 ** rnd.randrange(-160, 150)
        a, b = ((rnd.random() * k, rnd.random() * k) for _ in range(2))
        return [a, b, (a[0] * 0.5 + b[0] * 0.5, a[1] * 0.5 + b[1] * 0.5)]
    if kind == 3:  # far apart, tiny, huge
        return [(rnd.choice([0.0, 1e-300, 1e300, -1e-310, 3.0]), rnd.choice([0.0, 5e-324, 1e300, 1.0, 2.0])) for _ in range(3)]
    m, b = rnd.random(), rnd.random()
    return [(x, m * x + b) for x in (rnd.choice([1.0, 1e8, 1e-5]) * rnd.random() for _ in range(3))]


@pytest.mark.parametrize("seed", range(5))
def test_signs_equal_rational_numbers(seed):
    rnd = random.Random(seed)
    rows = [[v for p in triple(rnd) for v in p] for _ in range(4000)]
    want = [_rational(*r) for r in rows]
    assert turn_signs(*np.array(rows).T).tolist() == want
    assert [int(math.copysign(1, t)) if t else 0 for t in (turn(*r) for r in rows)] == want


def test_nearly_collinear_points_are_fast():
    x = np.random.default_rng(0).random(100_000)
    begin = time.process_time()
    hull_vertices(x * 0.1, x * 0.3)
    assert time.process_time() - begin < 0.5
