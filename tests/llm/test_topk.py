import math
import random

from planar.llm.queries import op9_topk
from planar.llm.topk import exact_top_k, groups_of
from tests.llm.helpers import clashing

LIMIT = 1 << 63  # scores saturate
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5, every=50):
    ok = [
        (i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (q, x) in enumerate(ok):
        if q % every:
            continue
        s = [(-max(-LIMIT, min(LIMIT - 1, sum(i * j for i, j in zip(x, y)))), c) for b, (c, y) in enumerate(ok) if a != b and len(y) == len(x)]
        out += [(q, r + 1, c, -t) for r, (t, c) in enumerate(sorted(s)[:k])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(parts)


def test_against_brute_force(spark):
    rng = random.Random(1)
    vec = lambda n=4: [rng.choice([-0.5, 0.0, 0.25, 1.0, rng.gauss(0, 1)]) for _ in range(n)]
    rows = [(i, vec()) for i in range(260)]
    rows += [(300 + i, [0.25, 0.25, 0.0, 1.0]) for i in range(40)]  # ties
    rows += rows[50:52] + rows[100:101] * 7 + [(100, vec()), (150, vec(3)), (151, vec(3)), (200, [])]
    rows += [(None, vec()), (350, None), (400, [1.0, None, 0.0, 0.0]), (450, [1.0, float("nan"), 0.0, 0.0]), (500, [float("inf")] * 4)]
    for tiles in (4096, 16):
        got = exact_top_k(clashing(frame(spark, rows)), tile_rows=tiles, query_rows=tiles, spread=4)
        assert rows_of(got) == brute(rows)


def test_large_components_are_exact(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) * 2.0**26 for _ in range(3)]) for i in range(60)]
    rows += [(100, [2.0**40, 0.0, 0.0]), (101, [2.0**45, 1.0, 0.0])]
    assert rows_of(exact_top_k(frame(spark, rows))) == brute(rows)


def test_few_rows(spark):
    assert rows_of(exact_top_k(frame(spark, [(50, [1.0])]))) == []
    assert rows_of(exact_top_k(frame(spark, [(50, [1.0]), (1, [2.0])]))) == [(50, 1, 1, 131072)]
    assert exact_top_k(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert rows_of(op9_topk(spark, sf)) == brute(rows)


def test_groups_follow_the_tiles(spark):
    assert [groups_of(n) for n in (0, 1, 13, 64, 200, 256, 4000)] == [1, 1, 13, 64, 64, 64, 1000]
    rng = random.Random(4)
    rows = [(i, [rng.choice([-0.5, 0.25, 1.0]), rng.gauss(0, 1)]) for i in range(700)]
    assert rows_of(exact_top_k(frame(spark, rows, 2), tile_rows=2, query_rows=4)) == brute(rows)
