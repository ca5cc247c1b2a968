import hashlib
import random
from collections import defaultdict

from planar.llm.queries import op8_sharding
from planar.llm.sharding import HASH_BITS, shard
from tests.llm.helpers import clashing, docs_df


def bits(doc_id):
    h = int(hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:15], 16)
    return f"{h:060b}"


def brute(rows, limit):
    sums = defaultdict(int)
    for i, t in rows:
        for d in range(HASH_BITS + 1):
            sums[bits(i)[:d]] += len((t or "").encode())
    out = []
    for i, t in rows:
        d = next((d for d in range(HASH_BITS + 1) if sums[bits(i)[:d]] <= limit), None)
        out.append((i, len((t or "").encode()), bits(i)[: HASH_BITS if d is None else d], HASH_BITS if d is None else d))
    return out


def run(df, limit):
    return [tuple(r) for r in shard(df, max_bytes=limit).collect()]


def test_against_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", "ü" * 40] + ["x" * rng.choice([0, 5, 50, 300, 900]) for _ in range(300)]
    ids = [None, 7, 8] + rng.sample(range(10**9), 300)
    df = clashing(docs_df(spark, texts, ids))
    for limit in (1, 900, 2000, 10**6):
        got = run(df, limit)
        want = brute(list(zip(ids, texts)), limit)
        if limit >= 900:
            assert sorted(map(str, got)) == sorted(str((*w, 0)) for w in want)
            total = defaultdict(int)
            for _, n, s, _, _ in got:
                total[s] += n
            assert max(total.values()) <= limit
        else:  # texts larger than the limit: a part each
            assert sorted(str(g[:4]) for g in got) == sorted(map(str, want))


def test_repeated_keys_overflow_into_parts(spark):
    rows = [(5, "x" * 60)] * 100 + [(6, "y" * 10), (6, "z" * 500)] + [(i, "w" * 30) for i in range(10, 40)]
    df = docs_df(spark, [t for _, t in rows], [i for i, _ in rows])
    got = run(df, 400)
    assert sorted(str(g[:4]) for g in got) == sorted(map(str, brute(rows, 400)))
    part = defaultdict(list)
    for i, n, s, d, p in got:
        part[s, p].append(n)
    assert all(sum(v) <= 400 or len(v) == 1 for v in part.values())
    parts = {p for (s, p) in part if s == bits(5)}
    assert parts == set(range(len(parts))) and len(parts) < 60


def test_only_oversized_buckets_split(spark):
    rows = [(i, "x" * 100) for i in range(200)]
    got = run(docs_df(spark, [t for _, t in rows], [i for i, _ in rows]), 1000)
    total = defaultdict(int)
    for i, n, *_ in got:
        for d in range(20):
            total[bits(i)[:d]] += n
    assert all(d == 0 or total[s[:-1]] > 1000 for _, _, s, d, _ in got)
    assert len({d for *_, d, _ in got}) > 1


def test_empty(spark):
    assert shard(docs_df(spark, [])).count() == 0


def test_query_is_native(spark):
    df = op8_sharding(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
    assert df.count() == 200
