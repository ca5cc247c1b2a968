import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from planar.llm.components import connected_components
from planar.llm.queries import op1_simhash
from planar.llm.simhash import gray_rank, keep_one_per_component, link_forest, patterns, simhash, simhash_components, simhash_near_dups
from tests.llm.helpers import clashing, docs_df, words_of


def brute_fp(text, k=4):
    if text is None:
        return 0
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words, cur = [], ""
    for c in low + " ":
        if c == " " or "\x09" <= c <= "\x0d":
            if cur:
                words.append(cur)
            cur = ""
        else:
            cur += c
    if not words:
        return 0
    sh = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits=4):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def classes(labels):
    out = {}
    for i, c in enumerate(labels):
        out.setdefault(c, set()).add(i)
    return {frozenset(v) for v in out.values()}


TEXTS = ["", " \t\n", None, "one", "One two THREE", "a b c d", "a b c d e", "Ünï Élan ÀB c d e f g", "x " * 5000, "a\x0bb\x0cc d e"]


def test_fingerprints():
    rng = random.Random(1)
    for t in TEXTS + [words_of(rng, n) for n in (3, 4, 5, 50, 700)]:
        assert simhash(None if t is None else t.encode(), 4) == brute_fp(t)


def test_long_text_in_chunks(monkeypatch):
    from planar.llm import common, simhash as m

    t = words_of(random.Random(2), 3000)
    monkeypatch.setattr(m, "word_chunks", lambda b: common.word_chunks(b, 97))
    assert simhash(t.encode(), 4) == brute_fp(t)


def test_gray_rank():
    x = np.arange(1000, dtype=np.uint64)
    assert (gray_rank(x ^ (x >> np.uint64(1))) == x).all()


@pytest.mark.parametrize("seed", range(4))
def test_link_forest(seed):
    rng = random.Random(seed)
    fps, group = [], []
    for g in range(rng.randrange(1, 12)):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 60, 300])):
            f = base if rng.random() < 0.5 else rng.getrandbits(64)
            for _ in range(rng.randrange(9)):
                f ^= 1 << rng.randrange(64)
            fps.append(f)
            group.append(g)
    rep = link_forest(np.array(group), np.array(fps, dtype=np.uint64), 4)
    want = set()
    for g in set(group):
        idx = [i for i, x in enumerate(group) if x == g]
        want |= {frozenset(idx[i] for i in c) for c in classes(brute_components([fps[i] for i in idx]))}
    assert classes(rep.tolist()) == want


@pytest.mark.parametrize("max_group", [40, 20_000])
def test_components_against_brute_force(spark, max_group):
    rng = random.Random(max_group)
    fps = {rng.getrandbits(64) for _ in range(200)} | {0, (1 << 64) - 1}
    for base in [rng.getrandbits(64) for _ in range(5)]:
        f = base
        for _ in range(60):  # chains and balls
            f ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            fps.add(f)
            fps.add(base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    got = {r["fp"] % (1 << 64): r["root"] for r in simhash_components(df, 4, max_group).collect()}
    assert classes([got.get(f, f"self{f}") for f in fps]) == classes(brute_components(fps))
    if max_group == 40:
        assert patterns(df, 4, max_group).groupBy("mask", "pattern").count().agg(F.max("count")).first()[0] <= 40


def test_connected_components_chain(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000), (2000, 2001), (2001, 2000)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(301)} | {2000: 2000, 2001: 2000}


def corpus(rng):
    texts = list(TEXTS)
    for _ in range(15):
        t = words_of(rng, rng.choice([5, 60, 400]), 5000)
        texts += [t, t.upper()]
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        texts += [" ".join(w)] * rng.randrange(1, 4)
    return texts


def test_near_dups_against_brute_force(spark):
    rng = random.Random(5)
    texts = corpus(rng)
    ids = list(range(100, 100 + len(texts)))
    rng.shuffle(ids)
    ids[3] = None
    ids[10] = ids[11]
    got = simhash_near_dups(clashing(docs_df(spark, texts, ids)))
    fps = [brute_fp(t) for t in texts]
    comp = brute_components(fps)
    first = {c: min((ids[i] for i in range(len(ids)) if comp[i] == c and ids[i] is not None), default=None) for c in comp}
    want = sorted((str(ids[i]), f"{fps[i]:016x}", first[comp[i]]) for i in range(len(ids)))
    assert sorted((str(a), b, c) for a, b, c in got.collect()) == want
    assert got.columns == ["doc_id", "fingerprint", "component_id"]


def test_empty(spark):
    assert simhash_near_dups(docs_df(spark, [])).count() == 0
    assert keep_one_per_component(docs_df(spark, [])).count() == 0


def test_keep_one(spark):
    rng = random.Random(6)
    texts = corpus(rng)
    ids = list(range(len(texts)))
    ids[2] = None
    df = docs_df(spark, texts, ids)
    df = df.unionByName(df.limit(5))  # repeated rows
    got = keep_one_per_component(df)
    assert got.columns == df.columns
    fps = [brute_fp(t) for t in texts]
    comp = brute_components(fps)
    want = sorted(min(i for i in range(len(ids)) if comp[i] == c and ids[i] is not None) for c in set(comp))
    assert sorted(r["doc_id"] for r in got.collect()) == want


def test_query(spark):
    out = op1_simhash(spark, "/root/testdata/sf0.001")
    rows = {r["doc_id"]: r for r in out.collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    fps = {r["doc_id"]: brute_fp(r["text"]) for r in docs}
    ids = sorted(fps)
    comp = brute_components([fps[i] for i in ids])
    want = {i: min(j for j, d in zip(ids, comp) if d == c) for i, c in zip(ids, comp)}
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in rows.items()} == {i: (f"{fps[i]:016x}", want[i]) for i in ids}
