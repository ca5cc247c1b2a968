import hashlib
import random
import zlib

import numpy as np
import pytest

from planar.llm import runs as R
from planar.llm.runs import periodic_runs, periodic_runs_of, run_digests
from tests.llm.helpers import clashing, docs_df


def brute(w, min_length=6):
    found = {}
    n = len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(min_length, 4 * q):
                found.setdefault((s, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def sequence(rng, n):
    """Words with nested repetitions and repeats that almost go on."""
    w = []
    while len(w) < n:
        block = [rng.randrange(rng.choice([2, 3, 50])) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 40, 64]))]
        if rng.random() < 0.3:
            block = block * rng.randrange(1, 6) + [rng.randrange(50)]
        for _ in range(rng.choice([1, 1, 3, 4, 5, 9])):
            w += block
        w += block[: rng.randrange(len(block) + 1)]
        if rng.random() < 0.4:
            w[rng.randrange(len(w))] = rng.randrange(60)
    return w[:n]


@pytest.mark.parametrize("seed", range(60))
def test_runs_of_sequences(seed):
    rng = random.Random(seed)
    for n in (0, 1, 5, 6, 30, 100, 700):
        w = sequence(rng, n)
        assert periodic_runs_of(np.array(w, np.int64)) == brute(w)


@pytest.mark.parametrize("block", ["aab", "ab", "a", "abcab", "aabaabaac"])
def test_periods_with_periodic_parts(block):
    rng = random.Random(len(block))
    for q in (8, 9, 12, 15, 16, 23, 31, 33, 63, 65, 100):
        unit = (list(block) * q)[: q - 1] + ["z"] if rng.random() < 0.5 else (list(block) * q)[:q]
        w = ["p"] * rng.randrange(3) + unit * 4 + unit[: rng.randrange(q)] + ["s"]
        ids = [ord(c) for c in w]
        assert periodic_runs_of(np.array(ids, np.int64)) == brute(ids)


def planted(doc_id, words):
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def digest(doc_id, text):
    words = planted(doc_id, (text or "").encode().split())
    found = brute(words)
    keep = [True] * len(words)
    for s, n, q in found:
        keep[s + q : s + n] = [False] * (n - q)
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    rest = b" ".join(w for w, k in zip(words, keep) if k)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(rest).hexdigest())


def texts(rng, n):
    out = []
    for _ in range(n):
        w = [f"wörd{x}" if x % 7 == 0 else f"w{x}" for x in sequence(rng, rng.choice([1, 7, 40, 200, 300]))]
        out.append(rng.choice([" ", "\n", "\x0b\t"]).join(w) + rng.choice(["", " ", "\n"]))
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_digests_against_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    ts = texts(rng, 140) + [None, "", " \n ", "x", "a " * 6, "a " * 5, "a b " * 4, " a " * 9]
    ids = [None if i == 3 else i % 130 for i in range(len(ts))]
    want = sorted((digest(i, t) for i, t in zip(ids, ts)), key=repr)
    df = clashing(docs_df(spark, ts, ids=ids)).withColumnRenamed("key", "runs")
    assert rows_of(run_digests(df)) == want


def test_long_texts_agree(monkeypatch):
    rng = random.Random(9)
    text = " ".join(f"w{x}" for x in sequence(rng, 30_000)).encode()
    runs, rest = R._pack([text], 6)[0]
    monkeypatch.setattr(R, "word_chunks", lambda buf: (buf.split()[i : i + 999] for i in range(0, 30_000, 999)))
    assert R._long(text, 6) == (runs, rest)
    assert len(runs) > 20


def test_a_text_of_many_megabytes(spark):
    rng = random.Random(10)
    block = " ".join(f"w{rng.randrange(10**6)}" for _ in range(100_000))
    df = spark.createDataFrame([(1, block + " " + " ".join([block] * 4) + " tail"), (2, "b " * 3_000_000)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in periodic_runs(df).collect()}
    assert [tuple(r) for r in got[1]["runs"] if r["period"] > 50_000] == [(0, 500_000, 100_000)]
    assert [tuple(r) for r in got[2]["runs"]] == [(0, 3_000_000, 1)] and got[2]["collapsed"] == "b"


def test_empty_table(spark):
    assert run_digests(docs_df(spark, [])).collect() == []
