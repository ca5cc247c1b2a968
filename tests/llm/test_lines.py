import hashlib
import os
import random

import numpy as np
import pyarrow as pa
import pytest

from planar.llm.lines import DROP, NO_ID, OPEN, SEEN, _stream, apply_bitmaps, dedup_lines, line_keep_bitmaps, unpack_bitmap
from tests.llm.helpers import clashing, docs_df

WS = " \t\n\x0b\x0c\r"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars=40, min_docs=5):
    at = lambda i: NO_ID if i is None else i
    key = lambda line: line.strip(WS).translate(LOW)
    held = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                held.setdefault(key(line), set()).add(at(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if len(held.get(key(x), ())) < min_docs or max(held[key(x)]) == at(i)]
        out.append((i, len(lines), len(lines) - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def made(rng, n, hot):
    common = [f"Line {k} that very many documents of all kinds hold {'é' * k}" for k in range(12)]
    rows = []
    for i in range(n):
        lines = [rng.choice(common) for _ in range(rng.randrange(4))] + [hot] * rng.randrange(3)
        lines += [f"own line {rng.random()} of a document with number {i}" for _ in range(rng.randrange(3))] + rng.choices(["", "short", "x" * 39], k=2)
        rng.shuffle(lines)
        lines = [rng.choice(["", " ", "\t\r"]) + rng.choice([x, x.upper() if x.isascii() else x]) + rng.choice(["", " \x0b"]) for x in lines]
        rows.append((i * 7 % 1000, "\n".join(lines)))
    return rows


def test_against_brute_force(spark):
    rng = random.Random(3)
    rows = made(rng, 150, "a line that a third of all documents hold, many times over")
    rows += [(i, None) for i in (2000, 2001)] + [(2002, ""), (2003, "\n\n"), (2004, "long line " * 30_000 + "\n" + "y" * 50)]
    rows += [(None, rows[0][1]), (None, rows[1][1]), (None, None), rows[5], rows[5], (rows[6][0], rows[7][1])]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # stretches span partitions
    try:
        df = clashing(docs_df(spark, [t for _, t in rows], ids=[i for i, _ in rows])).drop("doc").withColumnRenamed("n", "pos")
        assert rows_of(dedup_lines(df)) == brute(rows)
        assert rows_of(dedup_lines(df, min_docs=2, min_chars=1)) == brute(rows, 1, 2)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_bitmaps_give_the_texts(spark):
    rows = made(random.Random(4), 60, "z" * 60)
    df = docs_df(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    maps = line_keep_bitmaps(df)
    got = {r["doc"]: r for r in maps.collect()}
    want = {i: (n, k) for i, n, k, _ in brute(rows)}
    assert {i: (r["n_lines"], r["n_dropped"]) for i, r in got.items()} == want
    for r in got.values():
        assert unpack_bitmap(r["keep"], r["n_lines"]).sum() == r["n_lines"] - r["n_dropped"]
    texts = {r["doc"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in apply_bitmaps(df, maps).collect()}
    assert texts == {i: h for i, _, k, h in brute(rows) if k}


def test_empty_table(spark):
    df = docs_df(spark, [])
    assert dedup_lines(df).collect() == [] and line_keep_bitmaps(df).collect() == []


def batches(part, cuts):
    cols = [np.array(c) for c in zip(*part)]
    edges = [0, *sorted(cuts), len(part)]
    for a, b in zip(edges, edges[1:]):
        yield pa.RecordBatch.from_arrays([pa.array(c[a:b], pa.int64()) for c in cols], names=["h1", "h2", "doc", "text_hash", "pos"])


@pytest.mark.parametrize("seed", range(40))
def test_stream_over_partitions_and_batches(seed):
    rng = random.Random(seed)
    rows = {(rng.randrange(4) + 5 * (rng.random() < 0.1), 0, rng.randrange(9), 0, rng.randrange(40)) for _ in range(120)}
    rows = sorted(rows, key=lambda r: (r[0], r[1], -r[2], r[3], r[4]))
    # Partitions never cut a (hash, document).
    cuts = [i for i in range(1, len(rows)) if rows[i][:3] != rows[i - 1][:3]]
    cuts = sorted(rng.sample(cuts, min(len(cuts), rng.randrange(8))))
    found = []
    for a, b in zip([0, *cuts], [*cuts, len(rows)]):
        part = rows[a:b]
        for out in _stream(4)(batches(part, [rng.randrange(len(part) + 1) for _ in range(rng.randrange(5))])):
            found += list(zip(*[c.to_pylist() for c in out.columns]))
    assert sum(r[0] == SEEN for r in found) <= 2 * (len(cuts) + 1)
    total, largest = {}, {}
    for kind, h1, _, doc, _, _, n in found:
        if kind == SEEN:
            total[h1], largest[h1] = total.get(h1, 0) + n, max(doc, largest.get(h1, -1))
    got = [(d, p) for kind, h, _, d, _, p, _ in found if kind == DROP or kind == OPEN and total[h] >= 4 and d != largest[h]]
    docs = {}
    for r in rows:
        docs.setdefault(r[0], set()).add(r[2])
    assert sorted(got) == sorted((r[2], r[4]) for r in rows if len(docs[r[0]]) >= 4 and r[2] != max(docs[r[0]]))


def test_code_points_and_folding(spark):
    """Code points, not bytes, make a key long enough; only A-Z are folded."""
    short, long = "é" * 39, "Ä" + "é" * 39
    rows = [(i, f"{short}\n {long}\n{long.lower()}\n\x0b{'K' * 40}\t\n{'K' * 40}") for i in range(6)]
    assert rows_of(dedup_lines(docs_df(spark, [t for _, t in rows], ids=[i for i, _ in rows]))) == brute(rows)


def test_checkpoints_leave_few_files(spark):
    """Files of the shared folder follow the cores, not the shuffle's partitions."""
    sc, keep = spark.sparkContext, {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    files = lambda: sum(f.startswith("part-") for _, _, fs in os.walk(sc.getCheckpointDir().removeprefix("file:")) for f in fs)
    most = 4 * sc.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", str(4 * most))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = made(random.Random(5), 300, "a line that a third of all documents hold, many times over")
        df, before = docs_df(spark, [t for _, t in rows], ids=[i for i, _ in rows]), files()
        got = dedup_lines(df)
        assert 0 < files() - before <= 2 * most
        assert rows_of(got) == brute(rows)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
