import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from planar.llm import winnow as wn
from planar.llm.queries import op6_decontamination
from tests.llm.helpers import clashing, docs_df, plan_of, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, window=10):
    wins = {}
    for item, t in items:
        w = words(t)
        k = min(len(w), window)
        for p in range(len(w) - k + 1 if k else 0):
            wins.setdefault((k, tuple(w[p : p + k])), set()).add(item)
    out = []
    for d, t in docs:
        w = words(t)
        hit, ids = set(), set()
        for k in {k for k, _ in wins}:
            for p in range(len(w) - k + 1):
                got = wins.get((k, tuple(w[p : p + k])))
                if got:
                    hit |= set(range(p, p + k))
                    ids |= got
        ids = sorted(str(i) for i in ids if i is not None)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def items_df(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_words():
    for t in ["", "Ab9-x É漢 z_a\n0", "A" * 9, "é" * 3, "..", "a"]:
        low = t.encode().lower()
        s, e, h = wn.words_of(low)
        assert [low[i:j].decode() for i, j in zip(s, e)] == words(t)
    _, _, h = wn.words_of(b"abc x abc xabc abcx")
    assert h[0] == h[2] and len(set(h.tolist())) == 4


def test_winnow_guarantee():
    rng = np.random.default_rng(1)
    g = rng.integers(0, 5, 300).astype(np.uint64)
    kept = wn.winnow(g, np.ones(295, bool), 6)
    assert all(kept[i : i + 6].any() for i in range(295))


def cases(rng):
    items = [(i, words_of(rng, n, 50)) for i, n in enumerate([10, 11, 40, 9, 5, 1, 3, 200, 12, 30])]
    items += [(3, words_of(rng, 15)), (20, ""), (21, None), (None, words_of(rng, 14)), (22, items[2][1]), (23, "x " * 30), (24, "… — !")]
    docs = [None, "", "one", words_of(rng, 400, 50), "x " * 25, "x x x", "y " * 4000]
    for _, t in items:
        w = (t or "").split()
        docs.append(words_of(rng, 30) + " " + " ".join(w).upper() + "; " + words_of(rng, 30))
        if len(w) > 10:
            a = rng.randrange(len(w) - 10)
            docs.append(words_of(rng, 9) + "\n" + "--".join(w[a : a + 10]) + " " + words_of(rng, 3))
            docs.append(words_of(rng, 9) + "\n" + " ".join(w[a : a + 9]) + " zz " + " ".join(w[a : a + 13]))
            docs.append(" ".join(w[:10]))
            docs.append(" ".join(w[-10:]))
    return docs + docs[7:9], items


def test_against_brute_force(spark):
    for seed in range(2):
        docs, items = cases(random.Random(seed))
        ids = [None if i == 9 else i // 2 for i in range(len(docs))]
        got = wn.decontaminate(clashing(docs_df(spark, docs, ids)), clashing(items_df(spark, items)))
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(list(zip(ids, docs)), items)
        kept = wn.decontaminate(docs_df(spark, docs, ids), items_df(spark, items), keep_columns=True)
        bad = {r["text"] for r in kept.where("_contaminated").collect()}
        assert bad == {t for (t, b) in zip(docs, brute([(i, t) for i, t in enumerate(docs)], items)) if False} | {
            docs[r[0]] for r in brute(list(enumerate(docs)), items) if r[5]
        }
        assert kept.count() == len(docs)


def test_full_filter_changes_nothing(spark, monkeypatch):
    docs, items = cases(random.Random(3))
    monkeypatch.setattr(wn, "BITS", 7)
    got = wn.decontaminate(docs_df(spark, docs), items_df(spark, items))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(list(enumerate(docs)), items)


def test_empty(spark):
    docs, items = docs_df(spark, ["a b c"]), items_df(spark, [(1, "a b")])
    assert wn.decontaminate(docs_df(spark, []), items).count() == 0
    r = wn.decontaminate(docs, items.limit(0)).first()
    assert (r["n_words"], r["n_hit"], r["contaminated"]) == (3, 0, False)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = op6_decontamination(spark, sf)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items)
    assert got.where(F.col("contaminated")).count() > 0


def test_blocks_of_a_long_text(monkeypatch):
    rng = random.Random(12)
    monkeypatch.setattr(wn, "LONG_WORD", 40)
    monkeypatch.setattr(wn, "BLOCK", 300)
    text = b"".join(
        rng.choice([b"a", b"B7", "\u00e9t\u00e9".encode(), b"x" * rng.choice([39, 40, 41, 700])]) + rng.choice([b" ", b"-\n", b"  "]) for _ in range(3000)
    )
    for t in (text, b"y" * 5000, b" " * 5000, b"y" * 700 + b" z", text + b"q" * 320):
        got = [x for block in wn._blocks(t) for x in zip(*(c.tolist() for c in block))]
        spans = [m.span() for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", t)]
        assert [x[:2] for x in got] == spans
        hashes = {}
        for (a, b), x in zip(spans, got):
            assert hashes.setdefault(t[a:b].lower(), x[2]) == x[2]


def test_a_long_text_in_blocks_gives_the_same_anchors(monkeypatch):
    rng = random.Random(13)
    text = " ".join(rng.choice(["a", "b", "word" * rng.randrange(1, 5), "Z" * 60]) for _ in range(4000)).encode()
    every = lambda h: h % np.uint64(3) != 0
    tags = [0, 2, 9]
    whole = wn._anchors([text], (10, 5), tags, every)
    monkeypatch.setattr(wn, "BLOCK", 500)
    parts = wn._anchors([text], (10, 5), tags, every)
    assert parts[0][0] == whole[0][0] == 4000 and sorted(parts[0][1]) == sorted(whole[0][1])


def test_memory_of_a_long_text_is_bounded():
    import tracemalloc

    text = b" ".join(b"word%d" % (k % 100_003) for k in range(3_300_000))
    assert len(text) > 32_000_000
    tracemalloc.start()
    n, found = wn._anchors([text], (10, 5), [0, 3], lambda h: np.zeros(len(h), bool))[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 3_300_000 and not found and peak < 50_000_000


def test_long_words_match_whole(spark):
    word = "q" * 9000
    base = [f"w{k}" for k in range(30)]
    items = [(1, " ".join(base[:4] + [word] + base[4:9])), (2, " ".join(base[:4] + [word[:-1] + "r"] + base[4:9]))]
    docs = [(7, "pre " + " ".join(base[:4] + [word.upper()] + base[4:9]) + " post"), (8, " ".join(base[:4] + [word + "s"] + base[4:9]))]
    d = docs_df(spark, [t for _, t in docs], ids=[i for i, _ in docs])
    i = spark.createDataFrame(items, "item_id long, text string")
    assert sorted((tuple(r) for r in wn.decontaminate(d, i).collect()), key=str) == brute(docs, items)


def test_pipeline_form_runs_one_python_step_per_task(spark, monkeypatch):
    rng = random.Random(31)
    bad = words_of(rng, 30)
    docs = docs_df(spark, [f"{words_of(rng, 80)} {bad}", words_of(rng, 80), None])
    items = spark.createDataFrame([("a", bad)], "item_id string, text string")
    plans, kind = [], type(docs)
    written = kind.checkpoint
    monkeypatch.setattr(kind, "checkpoint", lambda self, *a, **k: plans.append(plan_of(self)) or written(self, *a, **k))
    out = wn.decontaminate(docs, items, keep_columns=True).collect()
    assert sorted(r.doc_id for r in out if r._contaminated) == [0] and len(out) == 3
    (plan,) = [p for p in plans if "MapInArrow" in p]
    assert plan.count("ArrowEvalPython") == 1  # the filter on its result does not run it again
    assert "Exchange" in plan[plan.index("MapInArrow") : plan.index("ArrowEvalPython")]
