import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from planar.llm import suffix as sx
from planar.llm.queries import op7_suffix_dedup
from tests.llm.helpers import clashing, docs_df, plan_of, words_of

L = 400


def brute(texts, length=L):
    """Every string of every text in a dictionary."""
    bufs = [(t or "").encode() for t in texts]
    seen = defaultdict(int)
    for b in bufs:
        for s in range(len(b) - length + 1):
            seen[hashlib.md5(b[s : s + length]).digest()] += 1
    out, kept = [], []
    for b in bufs:
        gone = np.zeros(len(b) + 1, int)
        for s in range(len(b) - length + 1):
            if seen[hashlib.md5(b[s : s + length]).digest()] > 1:
                gone[s] += 1
                if s + length <= len(b):
                    gone[s + length] -= 1
        bad = np.cumsum(gone)[: len(b)] > 0
        rest = bytes(np.frombuffer(b, np.uint8)[~bad])
        spans = int((np.diff(np.r_[False, bad].astype(int)) == 1).sum())
        out.append((len(b), int(bad.sum()), spans, hashlib.sha256(rest).hexdigest()))
        kept.append(rest)
    return out, kept


def test_borders_depend_on_nearby_bytes():
    rng = random.Random(1)
    shared = words_of(rng, 200).encode()
    a, b = words_of(rng, 90).encode() + shared + b"x" * 300, shared + words_of(rng, 9).encode()
    lo, hi = sx.WINDOW - 1, len(shared) - sx.WINDOW - sx.GRAM + 1
    inner = lambda buf, at: [p - at for p in sx.borders(buf).tolist() if lo <= p - at <= hi]
    got = inner(a, a.index(shared))
    assert got == inner(b, 0) and got
    assert np.diff(sx.borders(a)).max() <= sx.WINDOW


def test_borders_in_slices(monkeypatch):
    buf = words_of(random.Random(2), 1500).encode() + b"ab" * 500
    want = sx.borders(buf).tolist()
    monkeypatch.setattr(sx, "SLICE", 700)
    assert sx.borders(buf).tolist() == want


def strings_df(spark, strings):
    rows = [(u, 0, list(s)) for u, s in enumerate(strings) if len(s)]
    return spark.createDataFrame(rows, "sid long, b long, name array<long>")


@pytest.mark.parametrize("levels", [0, 1, 2])
def test_suffix_ranks(spark, levels):
    rng = random.Random(levels)
    strings = [[rng.randrange(1, 4) for _ in range(rng.randrange(1, 30))] for _ in range(12)]
    strings += [strings[0], strings[1][3:], [1] * 20, [1] * 23]
    got = {(r["sid"], r["i"]): r["rank"] for r in sx.suffix_ranks(strings_df(spark, strings), levels).collect()}
    suffixes = {(u, i): tuple(s[i:]) for u, s in enumerate(strings) for i in range(len(s))}
    assert got.keys() == suffixes.keys()
    depth = 3 ** (levels + 1)
    order = sorted(suffixes, key=lambda x: (got[x], suffixes[x]))
    assert [suffixes[x][:depth] for x in order] == sorted(s[:depth] for s in suffixes.values())
    full = sorted(suffixes.values())
    if levels == 2:  # 27 symbols: the whole of these suffixes
        assert all(got[x] == 1 + full.index(s) for x, s in suffixes.items())


def cases(rng):
    base = [words_of(rng, 300, 3000) for _ in range(8)]
    near = base[0].split()
    near[60] = near[150] = "changed"
    passage = words_of(rng, 120, 3000)
    exact = words_of(rng, 400, 3000)[:L]
    short = exact[: L - 1]
    texts = [None, "", "short", *base, base[1], base[1], " ".join(near), passage + base[2], words_of(rng, 40) + passage + words_of(rng, 50)]
    texts += [passage[17:] + words_of(rng, 7), passage[: L + 1], words_of(rng, 9) + passage[5 : 5 + L + 3] + "tail " * 3]
    texts += ["a " + exact, exact + " z", "b" + short + "c", "q" + short[: L - 2] + "r"]
    texts += ["spam " * 200, "spam " * 90, "ab" * 600, "x" * (L + 1), "x" * L, "y" * (L - 1), "ü" * 900, "ü" * 201]
    twice = words_of(rng, 100, 3000)
    texts += [twice + " mid " + twice, words_of(rng, 30) + words_of(rng, 100)]
    for _ in range(6):  # overlapping pieces of one source
        a = rng.randrange(800)
        texts.append(words_of(rng, 20) + " " + " ".join(base)[a : a + rng.randrange(300, 1500)] + " " + words_of(rng, 20))
    return texts


def test_against_brute_force(spark):
    texts = cases(random.Random(1))
    ids = list(range(len(texts)))
    want, kept = brute(texts)
    got = {r["doc_id"]: tuple(r)[1:] for r in sx.remove_repeats(clashing(docs_df(spark, texts, ids))).collect()}
    for i in ids:
        assert got[i] == want[i], (i, texts[i])
    out = {r["doc_id"]: r["text"] for r in sx.strip_repeats(docs_df(spark, texts, ids)).collect()}
    for i in ids:
        if want[i][1] == 0:
            assert out[i] == texts[i]
        elif not kept[i]:
            assert i not in out
        else:
            assert out[i] == kept[i].decode("utf-8", "ignore")


def test_a_character_cut_in_half_costs_no_other_text(spark):
    rng = random.Random(5)
    passage = words_of(rng, 120, 3000)
    # e-acute and e-grave share their lead byte, Cyrillic letters theirs; two
    # letters of different lead bytes share their trail byte.
    texts = [f"{h} {passage}{t} {words_of(rng, 60, 3000)}" for h, t in (("one", "é"), ("two", "è"), ("three", "д"), ("four", "е"))]
    texts += [f"{words_of(rng, 60, 3000)} {c}{passage[:450]}" for c in ("é", "ũ")]
    got = {r["doc_id"]: r["text"] for r in sx.strip_repeats(docs_df(spark, texts)).collect()}
    _, kept = brute(texts)
    assert got == {i: k.decode("utf-8", "ignore") for i, k in enumerate(kept)}
    for k in kept:
        assert len(k) > 200
    assert sum(k.decode("utf-8", "replace") != k.decode("utf-8", "ignore") for k in kept) >= 4


def test_joins_without_filters_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(sx, "NAME_BITS", 7)
    monkeypatch.setattr(sx, "TEXT_BITS", 7)
    texts = cases(random.Random(3))
    ids = [None if i % 7 == 0 else i // 2 for i in range(len(texts))]
    got = sorted(map(str, (tuple(r) for r in sx.remove_repeats(docs_df(spark, texts, ids)).collect())))
    assert got == sorted(str((i, *w)) for i, w in zip(ids, brute(texts)[0]))


def test_empty(spark):
    assert sx.remove_repeats(docs_df(spark, [])).count() == 0
    assert [tuple(r) for r in sx.remove_repeats(docs_df(spark, [None])).collect()] == [(0, 0, 0, 0, hashlib.sha256(b"").hexdigest())]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want, _ = brute([r["text"] for r in docs])
    rows = op7_suffix_dedup(spark, sf).collect()
    assert all(r["has_repeats"] == (r["n_removed"] > 0) for r in rows)
    got = {r["doc_id"]: tuple(r)[1:5] for r in rows}
    assert got == {r["doc_id"]: w for r, w in zip(docs, want)}
    assert sum(w[1] for w in want) > 0


def test_only_repeated_phrases_are_sorted(spark, monkeypatch):
    """With a filter too small to be made, an exact join picks the phrases:
    those that occur once are not sorted, however many there are."""
    rng = random.Random(31)
    shared = words_of(rng, 400)
    texts = [words_of(rng, 500, 50_000) + shared + words_of(rng, 500, 50_000) for _ in range(2)] + [words_of(rng, 900, 50_000) for _ in range(40)]
    got = {}
    ranks = sx.suffix_ranks

    def counted(strings, levels=1, more=None):
        got.setdefault("symbols", strings.selectExpr("sum(size(name)) s").first().s)
        return ranks(strings, levels, more)

    monkeypatch.setattr(sx, "suffix_ranks", counted)
    for bits in (27, 7):
        got.clear()
        monkeypatch.setattr(sx, "NAME_BITS", bits)
        monkeypatch.setattr(sx, "TEXT_BITS", bits)
        rows = {r["doc_id"]: r["n_removed"] for r in sx.remove_repeats(docs_df(spark, texts)).collect()}
        assert min(rows[0], rows[1]) >= len(shared) and not any(rows[i] for i in range(2, 42))
        phrases = 2 * len(shared) / 20  # at least 20 bytes or so each
        assert got["symbols"] < phrases


def test_filters_are_not_run_again_on_the_other_side_of_a_join(spark):
    # One Python step per task: the two scans ask the filter, the remainders' side must not.
    rng = random.Random(29)
    same = words_of(rng, 200)
    plan = plan_of(sx.strip_repeats(docs_df(spark, [f"{words_of(rng, 100)} {same} {i}" for i in range(6)])))
    assert plan.count("MapInArrow") == 1 and plan.count("ArrowEvalPython") == 2
