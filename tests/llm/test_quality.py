import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from planar.llm import quality as ql
from planar.llm.queries import op2_quality
from tests.llm.helpers import clashing, docs_df

SF = "/root/testdata/sf0.01"


def test_repeated_ids_do_not_widen_the_sample(spark):
    texts = ["same text"] * 200 + [f"other text {i}" for i in range(100)] + [f"text {i}" for i in range(60)] + [None] * 5
    ids = [7] * 300 + list(range(100, 160)) + [160] * 5
    labels = spark.createDataFrame([(7, 1)] + [(i, i % 2) for i in range(100, 161)], "doc_id long, quality int")
    docs = docs_df(spark, texts, ids).select("doc_id", "text")
    sample, counts = ql.bounded_sample(docs, labels, "quality", 20, 1 << 15)
    assert sample["label"].value_counts().to_dict() == {0: 20, 1: 20}
    assert counts == {0: 31, 1: 101 + 30}
    sample, _ = ql.bounded_sample(docs, labels, "quality", 1000, 1 << 15)
    assert len(sample) == 162 and sample["bytes"].isna().sum() == 1


def test_marginals_against_enumeration():
    rng = np.random.default_rng(1)
    per = np.array([3, 0, 1, 5])
    s = rng.normal(size=per.sum()) * 2
    trans = rng.normal(size=(2, 2))
    p, pair, log_z = ql.marginals(s, per, trans)
    at, want_pair, want_z = 0, np.zeros((2, 2)), 0.0
    for n in per:
        if n:
            paths = list(itertools.product((0, 1), repeat=int(n)))
            w = np.array([np.exp(sum(s[at + i] * y for i, y in enumerate(q)) + sum(trans[a, b] for a, b in zip(q, q[1:]))) for q in paths])
            want_z += np.log(w.sum())
            w /= w.sum()
            for i in range(n):
                assert p[at + i] == pytest.approx(sum(x for x, q in zip(w, paths) if q[i]))
            for x, q in zip(w, paths):
                for a, b in zip(q, q[1:]):
                    want_pair[a, b] += x
        at += n
    assert np.allclose(pair, want_pair) and log_z == pytest.approx(want_z)


def test_features_do_not_cross_texts():
    texts = [b"One line.\n\nTwo | lines !!\n", b"", b"\n\n", "Üñ\nend".encode(), b"a a a a b"]
    x, size, per = ql.line_features(texts)
    assert per.tolist() == [2, 0, 0, 2, 1] and size.tolist() == [9, 14, 4, 3, 9]
    for i, t in enumerate(texts):
        alone, s, n = ql.line_features([t])
        a = per[:i].sum()
        assert np.allclose(x[a : a + per[i]], alone)
    assert x[4, ql.CLASSES + 2] == pytest.approx(0.6)  # repeated words


def test_rows(spark):
    good = "This is a line of text, as people write it.\nAnd another one follows here."
    bad = "AA!! BB!! CC!!\n$$$ ### $$$ ###"
    texts = [good, bad] * 30 + [None, "", "\n", good * 200]
    labels = spark.createDataFrame([(i, (i + 1) % 2, 0) for i in range(60)] + [(3, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    out = ql.predict_quality(clashing(docs_df(spark, texts)), labels)
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == len(texts)
    assert all(got[i]["predicted"] == (i + 1) % 2 for i in range(60))
    assert got[60]["score"] == got[61]["score"] == got[62]["score"] and got[63]["predicted"] == 1


def test_nothing_to_learn(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in ql.predict_quality(docs_df(spark, ["a", None]), labels).collect()} == {0.5}
    assert ql.predict_quality(docs_df(spark, []), labels).count() == 0


def test_held_out_accuracy(spark):
    out = op2_quality(spark, SF)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where(F.col("held_out")).toPandas()
    assert len(rows) > 50 and (rows["predicted"] == rows["quality"]).mean() > 0.95


# --- plain versions, one line at a time -------------------------------------------
def plain_line(line):
    """The features of one line, byte by byte."""
    import math

    def cls(b):
        if b in (9, 32):
            return 3
        if b >= 128:
            return 8
        if b < 32 or b == 127:
            return 9
        c = chr(b)
        for kind, letters in ((0, "abcdefghijklmnopqrstuvwxyz"), (1, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (2, "0123456789"), (4, ".,;:?'\"()-"), (5, "|"), (6, "!")):
            if c in letters:
                return kind
        return 7

    kinds = [cls(b) for b in line]
    words, now = [], []
    for b in line:
        if b in (9, 32):
            if now:
                words.append(bytes(now))
            now = []
        else:
            now.append(b)
    if now:
        words.append(bytes(now))
    alike = [(sum(b * b * 31 + b for b in w), w[0], w[-1]) for w in words]  # words are told apart by this
    n = max(1, len(words))
    return [kinds.count(c) / len(line) for c in range(10)] + [
        math.log1p(len(line)), len(line) / n / 10, sum(a == b for a, b in zip(alike, alike[1:])) / n, (len(alike) - len(set(alike))) / n,
        sum(len(w) <= 3 for w in words) / n, float(kinds[0] == 1), float(kinds[-1] == 4), sum(cls(w[-1]) in (5, 6, 7) for w in words) / n,
    ]


def plain_features(text):
    own = [plain_line(x) for x in text.split(b"\n") if x]
    none = [0.0] * ql.N_LINE
    return [a + (own[i - 1] if i else none) + (own[i + 1] if i + 1 < len(own) else none) for i, a in enumerate(own)]


def plain_score(f, text):
    """Length-weighted marginals by forward and backward sums in plain numbers."""
    import math

    x = plain_features(text)
    if not x:
        return f.prior
    s = [sum((v - m) / d * w for v, m, d, w in zip(r, f.mean, f.scale, f.unary)) + f.bias for r in x]
    e = [(1.0, math.exp(v)) for v in s]
    t = [[math.exp(v) for v in r] for r in f.trans.tolist()]

    def norm(a):
        return [v / sum(a) for v in a]

    fwd = [norm(e[0])]
    for i in range(1, len(s)):
        fwd.append(norm([sum(fwd[-1][a] * t[a][b] for a in (0, 1)) * e[i][b] for b in (0, 1)]))
    bwd = [[1.0, 1.0]]
    for i in range(len(s) - 1, 0, -1):
        bwd.append(norm([sum(t[a][b] * e[i][b] * bwd[-1][b] for b in (0, 1)) for a in (0, 1)]))
    bwd.reverse()
    size = [len(line) for line in text.split(b"\n") if line]
    p = sum(norm([a[0] * b[0], a[1] * b[1]])[1] * n for a, b, n in zip(fwd, bwd, size)) / sum(size)
    p = min(max(p, 1e-4), 1 - 1e-4)
    a, b = f.calibration
    return 1 / (1 + math.exp(-(a + b * math.log(p / (1 - p)))))


def odd_texts():
    import random

    rng = random.Random(17)
    pieces = ["The cat sat. ", "AA|BB| ", "!!", "\t", "  ", "12,5% ", "é漢 ", "and and and ", "(x)", "\x00\x7f", "ab ba ", "\n", "\n\n", "-"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 60))).encode() for _ in range(60)] + [b"", b"\n", b" ", b"a"]


def test_features_and_scores_against_a_plain_version(spark):
    texts = odd_texts()
    x, size, per = ql.line_features(texts)
    want = [r for t in texts for r in plain_features(t)]
    assert per.tolist() == [sum(map(bool, t.split(b"\n"))) for t in texts]
    assert np.allclose(x, np.array(want, np.float32), atol=1e-6)
    y = np.array([i % 2 for i in range(len(texts))])
    f = ql.fit_field(x, size, per, y, np.ones(len(texts)), rounds=30)
    got = ql.score_texts(f, texts)
    assert np.allclose(got, [plain_score(f, t) for t in texts], atol=2e-4)


def test_query_against_a_plain_version(spark):
    """The learned field applied line by line to whole texts of the table."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    f = ql.train_quality(docs.where(ql.fold("doc_id", 5) != 0), labels)
    got = {r["doc_id"]: r["score"] for r in op2_quality(spark, "/root/testdata/sf0.001").collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows[::4]:
        assert got[r["doc_id"]] == pytest.approx(plain_score(f, (r["text"] or "").encode()), abs=1e-3)


def test_a_text_of_many_megabytes():
    good, bad = b"This is a line of text, as people write it.\n", b"AA!! BB!! CC!! $$$ ###\n"
    x, size, per = ql.line_features([good * 3, bad * 3] * 20)
    f = ql.fit_field(x, size, per, np.array([1, 0] * 20), np.ones(40), rounds=40)
    got = ql.score_texts(f, [good * 60_000, bad * 60_000, b"x" * 3_000_000, good * 50])
    assert got[0] == pytest.approx(got[3], abs=1e-3) and got[0] > 0.9 > 0.1 > got[1] and 0 <= got[2] <= 1
