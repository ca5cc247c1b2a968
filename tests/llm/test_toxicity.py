import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from planar.llm import toxicity as tx
from planar.llm.queries import op10_toxicity
from tests.llm.helpers import clashing, docs_df, words_of

SF = "/root/testdata/sf0.1"


def labelled(rng, n=300):
    docs, labels = [], []
    for i in range(n):
        w = words_of(rng, rng.randrange(20, 120), 900).split()
        bad = i % 6 == 0
        if bad:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["nasty", "vermin", "repulsive"]))
        docs.append(" ".join(w))
        labels.append(int(bad))
    return docs, labels


def labels_df(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_windows_cover_the_text(monkeypatch):
    seen = []
    monkeypatch.setattr(tx, "_compressors", lambda a, b: [lambda w: seen.append(w) or w, lambda w: w])
    for n in (1, 100, 127, 128, 129, 240, 241, 1000):
        seen.clear()
        buf = bytes(i % 251 for i in range(n))
        tx.window_savings(buf, b"", b"")
        covered = np.zeros(n, bool)
        for w in seen:
            i = buf.find(w)
            covered[i : i + len(w)] = True
        assert covered.all() or n > 251
        assert len(seen) == max(1, -(-(n - tx.WINDOW) // tx.STEP) + 1)


def test_copies_do_not_make_a_word_typical():
    rng = random.Random(1)
    docs, labels = labelled(rng)
    toxic = [d.encode() for d, c in zip(docs, labels) if c] + [b"one rareword two three"] * 40
    plain = [d.encode() for d, c in zip(docs, labels) if not c]
    assert set(tx.typical_words(toxic, plain)) == {b"nasty", b"vermin", b"repulsive"}


def test_words_of_a_rare_language_are_typical():
    rng = random.Random(3)
    docs, labels = labelled(rng, 1800)
    other = lambda cue: " ".join(f"v{rng.randrange(900)}" if i % 9 else cue for i in range(60))
    toxic = [d.encode() for d, c in zip(docs, labels) if c] + [other("achkeiter").encode() for _ in range(12)]
    plain = [d.encode() for d, c in zip(docs, labels) if not c] + [other("v1").encode() for _ in range(80)]
    assert set(tx.typical_words(toxic, plain)) == {b"nasty", b"vermin", b"repulsive", b"achkeiter"}


def fit(docs, labels):
    y = np.array(labels)
    return tx.fit_toxicity([d.encode() for d in docs], y, {0: int((y == 0).sum()), 1: int((y == 1).sum())}, 16384, 1024, 1 << 18, 3)


def test_learns_a_phrase_of_ordinary_words():
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(600):
        w = words_of(rng, 60, 900).split()
        bad = i % 5 == 0
        phrase = "back where people like them belong".split()
        if bad:
            w[20:20] = phrase
        else:  # each word stands in ordinary texts
            for x in phrase:
                w.insert(rng.randrange(len(w)), x)
        docs.append(" ".join(w))
        labels.append(int(bad))
    m = fit(docs[:400], labels[:400])
    got = tx.score_texts(m, [d.encode() for d in docs[400:]]) >= 0.5
    assert (got == np.array(labels[400:])).mean() > 0.95
    # Windows of the toxic texts themselves are in the dictionary.
    text = b" ".join(d.encode() for d, c in zip(docs[:400], labels) if c)
    assert sum(m.toxic[i : i + 12] in text for i in range(900)) > 100


def test_order_of_the_sample_changes_nothing():
    rng = random.Random(6)
    docs, labels = labelled(rng, 120)
    docs = [d + f" long{i} " + words_of(rng, 9000) if not c else d for i, (d, c) in enumerate(zip(docs, labels))]  # over 20,000 pieces
    m, at = fit(docs, labels), rng.sample(range(120), 120)
    again = fit([docs[i] for i in at], [labels[i] for i in at])
    assert (again.ordinary, again.toxic) == (m.ordinary, m.toxic)


def test_learns_planted_words(spark):
    rng = random.Random(2)
    docs, labels = labelled(rng)
    docs += [None, "", "ü" * 5000, "clean words only here", "you nasty repulsive vermin go"]
    rows = [(i, 1, c) for i, c in enumerate(labels)]
    out = tx.predict_toxicity(clashing(docs_df(spark, docs)), labels_df(spark, rows + rows[:5] + [(None, 0, 1), (1, 0, None)]))
    got = {r["doc_id"]: r for r in out.collect()}
    held = [i for i in range(300) if got[i]["held_out"]]
    assert len(held) > 50 and sum(got[i]["predicted"] == labels[i] for i in held) / len(held) > 0.95
    assert [got[300 + i]["predicted"] for i in range(5)] == [0, 0, 0, 0, 1]
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_nothing_to_learn(spark):
    docs = docs_df(spark, ["a b", None])
    out = tx.predict_toxicity(docs, labels_df(spark, [])).collect()
    assert [r["score"] for r in out] == [0.5, 0.5]
    assert tx.predict_toxicity(docs_df(spark, []), labels_df(spark, [])).count() == 0


@pytest.fixture(scope="module")
def scored(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return op10_toxicity(spark, SF).join(labels, "doc_id").join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").toPandas()


def test_held_out_accuracy(scored):
    held = scored[scored["held_out"]]
    # Many rows labelled toxic in the other languages hold nothing to see.
    english = held[held["lang"] == "en"]
    hit = english[english["toxic"] == 1]["predicted"].mean()
    false = held[held["toxic"] == 0]["predicted"].mean()
    assert hit > 0.9 and false < 0.01


def test_held_out_recall_in_every_language(scored):
    bad = scored[scored["held_out"] & (scored["toxic"] == 1)]
    hit = bad.groupby("lang")["predicted"].mean()
    assert (hit[["de", "es", "fr"]] > 0.25).all() and bad["predicted"].mean() > 0.65, hit


def test_columns(spark):
    assert op10_toxicity(spark, "/root/testdata/sf0.01").columns == ["doc_id", "held_out", "score", "predicted"]
    assert op10_toxicity(spark, "/root/testdata/sf0.01").where(F.col("score").isNull()).count() == 0


def plain_evidence(text, ordinary, toxic):
    """The evidence from one zstandard call per window and dictionary."""
    import math

    import zstandard

    if not text or not toxic:
        return (0.0,) * tx.N_EVIDENCE
    par = zstandard.ZstdCompressionParameters(
        window_log=20, hash_log=19, chain_log=20, search_log=8, min_match=4, strategy=zstandard.STRATEGY_BTLAZY2,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_checksum=False, write_content_size=False, write_dict_id=False,
    )

    def size(dictionary, window):
        d = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(dict_data=d, compression_params=par).compress(window))

    low, saved, at = text.lower(), [], 0
    while True:
        window = low[at : at + tx.WINDOW] + ordinary[-tx.PAD :]
        saved.append(size(ordinary, window) - size(toxic + ordinary, window))
        if at + tx.WINDOW >= len(low):
            break
        at += tx.STEP
    every = sum(v for v in saved if v > 0)
    strong = [v for v in saved if v >= tx.LEAST]
    total = sum(strong)
    return (
        float(max(strong, default=0)), math.log1p(total), math.log1p(1000 * total / len(text)), math.log1p(1000 * every / len(text))
    )


def test_scores_against_plain_compressor_calls():
    """Whole scores from window lengths taken one compressor call at a time."""
    import math

    rng = random.Random(21)
    docs, labels = labelled(rng, 150)
    m = fit(docs, labels)
    texts = [d.encode() for d in docs[:25]] + [b"", b"a", b"NASTY Vermin", "ü".encode() * 300, b"x" * tx.WINDOW, b"x" * (tx.WINDOW + 1)]
    got = tx.score_texts(m, texts)
    for t, p in zip(texts, got):
        e = plain_evidence(t, m.ordinary, m.toxic)
        assert tx._evidence(t, m.ordinary, m.toxic) == pytest.approx(e)
        z = m.weights[0] + sum(a * b for a, b in zip(m.weights[1:], e))
        assert p == pytest.approx(1 / (1 + math.exp(-min(max(z, -30), 30))))
    assert tx.score_texts(m, [None])[0] == tx.score_texts(m, [b""])[0]


def test_a_text_of_several_megabytes():
    rng = random.Random(22)
    docs, labels = labelled(rng, 150)
    m = fit(docs, labels)
    clean = [d for d, c in zip(docs, labels) if not c]
    long = " ".join(clean * 40).encode()[:2_000_000]
    foul = long + b" you nasty repulsive vermin " * 20_000
    assert len(foul) > 800_000
    got = tx.score_texts(m, [long, foul])
    assert got[1] > 0.5 and got[1] > got[0]
