"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on pieces of ordinary texts and
one on windows of toxic texts.  A trainer takes what is frequent, which in
toxic text is mostly ordinary; so the stretches typical of toxic text (words
and phrases of any language, however rare it is in the sample) are added to
the second, and a part of the ordinary texts as they are to the first.  A text is cut into overlapping windows; each
is compressed with the ordinary dictionary and with the toxic one put before
it, and what the second saves is the window's distance.  Savings above a
threshold count as evidence, and a logistic curve calibrated on the labelled
sample turns a text's evidence into a probability; ordinary texts that are
part of the dictionary take no part in it.

A stretch is typical when it stands in more different contexts of toxic texts
than chance allows among so many stretches; contexts are counted instead of
texts, so a group of copies counts once.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planar.llm.common import fold, prepare, utf8
from planar.llm.quality import bounded_sample

WINDOW, STEP, PAD = 128, 112, 48
LEAST = 2  # bytes saved from which a window is evidence
N_EVIDENCE = 4  # numbers that sum up a text
REACH = 8  # words from a stretch to its context
WORDS = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]
    prior: float


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a ^ (b >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


def _stretches(text: bytes, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per number of words up to ``longest``, the hashes of the text's
    stretches of so many words, in order, and those of its words."""
    h = np.array([xxhash.xxh64_intdigest(w) for w in WORDS.findall(text)], np.uint64)
    g = h
    for n in range(1, min(longest, len(h)) + 1):
        if n > 1:
            g = _mix(g[:-1], h[n - 1 :])
        yield n, g, h


def _contexts(texts: list[bytes], longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The stretches and in how many different contexts (the fewer of left
    and right, one of each text) each stands.  A context is the word ``REACH``
    words away, so that those of a fixed phrase differ; beyond the edge of a
    text it is the text itself."""
    found: list[list] = [[np.zeros(0, np.uint64)] for _ in range(3)]
    for t in dict.fromkeys(texts):
        own = np.uint64(xxhash.xxh64_intdigest(t, 1))
        for n, g, h in _stretches(t, longest):
            g, at = np.unique(g, return_index=True)
            far = at + n - 1 + REACH
            left = np.where(at >= REACH, h[np.maximum(at - REACH, 0)], own)
            right = np.where(far < len(h), h[np.minimum(far, len(h) - 1)], own)
            for part, x in zip(found, (g, _mix(g, left), _mix(g, right))):
                part.append(x)
    g, left, right = (np.concatenate(part) for part in found)
    sides = [np.unique(g[np.unique(x, return_index=True)[1]], return_counts=True) for x in (left, right)]
    return sides[0][0], np.minimum(sides[0][1], sides[1][1])


def typical_stretches(toxic: list[bytes], ordinary: list[bytes], longest: int = 3) -> list[bytes]:
    """Stretches of up to ``longest`` words whose contexts lie in toxic texts
    more often than chance gives the best of so many (likelihood ratio), the
    most telling last; of stretches within each other the more telling one."""
    g, t = _contexts(toxic, longest)
    og, oc = _contexts(ordinary, longest)
    at = np.minimum(np.searchsorted(og, g), max(0, len(og) - 1))
    o = np.where(og[at] == g, oc[at], 0) if len(og) else np.zeros(len(g), int)
    n_toxic, n_ordinary = len(dict.fromkeys(toxic)), len(dict.fromkeys(ordinary))
    share = n_toxic / max(1, n_toxic + n_ordinary)
    n = t + o
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2 * (t * np.log(t / (n * share)) + np.where(o > 0, o * np.log(o / (n * (1 - share))), 0))
    bar = 2 * math.log(max(2, int((t > 1).sum())))
    ok = (t > n * share) & (t > 1) & (ratio > bar)
    value = dict(zip(g[ok].tolist(), ratio[ok].tolist()))
    out: dict[bytes, float] = {}
    for text in dict.fromkeys(toxic):
        spans = [m.span() for m in WORDS.finditer(text)]
        here = sorted(((value[x], -k, i) for k, g, _ in _stretches(text, longest) for i, x in enumerate(g.tolist()) if x in value), reverse=True)
        taken = np.zeros(len(spans), bool)
        for v, k, i in here:
            if not taken[i : i - k].any():
                taken[i : i - k] = True
                out.setdefault(b" ".join(text[a:b] for a, b in spans[i : i - k]), v)
    return sorted(out, key=lambda w: (out[w], w))


def typical_words(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """The typical stretches of one word."""
    return typical_stretches(toxic, ordinary, 1)


def _dictionary(size: int, samples: list[bytes], **kw) -> bytes:
    """A trained dictionary; samples too few to train on serve as they are."""
    try:
        return zstandard.train_dictionary(size, samples, **kw).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(dict.fromkeys(samples))[-size:]


@lru_cache(2)
def _compressors(ordinary: bytes, toxic: bytes):
    kw = dict(window_log=20, hash_log=19, chain_log=20, search_log=8, min_match=4, strategy=zstandard.STRATEGY_BTLAZY2)
    par = zstandard.ZstdCompressionParameters(
        **kw, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_checksum=False, write_content_size=False, write_dict_id=False
    )
    out = []
    for content in (ordinary, toxic + ordinary):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=par)
        out.append(zstandard.ZstdCompressor(dict_data=d, compression_params=par).compress)
    return out


def window_savings(buf: bytes, ordinary: bytes, toxic: bytes) -> np.ndarray:
    """Per window of a lower-cased text, the bytes the toxic dictionary saves.
    Each window ends in a run of bytes that both dictionaries hold: without
    it, a window that hardly compresses is stored as it is and savings within
    it would not show."""
    plain, both = _compressors(ordinary, toxic)
    starts = range(0, max(1, len(buf) - WINDOW + STEP), STEP) if buf else ()
    pad = ordinary[-PAD:]
    parts = (buf[i : i + WINDOW] + pad for i in starts)
    return np.fromiter((len(plain(w)) - len(both(w)) for w in parts), np.int64)


def _evidence(buf: bytes | None, ordinary: bytes, toxic: bytes) -> tuple[float, ...]:
    if not buf or not toxic:
        return (0.0,) * N_EVIDENCE
    s = window_savings(buf.lower(), ordinary, toxic)
    every = float(np.maximum(s, 0).sum())
    s = s[s >= LEAST]
    total = float(s.sum())
    return float(s.max(initial=0)), math.log1p(total), math.log1p(1000 * total / len(buf)), math.log1p(1000 * every / len(buf))


def _fit(x: np.ndarray, y: np.ndarray, w: np.ndarray, l2: float = 1e-2) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    X = np.c_[np.ones(len(x)), x]
    a = np.zeros(X.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(X @ a, -30, 30)))
        g = X.T @ (w * (y - p)) - l2 * a
        h = (X * (w * p * (1 - p))[:, None]).T @ X + l2 * np.eye(len(a))
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a = a + step
        if np.abs(step).max() < 1e-8:
            break
    return a


def train_toxicity(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", per_label: int = 2000, max_bytes: int = 1 << 15,
    ordinary_bytes: int = 16384, toxic_bytes: int = 1024, plain_bytes: int = 1 << 18, longest: int = 3,
) -> ToxicityModel:
    """Dictionaries and calibration from a bounded sample: at most
    ``per_label`` texts of each label, of at most ``max_bytes`` bytes.
    ``ordinary_bytes`` and ``toxic_bytes`` are what the trainer makes of the
    pieces and windows; ``plain_bytes`` of ordinary pieces (in the order of
    their hashes) and all typical stretches of up to ``longest`` words are
    added.  Without both labels every text scores the toxic label's share."""
    sample, counts = bounded_sample(docs, labels, label_col, per_label, max_bytes)
    return fit_toxicity([b or b"" for b in sample["bytes"]], sample["label"].to_numpy(), counts, ordinary_bytes, toxic_bytes, plain_bytes, longest)


def _by_hash(parts: list[bytes]) -> list[bytes]:
    return [p for _, p in sorted((xxhash.xxh64_intdigest(p), p) for p in parts)]


def fit_toxicity(
    texts: list[bytes], y: np.ndarray, counts: dict, ordinary_bytes: int, toxic_bytes: int, plain_bytes: int, longest: int
) -> ToxicityModel:
    known = sum(counts.values())
    prior = counts.get(1, 0) / known if known else 0.5
    texts = [t.lower() for t in texts]
    toxic = [t for t in dict.fromkeys(t for t, c in zip(texts, y) if c == 1) if t]
    ordinary = [t for t in dict.fromkeys(t for t, c in zip(texts, y) if c == 0) if t]
    if not toxic or not ordinary:
        return ToxicityModel(b"", b"", (0.0,) * (1 + N_EVIDENCE), prior)
    # Half of the ordinary texts for the dictionary, the others to calibrate.
    half = {t for t in ordinary if xxhash.xxh64_intdigest(t) % 2}
    if not half or len(half) == len(ordinary):
        half = set()
    pieces = _by_hash([t[i : i + 256] for t in ordinary if t in half or not half for i in range(0, len(t), 256)])
    windows = _by_hash([t[i : i + WINDOW] for t in toxic for i in range(0, max(1, len(t) - WINDOW + STEP), STEP)])
    d_plain = b"".join(pieces)[:plain_bytes] + _dictionary(ordinary_bytes, pieces)
    d_toxic = _dictionary(toxic_bytes, windows, k=16, d=6)
    d_toxic += b"".join(b" " + w for w in typical_stretches(toxic, ordinary, longest)) + b" "
    used = [i for i, t in enumerate(texts) if y[i] == 1 or t not in half]
    y = y[used]
    got = np.bincount(y, minlength=2)
    weight = np.array([counts.get(c, 0) / max(1, got[c]) for c in (0, 1)])[y]
    x = np.array([_evidence(texts[i], d_plain, d_toxic) for i in used])
    a = _fit(x, y.astype(float), weight * len(y) / weight.sum())
    return ToxicityModel(d_plain, d_toxic, tuple(a.tolist()), prior)


def score_texts(m: ToxicityModel, bufs: list[bytes | None]) -> np.ndarray:
    if not m.toxic:
        return np.full(len(bufs), m.prior)
    x = np.array([_evidence(b, m.ordinary, m.toxic) for b in bufs]).reshape(-1, N_EVIDENCE)
    return 1 / (1 + np.exp(-np.clip(m.weights[0] + x @ np.array(m.weights[1:]), -30, 30)))


def predict_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 3, held: int = 1,
    threshold: float = 0.7, **kw,
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row.  Null and empty
    texts have no evidence and score what such texts score.  Repeated rows
    score alike; other columns are ignored; an empty table gives no rows."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    model = spark.sparkContext.broadcast(train_toxicity(rows.where(fold("doc_id", folds) != held), labels, **kw))

    @F.pandas_udf("double")
    def score(bufs: pd.Series) -> pd.Series:
        return pd.Series(score_texts(model.value, bufs.tolist()))

    scored = rows.select("doc_id", (fold("doc_id", folds) == held).alias("held_out"), score(utf8("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
