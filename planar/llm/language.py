"""Language identification: script ranges, per-word scores, Viterbi spans.

Words are runs of letters.  A word's script (from its first letter) narrows
the languages to those seen in that script; letter trigrams give each
remaining language a log score; Viterbi with a fixed switching penalty labels
the words, and runs of one label are the spans of the text.  The language of
a text is the one whose spans hold most letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planar.llm.common import fold, pack_docs, prepare, tidy_worker, utf8

UND = "und"
BLOCK = 128  # words per Viterbi block
FAR = -1e4  # score of a language outside a word's script

# First and last code point of Unicode script ranges.
SCRIPTS = [
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x06FF),
    ("arabic", 0x0750, 0x077F), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF), ("gurmukhi", 0x0A00, 0x0A7F),
    ("gujarati", 0x0A80, 0x0AFF), ("tamil", 0x0B80, 0x0BFF), ("telugu", 0x0C00, 0x0C7F), ("kannada", 0x0C80, 0x0CFF),
    ("malayalam", 0x0D00, 0x0D7F), ("thai", 0x0E00, 0x0E7F), ("lao", 0x0E80, 0x0EFF), ("tibetan", 0x0F00, 0x0FFF),
    ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("ethiopic", 0x1200, 0x137F), ("khmer", 0x1780, 0x17FF),
    ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
    ("han", 0x20000, 0x2FA1F),
]
SCRIPT_NAMES = ["other", *dict.fromkeys(s for s, _, _ in SCRIPTS)]


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: is it a letter, and its script."""
    letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    script = np.zeros(0x110000, np.uint8)
    for name, a, b in SCRIPTS:
        script[a : b + 1] = SCRIPT_NAMES.index(name)
    return letter, script


@dataclass
class LanguageModel:
    """``table[h, l]``: log score of trigram bucket ``h`` under language ``l``;
    ``allowed[s, l]``: whether ``l`` was seen in script ``s``."""

    langs: list[str]
    table: np.ndarray
    allowed: np.ndarray
    penalty: float


def _pieces(buf: bytes, size: int = 1 << 20) -> Iterator[str]:
    """A text in pieces of about ``size`` bytes, cut at ASCII white space."""
    pos, n = 0, len(buf)
    while pos < n:
        end = min(n, pos + size)
        while end < n and buf[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield buf[pos:end].decode("utf-8", "replace")
        pos = end


def _trigrams(text: str, buckets: int):
    """Per letter its trigram bucket (word edges are 0), the letter index at
    which each word begins, each word's script and its first code unit."""
    letter, script = _tables()
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letter[cp]
    at = np.flatnonzero(is_letter)
    if len(at) == 0:
        return np.zeros(0, np.int64), at, np.zeros(0, np.uint8), at
    masked = np.zeros(len(cp) + 2, np.uint32)
    masked[1:-1] = cp * is_letter
    a, b, c = masked[at], masked[at + 1], masked[at + 2]
    with np.errstate(over="ignore"):
        h = (a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA77) + np.uint32(0x165667B1)) ^ (c * np.uint32(0xC2B2AE3D))
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
    h >>= np.uint32(32 - (buckets.bit_length() - 1))
    begin = np.flatnonzero(a == 0)
    return h, begin, script[b[begin]], at[begin]


def train_language_model(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    buckets: int = 1 << 15,
    penalty: float = 12.0,
    smoothing: float = 0.5,
    min_script_share: float = 1e-3,
) -> LanguageModel:
    """Trigram and script counts per language over all rows of ``docs`` whose
    text and language are not null.  Counting is a distributed sum; what
    reaches the driver is ``languages x (buckets + scripts)`` counts."""
    prepare(docs.sparkSession)
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), utf8(text_col).alias("bytes")
    )
    scripts = len(SCRIPT_NAMES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        tidy_worker()
        for batch in batches:
            for lang, buf in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                c = sums.setdefault(lang, np.zeros(buckets + scripts, np.int64))
                for text in _pieces(buf):
                    h, _, s, _ = _trigrams(text, buckets)
                    np.add.at(c, h.astype(np.int64), 1) if len(h) < 2000 else np.add(c[:buckets], np.bincount(h, minlength=buckets), out=c[:buckets])
                    c[buckets:] += np.bincount(s, minlength=scripts)
        for lang, c in sums.items():
            i = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(i), pa.string()), pa.array(i.astype(np.int32)), pa.array(c[i])], names=["lang", "i", "n"]
            )

    counts = rows.mapInArrow(count, "lang string, i int, n long").groupBy("lang", "i").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique().tolist())
    table = np.zeros((buckets + scripts, len(langs)))
    table[counts["i"], counts["lang"].map({v: k for k, v in enumerate(langs)}).astype(int)] = counts["n"]
    seen = table[buckets:]
    allowed = seen > min_script_share * np.maximum(1, seen.sum(axis=0))
    grams = table[:buckets] + smoothing
    return LanguageModel(langs, np.log(grams / grams.sum(axis=0)).astype(np.float32), allowed, penalty)


# --- Viterbi ----------------------------------------------------------------
def viterbi(scores: np.ndarray, doc_start: np.ndarray, penalty: float) -> np.ndarray:
    """Best label per word for documents laid end to end (``doc_start``: the
    first word of each, none empty).  Documents are cut into blocks; a first
    pass finds, for all blocks at once, the best score from every entry label
    to every exit label, these are chained per document, and a second pass
    walks each block between its now known ends."""
    n, L = scores.shape
    if n == 0 or L == 0:
        return np.zeros(n, np.int64)
    doc_end = np.r_[doc_start[1:], n]
    per_doc = -(-(doc_end - doc_start) // BLOCK)
    doc_of = np.repeat(np.arange(len(doc_start)), per_doc)
    nth = np.arange(len(doc_of)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    begin = doc_start[doc_of] + nth * BLOCK
    length = np.minimum(doc_end[doc_of], begin + BLOCK) - begin
    order = np.argsort(-length, kind="stable")
    begin, length, nth, doc_of = begin[order], length[order], nth[order], doc_of[order]
    alive = np.searchsorted(-length, -np.arange(length[0]), side="left")  # blocks longer than t
    switch = penalty * (1 - np.eye(L, dtype=scores.dtype))
    A = scores[begin][:, None, :] - switch[None]
    for t in range(1, length[0]):
        k = alive[t]
        x = A[:k]
        A[:k] = scores[begin[:k] + t][:, None, :] + np.maximum(x, x.max(axis=2, keepdims=True) - penalty)
    # Chain the blocks of each document.
    where = np.empty((len(doc_start), int(per_doc.max())), np.int64)
    where[doc_of, nth] = np.arange(len(begin))
    V = np.empty((len(begin), L), scores.dtype)
    first = where[:, 0]
    V[first] = A[first].max(axis=1)
    steps = [np.flatnonzero(per_doc > k) for k in range(where.shape[1])]
    for k in range(1, where.shape[1]):
        cur, prev = where[steps[k], k], where[steps[k], k - 1]
        V[cur] = (V[prev][:, :, None] + A[cur]).max(axis=1)
        V[cur] -= V[cur].max(axis=1, keepdims=True)
    exit_ = np.empty(len(begin), np.int64)
    entry = np.full(len(begin), -1, np.int64)
    last = where[np.arange(len(doc_start)), per_doc - 1]
    exit_[last] = V[last].argmax(axis=1)
    for k in range(where.shape[1] - 1, 0, -1):
        cur, prev = where[steps[k], k], where[steps[k], k - 1]
        entry[cur] = (V[prev] + A[cur, :, exit_[cur]]).argmax(axis=1)
        exit_[prev] = entry[cur]
    # Walk the blocks.
    D = scores[begin] - np.where((entry[:, None] >= 0) & (entry[:, None] != np.arange(L)), penalty, 0).astype(scores.dtype)
    back = np.zeros((length[0], len(begin), L), np.uint8 if L < 256 else np.int32)
    for t in range(1, length[0]):
        k = alive[t]
        x = D[:k]
        m, arg = x.max(axis=1, keepdims=True) - penalty, x.argmax(axis=1)
        stay = x >= m
        back[t, :k] = np.where(stay, np.arange(L), arg[:, None])
        D[:k] = scores[begin[:k] + t] + np.where(stay, x, m)
    labels = np.empty(n, np.int64)
    state = exit_.copy()
    for t in range(int(length[0]) - 1, -1, -1):
        k = alive[t]
        labels[begin[:k] + t] = state[:k]
        state[:k] = back[t, np.arange(k), state[:k]]
    return labels


def _word_scores(buf: bytes, model: LanguageModel):
    """Per word: scores of the languages, letters, position in the lowered text."""
    buckets = len(model.table)
    parts, base = [], 0
    for text in _pieces(buf):
        h, begin, script, at = _trigrams(text, buckets)
        if len(begin) and model.langs:
            s = np.add.reduceat(model.table[h], begin, axis=0)
            ok = model.allowed[script]
            known = ok.any(axis=1)
            s = np.where(ok, s, s.min(axis=1, keepdims=True) + np.float32(FAR))
            s[~known] = 0  # a script never learned says nothing
            parts.append((s, np.diff(np.r_[begin, len(h)]), at + base))
        base += len(text)
    if not parts:
        return np.zeros((0, len(model.langs)), np.float32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate([p[i] for p in parts]) for i in range(3))


def label_words(bufs: list[bytes | None], model: LanguageModel):
    """For each text ``(labels, letters, positions)`` of its words."""
    out = []
    for i, j in pack_docs(bufs):
        per = [_word_scores(b or b"", model) for b in bufs[i:j]]
        sizes = np.array([len(p[1]) for p in per])
        full = np.flatnonzero(sizes)
        if len(full):
            scores = np.concatenate([per[k][0] for k in full])
            starts = np.cumsum(sizes[full]) - sizes[full]
            labels = np.split(viterbi(scores, starts, model.penalty), starts[1:])
        else:
            labels = []
        of = dict(zip(full.tolist(), labels))
        out += [(of.get(k, np.zeros(0, np.int64)), per[k][1], per[k][2]) for k in range(j - i)]
    return out


def language_udf(model: LanguageModel):
    """Column function on binary text: ``(lang_pred, score)``; score is the
    share of letters in spans of the predicted language."""
    held = _broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def language(bufs: pd.Series) -> pd.DataFrame:
        tidy_worker()
        m, names, scores = held.value, [], []
        for labels, letters, _ in label_words(bufs.tolist(), m):
            if len(labels) == 0 or not m.langs:
                names.append(UND)
                scores.append(0.0)
                continue
            w = np.bincount(labels, weights=letters, minlength=len(m.langs))
            best = int(w.argmax())
            names.append(m.langs[best])
            scores.append(float(w[best] / w.sum()))
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return language


def _broadcast(value):
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession().sparkContext.broadcast(value)


def identify_languages(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``language_id (lang_pred, score)``.  Null
    texts and texts without a letter (or an untrained model) are ``und``,
    score 0.  One pass, no shuffle; other columns pass through."""
    prepare(docs.sparkSession)
    return docs.withColumn("language_id", language_udf(model)(utf8(text_col)))


def language_spans(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, start, words, lang)``: the labelled spans of each text, start
    being the offset (in characters of the lower-cased text) of the first word."""
    prepare(docs.sparkSession)
    held = _broadcast(model)

    @F.pandas_udf("array<struct<start:long,words:long,lang:string>>")
    def spans(bufs: pd.Series) -> pd.Series:
        m, out = held.value, []
        for labels, _, at in label_words(bufs.tolist(), m):
            cut = np.flatnonzero(np.r_[True, labels[1:] != labels[:-1]]) if len(labels) and m.langs else np.zeros(0, np.int64)
            ends = np.r_[cut[1:], len(labels)]
            out.append([{"start": int(at[i]), "words": int(j - i), "lang": m.langs[labels[i]]} for i, j in zip(cut, ends)])
        return pd.Series(out)

    return docs.select(F.col(id_col).alias("doc_id"), F.explode(spans(utf8(text_col))).alias("s")).select("doc_id", "s.*")


def predict_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5, held: int = 0
) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row, learned from the
    rows outside the held-out fold (crc32 of the id as text, modulo ``folds``)."""
    model = train_language_model(docs.where(fold(id_col, folds) != held), text_col, lang_col)
    out = identify_languages(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model)
    return out.select("doc_id", (fold("doc_id", folds) == held).alias("held_out"), "language_id.lang_pred", "language_id.score")
