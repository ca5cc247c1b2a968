"""Document quality by a linear-chain conditional random field over lines.

Every line has features of itself and of its neighbours; the field labels
each line good or bad.  Training takes the document's label for its lines
and maximises the conditional likelihood of whole line sequences.  A
document's quality is the length-weighted mean of its lines' forward-backward
marginals, calibrated to the share of good documents.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planar.llm.common import fold, pack_docs, prepare, utf8

# Byte classes, fixed values: stops and quotes of running text, other marks.
STOPS = b".,;:?'\"()-"
CLASSES = 10  # lower, upper, digit, blank, stop, bar, exclamation, other mark, non-ASCII, control
N_LINE = CLASSES + 8


def _class_table() -> np.ndarray:
    t = np.full(256, 7, np.uint8)
    t[ord("a") : ord("z") + 1] = 0
    t[ord("A") : ord("Z") + 1] = 1
    t[ord("0") : ord("9") + 1] = 2
    t[[32, 9]] = 3
    t[list(STOPS)] = 4
    t[ord("|")] = 5
    t[ord("!")] = 6
    t[0x80:] = 8
    t[:9] = t[11:32] = t[127] = 9
    t[10] = 9
    return t


_TABLE = _class_table()


def line_features(bufs: list[bytes]):
    """Features of every line of the texts (split at newlines, empty lines
    left out), the lines' lengths in bytes, and each text's line count."""
    joined = b"\n".join(bufs) + b"\n"
    raw = np.frombuffer(joined, np.uint8)
    ends = np.flatnonzero(raw == 10)
    starts = np.r_[0, ends[:-1] + 1]
    base = np.cumsum([0] + [len(b) + 1 for b in bufs])
    real = ends > starts
    starts, ends = starts[real], ends[real]
    doc = np.searchsorted(base, starts, side="right") - 1
    per_doc = np.bincount(doc, minlength=len(bufs))[: len(bufs)]
    n = len(starts)
    if n == 0:
        return np.zeros((0, 3 * N_LINE), np.float32), np.zeros(0, np.int64), per_doc
    cls = _TABLE[raw]
    size = (ends - starts).astype(np.float64)
    x = np.zeros((n, N_LINE), np.float32)
    for c in range(CLASSES):
        at = np.zeros(len(raw) + 1, np.int32)
        np.cumsum(cls == c, out=at[1:])
        x[:, c] = (at[ends] - at[starts]) / size
    # Words: runs without blanks; how long, how varied, how often repeated.
    gap = (cls == 3) | (raw == 10)
    edge = np.flatnonzero(np.diff(np.r_[True, gap, True].astype(np.int8)))
    ws, we = edge[::2], edge[1::2]
    code = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(raw.astype(np.int64) ** 2 * 31 + raw, out=code[1:])
    h = (code[we] - code[ws]) * 1_000_003 + raw[ws].astype(np.int64) * 257 + raw[we - 1]
    line = np.searchsorted(starts, ws, side="right") - 1
    count = np.maximum(1, np.bincount(line, minlength=n))
    x[:, CLASSES] = np.log1p(size)
    x[:, CLASSES + 1] = size / count / 10
    same = np.r_[False, (h[1:] == h[:-1]) & (line[1:] == line[:-1])]
    x[:, CLASSES + 2] = np.bincount(line, weights=same, minlength=n) / count
    order = np.lexsort((h, line))
    again = np.zeros(len(h), bool)
    again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (line[order[1:]] == line[order[:-1]])
    x[:, CLASSES + 3] = np.bincount(line, weights=again, minlength=n) / count
    short = (we - ws) <= 3
    x[:, CLASSES + 4] = np.bincount(line, weights=short, minlength=n) / count
    x[:, CLASSES + 5] = _TABLE[raw[starts]] == 1
    x[:, CLASSES + 6] = _TABLE[raw[ends - 1]] == 4
    last = np.bincount(line, weights=np.isin(_TABLE[raw[we - 1]], (5, 6, 7)), minlength=n)
    x[:, CLASSES + 7] = last / count
    # Neighbouring lines of the same text.
    full = np.zeros((n, 3 * N_LINE), np.float32)
    full[:, :N_LINE] = x
    d = doc[1:] == doc[:-1]
    full[1:, N_LINE : 2 * N_LINE] = x[:-1] * d[:, None]
    full[:-1, 2 * N_LINE :] = x[1:] * d[:, None]
    return full, (ends - starts), per_doc


@dataclass
class LineField:
    """Weights of a two-label chain: ``unary`` scores good against bad from
    standardised features, ``trans[a, b]`` a step from label a to b."""

    mean: np.ndarray
    scale: np.ndarray
    unary: np.ndarray
    bias: float
    trans: np.ndarray
    calibration: tuple[float, float] = (0.0, 1.0)
    prior: float = 0.5
    bound: dict = field(default_factory=dict)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.unary + self.bias


def marginals(score: np.ndarray, per_doc: np.ndarray, trans: np.ndarray):
    """Forward-backward for texts laid end to end: P(good) of each line, the
    summed pair marginals (2 x 2), and the log likelihood's normaliser.

    All texts step together, in order of length, so the number of steps is
    that of the longest text."""
    n = len(score)
    per = per_doc[per_doc > 0]
    start = np.cumsum(per) - per
    order = np.argsort(-per, kind="stable")
    start, per = start[order], per[order]
    steps = int(per[0]) if len(per) else 0
    alive = np.searchsorted(-per, -np.arange(steps), side="left")
    T = np.exp(trans)
    # Scores as ratios; each step is normalised, its scale kept in `log_z`.
    e = np.ones((n, 2))
    shift = np.maximum(score, 0)
    e[:, 0], e[:, 1] = np.exp(-shift), np.exp(score - shift)
    alpha = np.empty((n, 2))
    log_z = shift.sum()
    for t in range(steps):
        k = start[: alive[t]] + t
        a = e[k] if t == 0 else (alpha[k - 1] @ T) * e[k]
        s = a.sum(axis=1, keepdims=True)
        alpha[k] = a / s
        log_z += np.log(s).sum()
    beta = np.ones((n, 2))
    pair = np.zeros((2, 2))
    for t in range(steps - 1, 0, -1):
        k = start[: alive[t]] + t
        eb = e[k] * beta[k]
        b = eb @ T.T
        joint = alpha[k - 1][:, :, None] * T * eb[:, None, :]
        pair += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        beta[k - 1] = b / b.sum(axis=1, keepdims=True)
    g = alpha * beta
    return (g[:, 1] / g.sum(axis=1)) if n else np.zeros(0), pair, log_z


def fit_field(
    x: np.ndarray, size: np.ndarray, per_doc: np.ndarray, label: np.ndarray, weight: np.ndarray, rounds: int = 150, l2: float = 1e-3
) -> LineField:
    """Maximum conditional likelihood by Adam steps over the whole sample.
    ``label`` and ``weight`` are per document."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = (x - mean) / scale
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    y = label[doc].astype(np.float64)
    inner = np.r_[False, doc[1:] == doc[:-1]] if len(doc) else np.zeros(0, bool)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:-1][inner[1:]].astype(int), y[1:][inner[1:]].astype(int)), 1.0)
    n = max(1, len(y))
    theta = np.zeros(z.shape[1] + 1 + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        w, b, trans = theta[: z.shape[1]], theta[z.shape[1]], theta[-4:].reshape(2, 2)
        p, pair, _ = marginals(z @ w + b, per_doc, trans)
        r = (y - p) / n
        grad = np.r_[z.T @ r - l2 * w, r.sum(), ((seen - pair) / n).ravel() - l2 * theta[-4:]]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    field_ = LineField(mean, scale, theta[: z.shape[1]], float(theta[z.shape[1]]), theta[-4:].reshape(2, 2))
    raw = document_scores(field_, x, size, per_doc)
    has = per_doc > 0
    field_.prior = float(np.average(label, weights=weight)) if len(label) else 0.5
    field_.calibration = fit_logistic(_logit(raw[has]), label[has].astype(float), weight[has])
    return field_


def document_scores(f: LineField, x: np.ndarray, size: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
    """Length-weighted mean of the lines' marginals (NaN without lines)."""
    p, _, _ = marginals(f.scores(x), per_doc, f.trans)
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    total = np.bincount(doc, weights=size, minlength=len(per_doc))
    with np.errstate(invalid="ignore"):
        return np.bincount(doc, weights=p * size, minlength=len(per_doc)) / total


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit_logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, l2: float = 1e-2) -> tuple[float, float]:
    """Weighted logistic regression of one variable, by Newton steps."""
    a = np.zeros(2)
    X = np.c_[np.ones(len(x)), x]
    w = w / max(w.sum(), 1e-9) * len(w) if len(w) else w
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(X @ a, -30, 30)))
        g = X.T @ (w * (y - p)) - l2 * a
        h = (X * (w * p * (1 - p))[:, None]).T @ X + l2 * np.eye(2)
        step = np.linalg.solve(h, g)
        a = a + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(a[0]), float(a[1])


def score_texts(f: LineField, bufs: list[bytes | None]) -> np.ndarray:
    out = []
    for i, j in pack_docs(bufs):
        x, size, per_doc = line_features([b or b"" for b in bufs[i:j]])
        raw = document_scores(f, x, size, per_doc)
        a, b = f.calibration
        with np.errstate(invalid="ignore"):
            p = 1 / (1 + np.exp(-np.clip(a + b * _logit(raw), -30, 30)))
        out.append(np.where(per_doc > 0, p, f.prior))
    return np.concatenate(out) if out else np.zeros(0)


def bounded_sample(docs: DataFrame, labels: DataFrame, label_col: str, per_label: int, max_bytes: int) -> tuple[pd.DataFrame, dict]:
    """At most ``per_label`` labelled texts of each label (lowest hash of the
    id first, texts above ``max_bytes`` passed over) and the labels' counts.
    Rows with the same id and text count once.
    Both bounds are parameters of training alone."""
    known = (
        labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max(label_col).cast("int").alias("label"))
    )
    # Hashed before the join, so that no text is shuffled.
    hashed = docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= max_bytes).select(
        "doc_id", F.xxhash64("doc_id").alias("h"), F.xxhash64("doc_id", "text").alias("h2")
    )
    ids = hashed.join(known, "doc_id").dropDuplicates(["doc_id", "h2"]).checkpoint()
    counts = {r["label"]: r["n"] for r in ids.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = ids.where("label = 0").orderBy("h", "h2").limit(per_label).unionByName(
        ids.where("label = 1").orderBy("h", "h2").limit(per_label)
    )
    chosen = F.broadcast(picked.select("doc_id", "h2", "label"))  # at most 2 * per_label rows
    sample = (
        docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("h2")).join(chosen, ["doc_id", "h2"])
        .dropDuplicates(["doc_id", "h2"]).select("label", utf8("text").alias("bytes"))
    )
    return sample.toPandas(), counts


def train_quality(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", per_label: int = 1000, max_bytes: int = 1 << 15
) -> LineField | float:
    """A line field fitted on a bounded sample: at most ``per_label`` texts of
    each label, of at most ``max_bytes`` bytes.  With one label only, the
    answer is its constant probability; with none, one half."""
    sample, counts = bounded_sample(docs, labels, label_col, per_label, max_bytes)
    if len(counts) < 2:
        return float(next(iter(counts), 0.5))
    y = sample["label"].to_numpy()
    got = np.bincount(y, minlength=2)
    weight = np.array([counts[c] / max(1, got[c]) for c in (0, 1)])[y]
    x, size, per_doc = line_features([b or b"" for b in sample["bytes"]])
    return fit_field(x, size, per_doc, y, weight)


def predict_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held: int = 0,
    threshold: float = 0.3, **kw,
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row.  Null texts and
    texts without a line score the label's share in training.  Repeated rows
    score alike; other columns are ignored; an empty table gives no rows."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    model = train_quality(rows.where(fold("doc_id", folds) != held), labels, **kw)
    held_model = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(bufs: pd.Series) -> pd.Series:
        m = held_model.value
        return pd.Series(np.full(len(bufs), m) if isinstance(m, float) else score_texts(m, bufs.tolist()))

    scored = rows.select("doc_id", (fold("doc_id", folds) == held).alias("held_out"), score(utf8("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
