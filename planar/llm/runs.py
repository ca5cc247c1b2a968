"""Periodic runs of words by string synchronising sets.

A run is a stretch of words with smallest period ``q``, at least four times
as long, that no neighbouring word extends.  At each dyadic scale ``t`` a
text's synchronising set holds places chosen by the smallest hash of ``t``
words nearby, so equal contexts hold the same places; places in highly
periodic regions (period up to ``t / 4``) take no part.  Two successive places
of the set whose ``2 t`` words are equal, ``t`` to ``2 t`` apart, propose
their distance as a period.  The regions left out are those of runs already
found at smaller scales; the smallest periods, below the first scale, come
from a direct comparison of each word with the one ``q`` before it.  A
proposal is extended word by word to its maximal run.

Why no run is missed: let it begin at ``s`` with period ``q`` and at least
``4 q`` words, and let ``t <= q < 2 t``.  The ``3 t`` words from ``s`` are not
highly periodic (else ``q`` would not be the smallest period), so one of the
places ``s .. s + t - 1`` is in the set; the place ``q`` on has the same
context, which ends inside the run, and no place between them has it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planar.llm.common import pack_docs, prepare, utf8, word_chunks

FIRST_SCALE = 8
PACK_BYTES = 1 << 20
LONG_TEXT = 4 << 20  # longer texts are compared by 64-bit hashes of their words


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _window_min(x: np.ndarray, size: int) -> np.ndarray:
    have = 1
    while 2 * have <= size:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    more = size - have
    return np.minimum(x[:-more], x[more:]) if more else x


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.r_[False, same, False].astype(np.int8)))
    return edge[::2], edge[1::2]


def _extend(w: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """The largest stretch around ``at`` in which words ``q`` apart are equal."""
    n, step, hi = len(w), 64, at
    while hi + q < n:
        part = w[hi : min(hi + step, n - q)] == w[hi + q : min(hi + step, n - q) + q]
        k = len(part) if part.all() else int(np.argmin(part))
        hi += k
        if k < len(part):
            break
        step *= 2
    lo, step = at, 64
    while lo > 0:
        a = max(0, lo - step)
        part = (w[a:lo] == w[a + q : lo + q])[::-1]
        k = len(part) if part.all() else int(np.argmin(part))
        lo -= k
        if k < len(part):
            break
        step *= 2
    return lo, hi + q


class Runs:
    """Maximal runs of a word sequence: ``found`` maps ``(start, end)`` to the
    period.  Sequences of several texts may be joined by marks that occur only
    once; ``longest`` is then the longest text's length."""

    def __init__(self, w: np.ndarray, longest: int, min_length: int):
        self.w, self.min_length = w, min_length
        self.found: dict[tuple[int, int], int] = {}
        for q in range(1, min(FIRST_SCALE, longest // 4 + 1)):
            a, b = _stretches(w[q:] == w[:-q])
            for s, e in zip(a.tolist(), b.tolist()):
                self._add(s, e + q, q)
        h = w.astype(np.uint64)
        with np.errstate(over="ignore"):
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
            t = 1
            while 4 * t <= longest:
                if t >= FIRST_SCALE:
                    self._scale(h, t)
                if len(h) <= t:
                    break
                h = _mix(h[:-t] * np.uint64(0x9E3779B97F4A7C15) + h[t:] + np.uint64(t))
                t *= 2

    def _add(self, s: int, e: int, q: int) -> None:
        if e - s >= max(self.min_length, 4 * q):
            self.found[s, e] = min(q, self.found.get((s, e), q))

    def _scale(self, h: np.ndarray, t: int) -> None:
        """Periods ``t .. 2 t - 1``; ``h[i]``: hash of the ``t`` words from i."""
        n = len(self.w)
        if n < 4 * t:
            return
        top = np.uint64(0xFFFFFFFFFFFFFFFF)
        h = h | np.uint64(1)
        free = h.copy()
        for (s, e), q in self.found.items():
            if 4 * q <= t and e - s >= t:
                free[s : e - t + 1] = top & ~np.uint64(1)  # larger than any hash kept
        low = _window_min(free, t + 1)
        m = len(low)
        sync = np.flatnonzero((low != (top & ~np.uint64(1))) & ((free[:m] == low) | (free[t : t + m] == low)))
        if len(sync) < 2:
            return
        with np.errstate(over="ignore"):
            context = _mix(h[sync] * np.uint64(0x9E3779B97F4A7C15) + h[sync + t])
        order = np.argsort(context, kind="stable")
        same = np.flatnonzero(context[order[1:]] == context[order[:-1]])
        at = sync[order[same]]
        q = sync[order[same + 1]] - at
        ok = (q >= t) & (q < 2 * t)
        at, q = at[ok], q[ok]
        by = np.lexsort((at, q))
        done, period = -1, -1  # the last stretch of the period at hand ends here
        for a, p in zip(at[by].tolist(), q[by].tolist()):
            if p == period and a < done:
                continue
            s, e = _extend(self.w, a, p)
            period, done = p, e - p
            self._add(s, e, p)


def periodic_runs_of(w: np.ndarray, min_length: int = 6) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of one sequence of whole numbers, by start,
    then period."""
    return sorted((s, e - s, q) for (s, e), q in Runs(w, len(w), min_length).found.items()) if len(w) else []


def _collapse(keep: np.ndarray, runs: list[tuple[int, int, int]]) -> None:
    for s, length, q in runs:
        keep[s + q : s + length] = False


def _long(buf: bytes, min_length: int) -> tuple[list, bytes]:
    """Runs and remaining words of one very long text, a piece at a time."""
    ids = [np.fromiter(map(xxhash.xxh3_64_intdigest, part), np.uint64, len(part)) for part in word_chunks(buf)]
    w = np.concatenate(ids).astype(np.int64)
    del ids
    runs = periodic_runs_of(w, min_length)
    keep = np.ones(len(w), bool)
    del w
    _collapse(keep, runs)
    out, at = [], 0
    for part in word_chunks(buf):
        left = b" ".join(compress(part, keep[at : at + len(part)].tolist()))
        if left:
            out.append(left)
        at += len(part)
    return runs, b" ".join(out)


def _pack(bufs: list[bytes], min_length: int) -> list[tuple[list, bytes]]:
    """Runs and remaining words of several texts, searched as one sequence
    with a mark of its own behind each text."""
    ids: dict = {}
    number = ids.setdefault
    words, seq, bounds = [], [], [0]
    for k, buf in enumerate(bufs):
        part = buf.split()
        words.append(part)
        seq += [number(x, len(ids)) for x in part]
        seq.append(-1 - k)
        bounds.append(len(seq))
    w = np.array(seq, np.int64)
    longest = max((len(p) for p in words), default=0)
    begin = np.array(bounds)
    runs: list[list] = [[] for _ in bufs]
    for (s, e), q in sorted(Runs(w, longest, min_length).found.items()):
        k = int(np.searchsorted(begin, s, side="right")) - 1
        runs[k].append((s - bounds[k], e - s, q))
    out = []
    for part, found in zip(words, runs):
        if found:
            keep = np.ones(len(part), bool)
            _collapse(keep, found)
            part = compress(part, keep.tolist())
        out.append((sorted(found), b" ".join(part)))
    return out


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _find(min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(1)
            bufs = [x if (x := col[i].as_py()) is not None else b"" for i in range(batch.num_rows)]
            for i, j in pack_docs(bufs, PACK_BYTES):
                part = bufs[i:j]
                found = [_long(part[0], min_length)] if len(part[0]) > LONG_TEXT else _pack(part, min_length)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r, _ in found], pa.list_(RUN)),
                        pa.array([c for _, c in found], pa.binary()),
                    ],
                    names=["doc_id", "runs", "collapsed"],
                )

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6) -> DataFrame:
    """``(doc_id, runs, collapsed)``, one row per input row: the runs of at
    least ``min_length`` words and four periods as ``(start, length, period)``
    by start, then period, and the text with each run cut to its first period
    (its words joined by single spaces).

    Null and empty texts have no words, no runs and an empty rest.  Results
    depend on the text alone, so null, repeated or clashing ids do no harm;
    other columns are ignored; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return (
        docs.select(F.col(id_col).alias("doc_id"), utf8(text_col).alias("text"))
        .mapInArrow(_find(min_length), f"doc_id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed binary")
        .withColumn("collapsed", F.col("collapsed").cast("string"))
    )


SPACE = " \t\n\x0b\x0c\r"


def planted_periods(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text; for ids whose crc32 is divisible by 10 its words from some
    place on repeat with some period (both given by the crc32)."""
    h = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    trimmed = F.btrim(F.coalesce(F.col(text_col), F.lit("")), F.lit(SPACE))

    def plant(words: Column) -> Column:
        n = F.size(words)
        g = F.floor(h / 10)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        take = lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), take), " ")

    # A lambda's argument holds the words, so that they are split once.
    planted = F.transform(F.array(F.split(trimmed, r"[\x20\x09-\x0D]+")), plant)[0]
    return F.when((h % 10 == 0) & (trimmed != ""), planted).otherwise(F.col(text_col))


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The runs of the texts with planted periods, per document: ``(doc_id,
    n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256)``; the four in the middle are those of the longest run
    (ties: smallest start, then period)."""
    found = periodic_runs(docs.select(F.col(id_col).alias("doc_id"), planted_periods(id_col, text_col).alias("text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("best", best)
    n, p = F.col("best.n"), -F.col("best.p")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), n.alias("length"), p.alias("period"),
        F.expr("1000 * best.n div -best.p").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


RUNS_SQL = r"""
with d as (select row_number() over () rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') ws,
   xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(coalesce(doc_id::varchar, ''), ''),
          lambda c: [ord(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
       lambda x, y: xor(xor(x, y) >> 1, 3988292384 * (xor(x, y) & 1))), 4294967295) h from documents),
g as (select rid, doc_id, ws, h, len(ws) n, case when h % 10 = 0 and len(ws) > 0 then (h // 10) % len(ws) end a,
        case when h % 10 = 0 and len(ws) > 0 then 1 + (len(ws) - (h // 10) % len(ws)) // (3 + (h // 10) % 8) end p from d),
t as (select rid, doc_id, case when a is null then ws
        else list_transform(range(n), lambda i: ws[(case when i < a then i else a + (i - a) % p end) + 1]) end ws from g),
u as (select rid, unnest(range(len(ws))) i, unnest(ws) w from t),
e as (select x.rid, x.i, y.i - x.i q from u x join u y on x.rid = y.rid and x.w = y.w and y.i > x.i
      join (select rid, len(ws) n from t) z on z.rid = x.rid where 4 * (y.i - x.i) <= n),
b as (select rid, q, min(i) s, max(i) + 1 + q e from (select rid, q, i, i - row_number() over (partition by rid, q order by i) k from e) group by rid, q, k),
r as (select rid, s, e - s n, min(q) q from b where e - s >= greatest(6, 4 * q) group by rid, s, e),
best as (select rid, arg_max(struct_pack(s := s, n := n, q := q), (n, -s, -q)) x, count(*) c,
         string_agg(s || ',' || n || ',' || q || chr(10), '' order by s, q) listed from r group by rid),
gone as (select distinct rid, unnest(range(s + q, s + n)) i from r),
rest as (select u.rid, string_agg(w, ' ' order by u.i) kept from u left join gone on u.rid = gone.rid and u.i = gone.i where gone.i is null group by u.rid)
select t.doc_id, coalesce(c, 0)::bigint n_runs, x.s::bigint "start", x.n::bigint length, x.q::bigint period,
       (1000 * x.n // x.q)::bigint exponent_milli, sha256(coalesce(listed, '')) runs_sha256, sha256(coalesce(kept, '')) collapsed_sha256
from t left join best using (rid) left join rest using (rid)
"""
