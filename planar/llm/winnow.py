"""Benchmark decontamination by winnowing.

Texts are words; a window is ``window`` consecutive words of a benchmark item
(an item of fewer words is one window).  Fingerprints are hashes of ``gram``
consecutive words; of every ``window - gram + 1`` consecutive fingerprints
the smallest is kept, so any run of ``window`` equal words keeps the same
fingerprint on both sides, at the same place.  Kept fingerprints of documents
and items are joined, and each hit is extended word by word to the left and
right; a run of at least ``window`` equal words is an occurrence.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planar.llm.common import BitTable, counted_filter, keeps, pack_docs, prepare, text_key, tidy_worker, utf8

BITS = 24  # positions of the filter: 2^24 bits, 2 MB, whatever the input


@lru_cache(1)
def _word_byte() -> np.ndarray:
    """Digits, a-z and every byte of a non-ASCII character."""
    t = np.zeros(256, bool)
    t[0x30:0x3A] = t[0x61:0x7B] = t[0x80:] = True
    return t


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


BLOCK = 1 << 18  # bytes of text hashed at a time
LONG_WORD = 1 << 12


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    with np.errstate(over="ignore"):
        up = np.full(n, base, np.uint64)
        up[0] = 1
        down = np.full(n, pow(base, -1, 1 << 64), np.uint64)
        down[0] = 1
        return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def words_of(low: bytes):
    """Begin, end and 64-bit hash of every word of lower-cased bytes, a block
    (``BLOCK`` bytes and a little more) at most.  The hash is a polynomial
    from prefix sums, so it takes a few array steps; words of more than
    ``LONG_WORD`` bytes are hashed one by one."""
    raw = np.frombuffer(low, np.uint8)
    edge = np.flatnonzero(np.diff(np.r_[False, _word_byte()[raw], False].astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if len(start) == 0:
        return start, end, np.zeros(0, np.uint64)
    up, down = _powers(max(2 * BLOCK, len(raw)))
    keeps("winnow", _powers.cache_clear)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * down[: len(raw)], out=sums[1:])
        word = _mix((sums[end] - sums[start]) * up[start])
    for i in np.flatnonzero(end - start > LONG_WORD).tolist():
        word[i] = _word_hash(low[start[i] : end[i]])
    return start, end, word


_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def _blocks(buf: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``words_of`` a text of any length, block by block, none across a word."""
    pos, n = 0, len(buf)
    while pos < n:
        end = min(n, pos + BLOCK)
        if end < n and not _GAP.match(buf, end):
            gap = _GAP.search(buf, end, min(n, end + LONG_WORD))
            if gap:
                end = gap.start()
            elif n - end <= LONG_WORD:
                end = n
            else:  # a long word: what stands before it, or the word by itself
                at = end
                while at > pos and not _GAP.match(buf, at - 1):
                    at -= 1
                if at == pos:
                    gap = _GAP.search(buf, end)
                    end = gap.start() if gap else n
                    yield np.array([pos]), np.array([end]), np.array([_word_hash(buf[pos:end].lower())], np.uint64)
                    pos = end
                    continue
                end = at
        start, stop, word = words_of(buf[pos:end].lower())
        yield start + pos, stop + pos, word
        pos = end


def grams(word: np.ndarray, k: int, salt: int) -> np.ndarray:
    """Hash of each run of ``k`` words."""
    m = len(word) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    weight = _mix(np.arange(1, k + 1, dtype=np.uint64) + np.uint64(salt * 1000)) | np.uint64(1)
    with np.errstate(over="ignore"):
        total = np.full(m, salt, np.uint64)
        for j in range(k):
            total += word[j : j + m] * weight[j]
    return _mix(total)


def winnow(g: np.ndarray, ok: np.ndarray, w: int) -> np.ndarray:
    """Which fingerprints are a minimum of some window of ``w`` of them.
    ``ok``: windows that lie in one text.  Equal minima are all kept."""
    kept = np.zeros(len(g), bool)
    m = len(g) - w + 1
    if m <= 0:
        return kept
    low = g[:m].copy()
    for j in range(1, w):
        np.minimum(low, g[j : j + m], out=low)
    for j in range(w):
        kept[j : j + m] |= ok & (g[j : j + m] == low)
    return kept


def _picked(word: np.ndarray, doc: np.ndarray, shape, tags: list[int], passes) -> Iterator[tuple[int, int, int]]:
    """``(tag, place, hash)`` of the kept fingerprints that ``passes`` lets
    through; ``doc``: the text of each word.  Tag 0 marks winnowed
    fingerprints, tag n whole items of n words."""
    window, gram = shape
    reach = window - gram
    for tag in tags:
        k = tag or gram
        g = grams(word, k, tag)
        if len(g) == 0:
            continue
        if tag == 0:
            m = max(len(g) - reach, 0)
            keep = winnow(g, doc[:m] == doc[window - 1 :][:m], reach + 1)
        else:
            keep = doc[: len(g)] == doc[k - 1 :]
        at = np.flatnonzero(keep)
        at = at[passes(g[at])]
        yield from zip([tag] * len(at), at.tolist(), g[at].view(np.int64).tolist())


def _context(buf: bytes, start: np.ndarray, end: np.ndarray) -> bytes:
    """The words, lower-cased; a very long one by its hash behind a byte that
    no text holds."""
    words = [
        buf[s:e].lower() if e - s <= LONG_WORD else b"\xff" + hashlib.sha256(buf[s:e].lower()).hexdigest().encode()
        for s, e in zip(start.tolist(), end.tolist())
    ]
    return b" ".join(words)


def _found(tag: int, p: int, h: int, lo: int, hi: int, shape, context) -> tuple:
    """An anchor whose context covers what of ``lo .. hi`` a window around the
    fingerprint at ``p`` can reach."""
    window, gram = shape
    a = max(p - window + gram, lo) if tag == 0 else p
    b = min(p + window, hi) if tag == 0 else p + tag
    return tag, p - lo, h, p - a, context(a, b)


def _long_anchors(buf: bytes, shape, tags: list[int], passes) -> tuple[int, list[tuple]]:
    """``_anchors`` of one long text: a block of words at a time, and as many
    words around it as a window reaches."""
    window = shape[0]
    none = np.zeros(0, np.int64)
    start, end, word = none, none, np.zeros(0, np.uint64)
    off = done = 0  # the first word at hand, the first not yet decided
    out: list[tuple] = []
    for block in chain(_blocks(buf), [None]):
        if block is not None:
            start, end, word = (np.concatenate(x) for x in zip((start, end, word), block))
        total = off + len(word)
        upto = total if block is None else total - window
        if upto <= done:
            continue
        doc = np.zeros(len(word), np.int8)
        for tag, p, h in _picked(word, doc, shape, tags, passes):
            if done <= p + off < upto:
                out.append(_found(tag, p + off, h, 0, total, shape, lambda a, b: _context(buf, start[a - off : b - off], end[a - off : b - off])))
        done = upto
        keep = max(done - window - off, 0)
        start, end, word, off = start[keep:], end[keep:], word[keep:], off + keep
    return done, out


def _anchors(bufs: list[bytes | None], shape, tags: list[int], passes):
    """Per text: word count and the kept fingerprints that ``passes`` lets
    through, as ``(tag, position, hash, left, context)``; the context holds
    every word that a window around the fingerprint can reach."""
    out = []
    for i, j in pack_docs(bufs, BLOCK):
        part = [b or b"" for b in bufs[i:j]]
        if len(part) == 1 and len(part[0]) > BLOCK:
            out.append(_long_anchors(part[0], shape, tags, passes))
            continue
        text = b"\n".join(part)
        start, end, word = words_of(text.lower())
        base = np.cumsum([0] + [len(b) + 1 for b in part])
        doc = np.searchsorted(base, start, side="right") - 1
        first = np.searchsorted(doc, np.arange(len(part) + 1)).tolist()
        found: list[list] = [[] for _ in part]
        for tag, p, h in _picked(word, doc, shape, tags, passes):
            d = doc[p]
            found[d].append(_found(tag, p, h, first[d], first[d + 1], shape, lambda a, b: _context(text, start[a:b], end[a:b])))
        out += [(first[d + 1] - first[d], f) for d, f in enumerate(found)]
    return out


ANCHORS = "tag array<int>, pos array<int>, hash array<long>, left array<int>, ctx array<binary>"


def _anchor_frame(rows) -> pd.DataFrame:
    return pd.DataFrame(
        {"n_words": [n for n, _ in rows]}
        | {c: [[a[i] for a in f] for _, f in rows] for i, c in enumerate(("tag", "pos", "hash", "left", "ctx"))}
    )


def _verify(window: int, gram: int):
    """Extend each joined hit over equal words; keep runs long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tid, pos, tag, left, ctx, ileft, ictx, item_ctx = (batch.column(i).to_pylist() for i in range(8))
            keep, s, e = [], [], []
            for r in range(batch.num_rows):
                a, b, k = ctx[r].split(b" "), ictx[r].split(b" "), tag[r] or gram
                x, y = left[r], ileft[r]
                if a[x : x + k] != b[y : y + k]:
                    continue  # hashes collided
                lo = 0
                while lo < x and lo < y and a[x - lo - 1] == b[y - lo - 1]:
                    lo += 1
                hi = k
                while x + hi < len(a) and y + hi < len(b) and a[x + hi] == b[y + hi]:
                    hi += 1
                if lo + hi >= (tag[r] or window):
                    keep.append(r)
                    s.append(pos[r] - lo)
                    e.append(pos[r] + hi)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([tid[r] for r in keep], pa.binary()), pa.array(s, pa.int32()), pa.array(e, pa.int32()),
                    pa.array([item_ctx[r] for r in keep], pa.binary()),
                ],
                names=["tid", "s", "e", "item_ctx"],
            )

    return run


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    gram: int = 5,
    keep_columns: bool = False,
) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)``, one
    row per input row; with ``keep_columns`` the input's columns and
    ``_contaminated`` instead.

    Null and word-less texts have no words.  Repeated item ids are one item
    with the windows of all its rows; a row with a null item id marks words
    but names no item.  Empty tables (either side) give no hits.  Results
    depend on a text alone, so repeated, null or clashing document ids do no
    harm; other columns are ignored, whatever their names.

    The items' kept fingerprints set bits in a filter of fixed size (2 MB),
    which spares the documents' fingerprints that can have no partner the
    shuffle; those that pass are joined by hash.  A full filter only makes
    the join larger.
    """
    spark = docs.sparkSession
    prepare(spark)
    shape = (window, gram)
    short = list(range(1, window))

    @F.pandas_udf("n_words int, " + ANCHORS)
    def item_anchors(bufs: pd.Series) -> pd.DataFrame:
        rows = _anchors(bufs.tolist(), shape, [0, *short], lambda h: np.ones(len(h), bool))
        # An item shorter than the window is one window: its own length's tag.
        return _anchor_frame([(n, [a for a in f if a[0] == 0 or a[0] == n]) for n, f in rows])

    anchors = (
        items.select(F.col(item_id_col).cast("string").alias("item_id"), item_anchors(utf8(item_text_col)).alias("a"))
        .select("item_id", F.explode(F.arrays_zip("a.tag", "a.pos", "a.hash", "a.left", "a.ctx")).alias("a"))
        .select("item_id", "a.tag", "a.hash", "a.left", "a.ctx")
        .withColumn("item_ctx", F.substring(F.unhex(F.sha2(F.concat(F.concat_ws(",", "tag", "left").cast("binary"), F.lit(b","), F.col("ctx")), 256)), 1, 16))
        .checkpoint()
    )
    tags = [r[0] for r in anchors.select("tag").distinct().collect()]  # at most `window` values
    passes = BitTable(anchors.select("hash"), "hash", BITS)

    @F.pandas_udf("n_words int, " + ANCHORS)
    def doc_anchors(bufs: pd.Series) -> pd.DataFrame:
        tidy_worker("winnow")
        return _anchor_frame(_anchors(bufs.tolist(), shape, sorted(tags), passes))

    # Else a filter on its result would run it a second time in each task.
    doc_anchors = doc_anchors.asNondeterministic()

    if keep_columns:
        base = docs.withColumn("_a", doc_anchors(utf8(text_col)))
        text = F.col(text_col)
    else:
        base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), doc_anchors(utf8(text_col)).alias("_a"))
        text = F.col("text")
    marked = base.withColumn("_tid", F.when(F.size("_a.pos") > 0, text_key(text_col if keep_columns else "text")))
    if not keep_columns:
        marked = marked.select("doc_id", "_tid", "_a").checkpoint()
        scan = marked
    else:
        scan = marked.select("_tid", "_a")
    found = (
        scan.where(F.col("_tid").isNotNull())
        .select("_tid", F.explode(F.arrays_zip("_a.tag", "_a.pos", "_a.hash", "_a.left", "_a.ctx")).alias("a"))
        .select(F.col("_tid").alias("tid"), "a.tag", "a.pos", "a.hash", "a.left", "a.ctx")
    )
    if keep_columns:
        # A broadcast join would run both Python steps in one task, with a
        # worker each; the few fingerprints that passed go to tasks of their own.
        found = found.hint("rebalance")
    hits = (
        found
        .join(
            anchors.select("tag", "hash", F.col("left").alias("ileft"), F.col("ctx").alias("ictx"), "item_ctx").distinct(),
            ["tag", "hash"],
        )
        .select("tid", "pos", "tag", "left", "ctx", "ileft", "ictx", "item_ctx")
        .mapInArrow(_verify(window, gram), "tid binary, s int, e int, item_ctx binary")
        .distinct()
    )
    if keep_columns:
        bad = hits.select(F.col("tid").alias("_tid")).distinct().withColumn("_contaminated", F.lit(True)).checkpoint()
        cols = [F.col(f"`{c}`") for c in docs.columns]
        rows = docs.withColumn("_tid", text_key(text_col))
        # Only rows whose text may be one of them are shuffled for the join.
        few = counted_filter(bad.select(F.xxhash64("_tid").alias("h")), "h")
        if few is None:
            return rows.join(bad, "_tid", "left").select(*cols, F.coalesce("_contaminated", F.lit(False)).alias("_contaminated"))
        rows = rows.withColumn("_maybe", few.column(F.xxhash64("_tid")))
        met = rows.where("_maybe").join(bad, "_tid", "left").select(*cols, F.coalesce("_contaminated", F.lit(False)).alias("_contaminated"))
        return rows.where("not _maybe").select(*cols, F.lit(False).alias("_contaminated")).unionByName(met)
    hits = hits.checkpoint()
    spans = (
        hits.groupBy("tid").agg(F.sort_array(F.collect_set(F.struct("s", "e"))).alias("runs"))
        .select(
            "tid",
            F.aggregate(
                "runs",
                F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to")),
                lambda acc, x: F.struct(
                    (acc["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], acc["to"]))).alias("n"),
                    F.greatest(acc["to"], x["e"]).alias("to"),
                ),
                lambda acc: acc["n"],
            ).alias("n_hit"),
        )
    )
    named = (
        hits.select("tid", "item_ctx").distinct()
        .join(anchors.select("item_ctx", "item_id").distinct(), "item_ctx")
        .groupBy("tid").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    )
    per_text = spans.join(named, "tid", "left").select(F.col("tid").alias("_tid"), "n_hit", "ids")
    # Only texts with fingerprints that passed need the join.
    with_hits = marked.where(F.col("_tid").isNotNull()).join(per_text, "_tid", "left")
    without = marked.where(F.col("_tid").isNull()).withColumns({"n_hit": F.lit(None).cast("long"), "ids": F.lit(None).cast("array<string>")})
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return with_hits.unionByName(without).select(
        "doc_id",
        F.col("_a.n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


DECONTAMINATE_SQL = r"""
with dw as (select row_number() over () rid, doc_id,
              regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
iw as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
win as (select distinct item_id, least(len(w), 10) k, unnest([array_to_string(w[p:p+least(len(w), 10)-1], ' ') for p in range(1, len(w)-least(len(w), 10)+2)]) s
        from iw where len(w) > 0),
ks as (select distinct k from win),
dwin as (select rid, k, unnest(range(1, len(w)-k+2)) p, unnest([array_to_string(w[p:p+k-1], ' ') for p in range(1, len(w)-k+2)]) s
         from dw, ks where len(w) >= k),
occ as (select distinct rid, dwin.k, p, item_id from dwin join win on dwin.k = win.k and dwin.s = win.s),
hitw as (select rid, count(distinct q) n from (select rid, unnest(range(p, p+k)) q from occ) group by rid),
its as (select rid, count(*) n, string_agg(i, ',' order by i) ids from (select distinct rid, item_id::varchar i from occ where item_id is not null) group by rid)
select doc_id, len(w)::bigint n_words, coalesce(hitw.n, 0)::bigint n_hit, coalesce(its.n, 0)::bigint n_items,
       sha256(coalesce(its.ids, '')) items_sha256, coalesce(hitw.n, 0) > 0 contaminated
from dw left join hitw using (rid) left join its using (rid)
"""
