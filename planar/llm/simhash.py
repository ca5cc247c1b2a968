"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints: one bit per position, set when more than half of the shingle
hashes have it set.  Two fingerprints link when they differ in at most
``max_bits`` bits; components of links are the near-duplicate groups.

The index has two parts.  Its upper nodes are masked bit patterns
``(mask, pattern)``: the 64 bits are cut into ``max_bits + 1`` runs, and a
pair within ``max_bits`` agrees on a whole run, so it meets under that run's
pattern.  A pattern that holds more than ``max_group`` fingerprints is cut
again by runs of its remaining bits, which keeps the guarantee.  Under a
pattern, fingerprints are sorted by Gray rank, neighbours are joined into
leaves, leaves into nodes; each node keeps the bits that all its members
share.  Two nodes are compared by the differences of their shared bits,
accumulated on the way down, and dropped as soon as these exceed the bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planar.llm.common import prepare, tidy_worker, utf8, word_chunks
from planar.llm.components import connected_components

LEAF, FAN = 16, 8
PAIR_CHUNK = 1 << 20
FULL = (1 << 64) - 1


# --- fingerprints -----------------------------------------------------------
def simhash(buf: bytes | None, k: int, seed: int = 42) -> int:
    """64-bit SimHash of a text's ``k``-word shingles, repeats included.
    Fewer than ``k`` words: the whole sequence is the one shingle; none: 0."""
    if not buf:
        return 0
    digest = xxhash.xxh64_intdigest
    counts, n, carry = np.zeros(64, np.int64), 0, []
    for words in word_chunks(buf.lower()):
        words = carry + words
        m = len(words) - k + 1
        if m > 0:
            joined = b" ".join(words)
            lens = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(lens + 1) - 1
            cuts = zip((ends - lens)[:m].tolist(), ends[k - 1 :].tolist())
            h = np.fromiter((digest(joined[i:j], seed) for i, j in cuts), np.uint64, m)
            counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            n += m
            words = words[m:]
        carry = words
    if n == 0:
        if not carry:
            return 0
        return digest(b" ".join(carry), seed)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprint_udf(k: int, seed: int = 42):
    """Column function: SimHash of a binary text column, as a signed long."""

    @F.pandas_udf("long")
    def fingerprint(bufs: pd.Series) -> pd.Series:
        tidy_worker()
        out = np.fromiter((simhash(b, k, seed) for b in bufs), np.uint64, len(bufs))
        return pd.Series(out.view(np.int64))

    return fingerprint


# --- index ------------------------------------------------------------------
def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each code word in the reflected Gray order."""
    r = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def _runs(mask: int, parts: int) -> list[int]:
    """Cut the bits outside ``mask`` into ``parts`` runs; each result is the
    mask with one run added."""
    free = [i for i in range(64) if not mask >> i & 1]
    cuts = [round(j * len(free) / parts) for j in range(parts + 1)]
    return [mask | sum(1 << i for i in free[a:b]) for a, b in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _under(fp: Column, masks: list[int]) -> Column:
    return F.explode(
        F.array(*[F.struct(F.lit(_signed(m)).alias("mask"), fp.bitwiseAND(F.lit(_signed(m))).alias("pattern")) for m in masks])
    )


def patterns(fps: DataFrame, max_bits: int, max_group: int) -> DataFrame:
    """``(mask, pattern, fp)``: each fingerprint under its upper nodes, none
    of which holds more than ``max_group`` (or 2^(bits left) once fewer than
    ``4 * (max_bits + 1)`` bits are left, a bound of its own)."""
    spark = fps.sparkSession
    parts = max_bits + 1
    masks = _runs(0, parts)
    rows = fps.select("fp", _under(F.col("fp"), masks).alias("n")).select("n.mask", "n.pattern", "fp")
    done = None
    while True:
        masks = [m for m in masks if (~m & FULL).bit_count() >= 4 * parts]
        full = (
            rows.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("n"))
            .where((F.col("n") > max_group) & F.col("mask").isin([_signed(m) for m in masks]))
            .select("mask", "pattern").checkpoint()
        )
        if not masks or full.isEmpty():
            return rows if done is None else done.unionByName(rows)
        rest = rows.join(full, ["mask", "pattern"], "left_anti")
        done = rest if done is None else done.unionByName(rest)
        # Each mask's next cuts are constants: at most parts ** level masks,
        # a bounded table that every task can hold.
        cuts = [(_signed(m), [_signed(x) for x in _runs(m, parts)]) for m in masks]
        cut_of = F.broadcast(spark.createDataFrame(cuts, "mask long, cuts array<long>"))
        rows = (
            rows.join(full, ["mask", "pattern"], "left_semi").join(cut_of, "mask")
            .select("fp", F.explode("cuts").alias("mask"))
            .select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("pattern"), "fp")
            .distinct().checkpoint()
        )
        masks = list(dict.fromkeys(x & FULL for _, sub in cuts for x in sub))


def _node_level(start: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Shared bits and their pattern of the runs that begin at ``start``."""
    a = np.bitwise_and.reduceat(low, start)
    o = np.bitwise_or.reduceat(high, start)
    return a, o


def _expand(a: np.ndarray, b: np.ndarray, first: np.ndarray, last: np.ndarray):
    """All child pairs of the node pairs (a, b); for a == b each once."""
    na, nb = last[a] - first[a], last[b] - first[b]
    total = na * nb
    src = np.repeat(np.arange(len(a)), total)
    k = np.arange(len(src)) - np.repeat(np.cumsum(total) - total, total)
    x = first[a][src] + k // nb[src]
    y = first[b][src] + k % nb[src]
    keep = (a[src] != b[src]) | (x <= y)
    return x[keep], y[keep], src[keep]


class _Forest:
    """Union by smallest index, for edge arrays."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        r = self.root
        while True:
            rx, ry = r[x], r[y]
            open_ = rx != ry
            if not open_.any():
                return
            x, y, rx, ry = x[open_], y[open_], rx[open_], ry[open_]
            np.minimum.at(r, np.maximum(rx, ry), np.minimum(rx, ry))
            while True:
                rr = r[r]
                if np.array_equal(rr, r):
                    break
                r[:] = rr


def link_forest(group: np.ndarray, fp: np.ndarray, max_bits: int) -> np.ndarray:
    """Index of a linked representative for every fingerprint: fingerprints of
    one group within ``max_bits`` bits end under one representative.  Groups
    must be contiguous; the tree's root level is the group."""
    n = len(fp)
    order = np.lexsort((gray_rank(fp), group))
    g, x = group[order], fp[order]
    # Levels from the leaves up: begin of each node among the nodes below.
    levels, start = [], np.arange(n)
    node_g, low, high, width = g, x, x, LEAF
    while True:
        edge = np.flatnonzero(np.r_[True, node_g[1:] != node_g[:-1]])
        at = np.arange(len(node_g)) - np.repeat(edge, np.diff(np.r_[edge, len(node_g)]))
        start = np.flatnonzero(at % width == 0)
        low, high = _node_level(start, low, high)
        stop = np.r_[start[1:], len(node_g)]
        levels.append((start, stop, ~(low ^ high), low))
        node_g, width = node_g[start], FAN
        if len(np.unique(node_g)) == len(node_g):
            break
    forest = _Forest(n)
    top = np.arange(len(node_g))
    zero = np.zeros(len(top), np.int64)
    # Depth first in chunks, so the open pairs stay bounded.
    stack = [(len(levels) - 1, top, top, zero, levels[-1][2].copy())]
    while stack:
        lv, a, b, acc, common = stack.pop()
        if len(a) > PAIR_CHUNK // 64:
            cut = PAIR_CHUNK // 64
            for i in range(0, len(a), cut):
                stack.append((lv, a[i : i + cut], b[i : i + cut], acc[i : i + cut], common[i : i + cut]))
            continue
        first, last, _, _ = levels[lv]
        if lv == 0:
            # Leaves whose members are all under one representative already
            # have nothing to add.
            lo = np.minimum.reduceat(forest.root, first)
            hi = np.maximum.reduceat(forest.root, first)
            todo = ~((lo[a] == hi[a]) & (lo[b] == hi[b]) & (lo[a] == lo[b]))
            i, j, _ = _expand(a[todo], b[todo], first, last)
            near = (i != j) & (np.bitwise_count(x[i] ^ x[j]) <= max_bits)
            forest.add(i[near], j[near])
            continue
        i, j, src = _expand(a, b, first, last)
        _, _, mask, pattern = levels[lv - 1]
        shared = mask[i] & mask[j]
        acc = acc[src] + np.bitwise_count((pattern[i] ^ pattern[j]) & shared & ~common[src]).astype(np.int64)
        # Bits shared by both parents are shared by the children with the
        # same values, so the parents' differences stand.
        keep = acc <= max_bits
        stack.append((lv - 1, i[keep], j[keep], acc[keep], shared[keep]))
    out = np.empty(n, np.int64)
    out[order] = order[forest.root]
    return out


def _links(max_bits: int, chunk_rows: int = 1 << 18):
    """Edges of a spanning forest per chunk of whole groups, for a partition
    sorted by (mask, pattern)."""

    def flush(parts) -> pa.RecordBatch:
        m, p, f = (np.concatenate([x[i] for x in parts]) for i in range(3))
        group = np.cumsum(np.r_[0, (m[1:] != m[:-1]) | (p[1:] != p[:-1])])
        rep = link_forest(group, f.view(np.uint64), max_bits)
        own = rep != np.arange(len(f))
        return pa.RecordBatch.from_arrays([pa.array(f[rep[own]]), pa.array(f[own])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if rows >= chunk_rows:
                # Close the chunk at the first group boundary of this batch.
                last = (held[-1][0][-1], held[-1][1][-1])
                new = np.flatnonzero((cols[0] != last[0]) | (cols[1] != last[1]))
                if len(new):
                    held.append([c[: new[0]] for c in cols])
                    yield flush(held)
                    cols = [c[new[0] :] for c in cols]
                    held, rows = [], 0
            held.append(cols)
            rows += len(cols[0])
        if held:
            yield flush(held)

    return run


def simhash_components(fps: DataFrame, max_bits: int = 4, max_group: int = 20_000) -> DataFrame:
    """``(fp, root)`` for each distinct fingerprint of ``fps`` that links to
    another; root is the smallest fingerprint of its component."""
    rows = patterns(fps.select("fp").distinct(), max_bits, max_group)
    sorted_rows = rows.select("mask", "pattern", "fp").repartition("mask", "pattern").sortWithinPartitions("mask", "pattern")
    edges = sorted_rows.mapInArrow(_links(max_bits), "a long, b long")
    return connected_components(edges).select(F.col("node").alias("fp"), "root")


def simhash_near_dups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    max_bits: int = 4,
    max_group: int = 20_000,
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per input row.

    Null and blank texts have fingerprint zero, linked like any other.
    ``component_id`` is the smallest id reachable over links (null ids are
    passed over; null if a component has no other).  Repeated rows keep a row
    each; other columns are ignored, whatever their names.  An empty table
    gives no rows.

    Equal fingerprints collapse (map side first) before any pair is sought,
    so a group of copies of any size is one entry of the index.
    """
    prepare(docs.sparkSession)
    fp = docs.select(
        F.col(id_col).alias("doc_id"), fingerprint_udf(shingle)(utf8(text_col)).alias("fp")
    ).checkpoint()
    groups = fp.groupBy("fp").agg(F.min("doc_id").alias("first_id")).checkpoint()
    comp = simhash_components(groups, max_bits, max_group)
    of = groups.join(comp, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    ids = of.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # Written out, so that adaptive execution may split a hot root: a join
    # whose result is shuffled again at once stays as it is.
    named = of.join(ids, "root").select("fp", "component_id").checkpoint()
    return fp.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The input rows without near-duplicates: of each component the row with
    the smallest id stays (null ids last; of rows that share that id, the one
    whose content sorts first), with all its columns."""
    prepare(docs.sparkSession)
    shingle, max_bits, max_group = kw.get("shingle", 4), kw.get("max_bits", 4), kw.get("max_group", 20_000)
    cols = docs.columns
    content = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols])), 256)
    # fp and the row key travel without the text.
    keyed = docs.select(
        fingerprint_udf(shingle)(utf8(text_col)).alias("fp"),
        F.struct(F.col(id_col).isNull().alias("z"), F.col(id_col).alias("i"), content.alias("c")).alias("key"),
    ).checkpoint()
    best = keyed.groupBy("fp").agg(F.min("key").alias("key")).checkpoint()
    comp = simhash_components(best, max_bits, max_group)
    kept = (
        best.join(comp, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("key").alias("key"))
        .select(F.col("key.c").alias("_kept"))
    )
    marked = docs.withColumn("_kept", content)
    # Rows equal in every column count as one.
    return marked.join(kept, "_kept", "left_semi").dropDuplicates(["_kept"]).select(*[F.col(f"`{c}`") for c in cols])
