"""Removal of repeated passages by a distributed difference-cover suffix order.

A passage is a string of ``length`` bytes that starts in two places.  Text is
first parsed into phrases whose borders depend on nearby bytes alone (minima
of hashes over ``WINDOW`` places), so equal strings hold equal phrases.  Runs
of phrases that occur more than once are sorted as strings over phrase names
by the difference-cover algorithm modulo 3: triples at the sampled places are
sorted and named, the names' suffixes are ranked the same way one level up,
the remaining suffixes are merged by counting, and neighbours in the order
are compared.  A place whose neighbour shares its prefix is a candidate; the
byte strings that begin before it, which the order cannot tell apart, are
then compared whole (by 128-bit hashes), so the answer is exact.

Why nothing is lost: let the string begin at ``s``.  Whether a place is a
border depends on ``WINDOW - 1`` bytes before it and ``WINDOW - 1 + GRAM``
after, so borders from ``s + WINDOW - 1`` to ``s + length - WINDOW - GRAM + 1``
are the same in both occurrences.  The first of them, the string's owner, is
at most ``s + 2 * WINDOW - 2``, and the phrases that end within
``reach(length)`` bytes of the owner, three at least, lie inside the string.
"""

from __future__ import annotations

import gc
import hashlib
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planar.llm.common import BitTable, counted_filter, prepare, tidy_worker, utf8

WINDOW, GRAM = 64, 16
NAME_BITS = TEXT_BITS = 27  # most bits of a filter of phrase names, of texts: 16 MB
SLICE = 1 << 20


def reach(length: int) -> int:
    """Bytes after its owner within which a passage's phrases are its own."""
    return length - 3 * WINDOW - GRAM + 3


# --- phrases ----------------------------------------------------------------
def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _slide(x: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every window of ``size`` places."""
    have = 1
    while 2 * have <= size:
        x = pick(x[:-have], x[have:])
        have *= 2
    more = size - have
    return pick(x[:-more], x[more:]) if more else x


def _minima(raw: np.ndarray) -> np.ndarray:
    n = len(raw) - GRAM + 1
    if n < WINDOW:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        x = raw.astype(np.uint64)
        for s in (1, 2, 4):
            x = x[:-s] | (x[s:] << np.uint64(8 * s))
        e = _mix(x)
        h = (_mix(e[:n] + e[8 : 8 + n] * np.uint64(3)) >> np.uint64(32)).astype(np.uint32)
    low = _slide(h, WINDOW, np.minimum)
    edge = np.zeros(WINDOW - 1, np.uint32)
    return np.flatnonzero(_slide(np.concatenate([edge, low, edge]), WINDOW, np.maximum) == h)


def borders(buf: bytes) -> np.ndarray:
    """Places that are the minimum of some window of ``WINDOW`` places."""
    raw = np.frombuffer(buf, np.uint8)
    if len(raw) <= SLICE:
        return _minima(raw)
    margin, out = WINDOW + GRAM, []
    for a in range(0, len(raw), SLICE):
        lo, hi = max(0, a - margin), min(len(raw), a + SLICE + margin)
        at = _minima(raw[lo:hi]) + lo
        # A slice's own edges are not the text's: keep what the margin vouches for.
        out.append(at[(at >= a) & (at < a + SLICE)])
    return np.concatenate(out)


def _parse(copied: BitTable | None = None):
    """Per text: its key, borders, and the name of each phrase (the bytes from
    a border to ``GRAM`` past the next).  With ``copied`` texts that may have
    copies, by the hash in the last column, are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = xxhash.xxh3_64_intdigest
        tidy_worker()
        for batch in batches:
            if copied is not None and batch.num_rows:
                batch = batch.filter(pa.array(~copied(batch.column(2).to_numpy())))
            bufs = batch.column(1)
            pos, names = [], []
            for r in range(batch.num_rows):
                buf = bufs[r].as_py()
                at = borders(buf)
                cut = at.tolist()
                h = np.fromiter((name(buf[i : j + GRAM]) for i, j in zip(cut, cut[1:])), np.uint64, max(0, len(cut) - 1))
                pos.append(at.astype(np.int32))
                names.append((h >> np.uint64(1) | np.uint64(1)).astype(np.int64))  # positive: 0 marks the end
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pos, pa.list_(pa.int32())), pa.array(names, pa.list_(pa.int64()))],
                names=["key", "pos", "name"],
            )
        tidy_worker(always=True)

    return run


PHRASES = "key binary, pos array<int>, name array<long>"


def _spread(x: Column) -> Column:
    """Names are positive: spread them over all 64 bits for the bit table."""
    return F.xxhash64(x)


def _runs(seen: BitTable | None, length: int):
    """Runs of repeated phrases that may hold a passage: their names, borders
    and the border before the run.  The last column holds the names spread for
    the filter ``seen``, or, without one, the places of the repeated names."""
    span = length - 4 * WINDOW - GRAM + 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy_worker()
        for batch in batches:
            key, out = batch.column(0).to_pylist(), [[], [], [], []]
            for r in range(batch.num_rows):
                name = batch.column(2)[r].values.to_numpy()
                if len(name) == 0:
                    continue
                pos = batch.column(1)[r].values.to_numpy()
                last = batch.column(3)[r].values.to_numpy()
                if seen is not None:
                    hit = seen(last)
                else:
                    hit = np.zeros(len(name), bool)
                    hit[last] = True
                edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
                starts, ends = edge[::2], edge[1::2]
                long = pos[ends] - pos[starts] >= span
                for i, j in zip(starts[long].tolist(), ends[long].tolist()):
                    for col, v in zip(out, (key[r], name[i:j], pos[i : j + 1], pos[i - 1] if i else -1)):
                        col.append(v)
            kinds = (pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=["key", "name", "pos", "before"])

    return run


# --- difference cover -------------------------------------------------------
def _ranks(rows: DataFrame, keys: list[str], counts: dict[str, Column], names: dict[str, str]) -> DataFrame:
    """Per distinct key, for each count the number of rows with smaller keys:
    one sort of the distinct keys, running sums within its partitions, and the
    partitions' totals (as many as there are partitions) as offsets."""
    groups = rows.groupBy(*keys).agg(*[F.sum(c).cast("long").alias(n) for n, c in counts.items()])
    s = groups.sort(*keys).withColumn("_p", F.spark_partition_id()).checkpoint()
    totals = sorted(s.groupBy("_p").agg(*[F.sum(n).alias(n) for n in counts]).collect(), key=lambda r: r["_p"])
    at, offsets = {n: 0 for n in counts}, {}
    for r in totals:
        offsets[r["_p"]] = tuple(at.values())
        at = {n: at[n] + r[n] for n in at}
    width, out = len(keys), [*keys, *(names[n] for n in counts)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: list[int] | None = None
        tidy_worker()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if before is None:
                before = list(offsets[batch.column(batch.num_columns - 1)[0].as_py()])
            cols = [batch.column(i) for i in range(width)]
            for k in range(len(before)):
                n = batch.column(width + k).to_numpy()
                total = np.cumsum(n)
                cols.append(pa.array(before[k] + total - n))
                before[k] += int(total[-1])
            yield pa.RecordBatch.from_arrays(cols, names=out)

    return s.mapInArrow(run, ", ".join(f"{c} long" for c in out))


TRIPLE = ["c", "c1", "c2"]


def _symbol(names: str, place: Column) -> Column:
    return F.coalesce(F.get(F.col(names), place), F.lit(0).cast("long"))


def _spelled(strings: DataFrame, more: dict[str, Column]) -> DataFrame:
    """A row per symbol: its place ``k`` beside the string's own columns, and
    ``more`` columns over these."""
    rows = strings.withColumn("k", F.explode(F.sequence(F.lit(0), F.size("name") - 1)))
    k = F.col("k")
    return rows.select("sid", "b", k.cast("long").alias("i"), _symbol("name", k).alias("c"), _symbol("name", k + 1).alias("c1"),
                       *[c.alias(n) for n, c in more.items()])


def suffix_ranks(strings: DataFrame, levels: int = 1, more: dict[str, Column] | None = None) -> DataFrame:
    """``(sid, b, i, rank)`` for strings ``(sid, b, name)``: ``name`` holds the
    symbols, all positive, at least one.  The rank is one plus the number of
    smaller suffixes.  ``more``: further columns of the result, over a
    string's columns and the symbol's place ``k``; rows in which all of them
    are null may be left out.

    Suffixes are told apart over ``3 ** (levels + 1)`` symbols and more; equal
    ones share a rank, and so may some that differ only further on.
    ``strings`` is read several times and should be cheap to read again.
    """
    more = more or {}
    one = {"n": F.lit(1)}
    out = ["sid", "b", "i", *more]
    triples = _spelled(strings, {"c2": _symbol("name", F.col("k") + 2)} | (more if levels == 0 else {}))
    if levels == 0:
        order = _ranks(triples, TRIPLE, one, {"n": "rank"})
        return triples.join(order, TRIPLE).select(*out, (F.col("rank") + 1).alias("rank"))
    sample = triples.where("i % 3 <> 0")
    named = sample.join(_ranks(sample, TRIPLE, one, {"n": "name"}), TRIPLE)
    # Each residue's triples are a string of names of its own.
    upper = (
        named.select("sid", F.expr("3 * b + i % 3").alias("b"), F.struct(F.col("i"), (F.col("name") + 1).alias("c")).alias("x"))
        .groupBy("sid", "b").agg(F.array_sort(F.collect_list("x")).alias("x"))
        .select("sid", "b", F.col("x.c").alias("name")).checkpoint()
    )
    del sample, named
    _tidy(upper)
    # The sampled places' ranks, in order: those of i are at 2 * (i / 3) + i % 3 - 1.
    ranks = (
        suffix_ranks(upper, levels - 1)
        .select("sid", F.expr("b div 3").alias("b"), F.struct(F.expr("3 * i + b % 3").alias("i"), F.col("rank").alias("r")).alias("x"))
        .groupBy("sid", "b").agg(F.array_sort(F.collect_list("x")).alias("x")).select("sid", "b", F.col("x.r").alias("ranks"))
    )
    k = F.col("k")
    at = lambda p: _symbol("ranks", F.floor(p / 3).cast("int") * 2 + p % 3 - 1)
    sampled = lambda p: F.when(p % 3 != 0, at(p))
    u = _spelled(
        strings.join(ranks, ["sid", "b"], "left"), {"r": sampled(k), "r1": sampled(k + 1), "r2": sampled(k + 2)} | more
    ).checkpoint()
    del ranks, upper
    _tidy(u)
    m = F.col("i") % 3
    zero, first, second = u.where(m == 0), u.where(m == 1), u.where(m == 2)
    # Merge by counting.  A suffix at residue 0 meets residue 1 by its symbol
    # and the next rank, residue 2 by two symbols and the rank after.
    k1, k2 = ["c", "r1"], ["c", "c1", "r2"]
    g1 = _ranks(u.where(m != 2), k1, {"n0": (m == 0).cast("int"), "n1": (m == 1).cast("int")}, {"n0": "z", "n1": "o"})
    g2 = _ranks(u.where(m != 1), k2, {"n0": (m == 0).cast("int"), "n2": (m == 2).cast("int")}, {"n0": "z2", "n2": "s"})
    if more:  # the ranks of rows that nobody asks about need no join
        asked = F.lit(False)
        for n in more:
            asked = asked | F.col(n).isNotNull()
        zero, first, second = (x.where(asked) for x in (zero, first, second))
    return (
        zero.join(g1, k1).join(g2, k2).select(*out, (F.col("z") + F.col("o") + F.col("s") + 1).alias("rank"))
        .unionByName(first.join(g1, k1).select(*out, (F.col("r") + F.col("z")).alias("rank")))
        .unionByName(second.join(g2, k2).select(*out, (F.col("r") + F.col("z2")).alias("rank")))
    )


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in suffix order whose neighbour begins with the same phrases.  The
    rows at a partition's ends have unseen neighbours and stay."""
    held = None  # the last row, not yet compared with the next
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sid, i, three = (batch.column(k).to_numpy() for k in (0, 1, 3))
        first = held is None
        if not first:
            sid, i, three = (np.r_[h, x] for h, x in zip(held[:3], (sid, i, three)))
        same = three[1:] == three[:-1]
        keep = np.r_[True if first else held[3], same] | np.r_[same, True]
        ahead = bool(same[-1]) if len(same) else bool(keep[0])
        held = (sid[-1:], i[-1:], three[-1:], ahead or (first and len(sid) == 1))
        keep[-1] = False
        yield pa.RecordBatch.from_arrays([pa.array(sid[keep]), pa.array(i[keep])], names=["sid", "i"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], names=["sid", "i"])


def _tidy(df: DataFrame) -> DataFrame:
    """Let Spark's cleaner take the shuffle and checkpoint files that nothing
    refers to any more (it only learns of them when the driver collects
    garbage; what the last job still holds goes in a second round)."""
    for k in range(2):
        if k:
            time.sleep(0.3)
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()
    return df


def candidates(runs: DataFrame, length: int, levels: int) -> DataFrame:
    """``(key, cands)``: the borders whose neighbour in suffix order begins
    with the same phrases, as ``(before, pos)``."""
    # Three phrases lie within reach of every owner; other places need no rank.
    k = F.col("k")
    close = F.get(F.col("pos"), k + 3) - F.get(F.col("pos"), k) <= reach(length)
    three = F.when(close, F.xxhash64(*[_symbol("name", k + j) for j in range(3)]))
    ranked = suffix_ranks(runs.select("sid", F.lit(0).cast("long").alias("b"), "name", "pos"), levels, {"three": three})
    near = (
        ranked.where("three is not null").select("sid", "i", "rank", "three").sort("rank", "sid")
        .mapInArrow(_near, "sid long, i long")
    )
    at = (
        near.groupBy("sid").agg(F.collect_list("i").alias("at")).join(runs.select("sid", "key", "pos", "before"), "sid")
        .select("key", F.transform("at", lambda i: F.struct(
            F.when(i > 0, F.get("pos", (i - 1).cast("int"))).otherwise(F.col("before")).alias("before"),
            F.get("pos", i.cast("int")).alias("pos"),
        )).alias("cands"))
    )
    out = at.groupBy("key").agg(F.flatten(F.collect_list("cands")).alias("cands")).checkpoint()
    del ranked, near, at
    return _tidy(out)


# --- passages ---------------------------------------------------------------
def _strings(length: int, several: BitTable | None = None):
    """Per candidate: the strings it owns, ``lo .. hi``, the hash of all bytes
    that they cover together, and of the bytes that each of them covers.  With
    ``several`` only those whose first hash it may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide, narrow = xxhash.xxh3_128_digest, xxhash.xxh3_64_intdigest
        for batch in batches:
            uid, bufs, cands = batch.column(0).to_numpy(), batch.column(1), batch.column(2)
            flat, first = cands.flatten(), np.r_[0, np.cumsum(cands.value_lengths().to_numpy())]
            before, at = (flat.field(c).to_numpy() for c in ("before", "pos"))
            size = np.repeat(pc.binary_length(bufs).to_numpy(), np.diff(first))
            lo = np.where(before >= 0, np.maximum(before - WINDOW + 2, 0), 0)
            hi = np.minimum(size - length, at - WINDOW + 1)
            some = hi >= lo
            core, whole = [], []
            for r in range(batch.num_rows):
                pick = slice(first[r], first[r + 1])
                keep = some[pick]
                if not keep.any():
                    continue
                buf = bufs[r].as_py()
                for p, a, b in zip(at[pick][keep].tolist(), lo[pick][keep].tolist(), hi[pick][keep].tolist()):
                    core.append(narrow(buf[p - WINDOW + 1 : p + length - 2 * WINDOW + 2]) >> 1)
                    whole.append(wide(buf[a : b + length], b - a))
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(uid, np.diff(first))[some], pa.int64()), pa.array(lo[some].astype(np.int32)),
                    pa.array(hi[some].astype(np.int32)), pa.array(core, pa.int64()), pa.array(whole, pa.binary()),
                ],
                names=["uid", "lo", "hi", "core", "whole"],
            )
            if several is not None and whole:
                out = out.filter(pa.array(several(np.frombuffer(b"".join(whole), ">i8")[::2].astype(np.int64))))
            yield out
        tidy_worker(always=True)

    return run


OWNED = "uid long, lo int, hi int, core long, whole binary"


def _each(length: int):
    """Every single string of the given ranges, with its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid, bufs, spans = batch.column(0).to_pylist(), batch.column(1), batch.column(2)
            for r in range(batch.num_rows):
                buf = bufs[r].as_py()
                at, alone = [], []
                for c in spans[r].as_py():
                    at += range(c["lo"], c["hi"] + 1)
                    alone += [c["alone"]] * (c["hi"] - c["lo"] + 1)
                for i in range(0, len(at), 20_000):
                    part = at[i : i + 20_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([uid[r]] * len(part), pa.int64()), pa.array(part, pa.int32()),
                            pa.array(alone[i : i + 20_000], pa.bool_()),
                            pa.array([xxhash.xxh3_128_digest(buf[s : s + length]) for s in part], pa.binary()),
                        ],
                        names=["uid", "s", "alone", "h"],
                    )

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text once its ranges are taken out: the digest of
    its bytes, and the text (a character cut in half is dropped)."""
    for batch in batches:
        bufs, runs = batch.column(1), batch.column(2)
        out: list[list] = [[] for _ in range(4)]
        for r in range(batch.num_rows):
            buf, spans, merged = bufs[r].as_py(), runs[r].as_py(), []
            for x in sorted((x["s"], x["e"]) for x in spans):
                if merged and x[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], x[1])
                else:
                    merged.append(list(x))
            kept, at = [], 0
            for s, e in merged:
                kept.append(buf[at:s])
                at = e
            kept.append(buf[at:])
            text = b"".join(kept)
            sha = hashlib.sha256(text).hexdigest()
            for col, v in zip(out, (len(buf) - len(text), len(merged), sha, text.decode("utf-8", "ignore"))):
                col.append(v)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.string(), pa.string())))],
            names=["key", "n_removed", "n_spans", "kept_sha256", "kept"],
        )
    tidy_worker(always=True)


def _key(sha: Column) -> Column:
    return F.substring(F.unhex(sha), 1, 16)


def _slot(key: Column) -> Column:
    return F.xxhash64(key)


def repeated_passages(texts: DataFrame, length: int, levels: int = 1) -> tuple[DataFrame, DataFrame]:
    """``(key, n_removed, n_spans, kept_sha256, kept)`` for the texts that
    hold a passage which occurs elsewhere, and the keys of the texts that
    occur more than once, which lose everything (one copy of each takes part
    as a partner).  ``texts`` has rows ``(key, bytes)``, copies included, none
    shorter than ``length``.

    Filters of eight bits per counted text, phrase name or string, of 16 MB
    (``TEXT_BITS``, ``NAME_BITS``) at most, spare rows without a partner the
    shuffles; beyond that size all rows take part in the exact joins."""
    copied = texts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key").checkpoint()
    many = counted_filter(copied.select(_slot(F.col("key")).alias("h")), "h", most=TEXT_BITS)
    texts = texts.select("key", "bytes")
    slot = _slot(F.col("key"))
    if many is None:
        phrases = texts.dropDuplicates(["key"]).mapInArrow(_parse(), PHRASES).checkpoint()
    else:  # only texts that may have copies are shuffled to find one of each
        copies = texts.where(many.column(slot)).dropDuplicates(["key"])
        phrases = (
            texts.select("key", "bytes", slot.alias("slot")).mapInArrow(_parse(many), PHRASES)
            .unionByName(copies.mapInArrow(_parse(), PHRASES)).checkpoint()
        )
    names = phrases.select(F.explode("name").alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("c").checkpoint()
    seen = counted_filter(names.select(_spread(F.col("c")).alias("h")), "h", most=NAME_BITS)
    if seen is not None:
        told = phrases.select("key", "pos", "name", F.transform("name", _spread).alias("told"))
    else:
        places = (
            phrases.select("key", F.posexplode("name").alias("i", "c")).join(names, "c", "left_semi")
            .groupBy("key").agg(F.collect_list("i").alias("told"))
        )
        told = phrases.join(places, "key").select("key", "pos", "name", "told")
    runs = told.mapInArrow(_runs(seen, length), "key binary, name array<long>, pos array<int>, before int")
    runs = runs.withColumn("sid", F.monotonically_increasing_id())
    runs = runs.checkpoint()
    del phrases, names, told
    cands = candidates(_tidy(runs), length, levels)
    del runs
    wanted = counted_filter(cands.select(_slot(F.col("key")).alias("h")), "h", most=TEXT_BITS)
    some = texts if wanted is None else texts.where(wanted.column(_slot(F.col("key"))))
    held = _tidy(
        some.select("key", "bytes").dropDuplicates(["key"])
        .join(cands, "key").select("key", "bytes", "cands", F.monotonically_increasing_id().alias("uid"))
        .checkpoint()
    )
    owned = held.select("uid", "bytes", "cands").mapInArrow(_strings(length), OWNED)
    # Ranges that occur whole elsewhere are settled; of the others every
    # string is compared with those of the ranges with the same core, one of
    # each kind.  (Equal strings have owners of their own, so none repeats
    # within a range.)
    kinds = owned.groupBy("whole").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("uid", "lo", "hi", "core")).alias("x"))
    kinds = kinds.select("whole", "n", "x.uid", "x.lo", "x.hi", "x.core").checkpoint()
    _tidy(kinds)
    mixed = kinds.groupBy("core").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).where("k > 1 and least = 1").select("core")
    spans = (
        kinds.join(mixed, "core", "left_semi")
        .groupBy("uid").agg(F.collect_list(F.struct("lo", "hi", (F.col("n") == 1).alias("alone"))).alias("spans"))
    )
    each = held.select("uid", "bytes").join(spans, "uid").select("uid", "bytes", "spans").mapInArrow(
        _each(length), "uid long, s int, alone boolean, h binary"
    ).checkpoint()
    del mixed, spans
    _tidy(each)
    twice = each.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    single = each.where("alone").join(twice, "h", "left_semi").select("uid", "s", (F.col("s") + length).alias("e"))
    several = kinds.where("n > 1").select("whole")
    # The first eight bytes of a 128-bit hash are a hash of their own.
    first = F.conv(F.hex(F.substring("whole", 1, 8)), 16, -10).cast("long")
    maybe = counted_filter(several.select(first.alias("h")), "h", most=NAME_BITS)
    rows = owned if maybe is None else held.select("uid", "bytes", "cands").mapInArrow(_strings(length, maybe), OWNED)
    whole = rows.join(several, "whole", "left_semi").select("uid", F.col("lo").alias("s"), (F.col("hi") + length).alias("e"))
    found = whole.unionByName(single).groupBy("uid").agg(F.collect_list(F.struct("s", "e")).alias("runs"))
    found = found.checkpoint()
    del kinds, each, twice, single, several, whole, owned
    _tidy(found)
    cut = held.select("uid", "key", "bytes").join(found, "uid").select("key", "bytes", "runs").mapInArrow(
        _cut, "key binary, n_removed long, n_spans long, kept_sha256 string, kept string"
    )
    return cut, copied


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)``, one row per
    input row: each text without the bytes of ``length``-byte strings that
    also start anywhere else, in the same text or another.

    Null counts as empty; texts shorter than ``length`` lose nothing; a text
    that occurs twice loses everything (of ``length`` bytes and more).
    Results depend on the text alone, so null, repeated or clashing ids do no
    harm; other columns are ignored; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    _check(length)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(utf8(text_col), F.lit(b"")).alias("bytes"))
    base = rows.select("doc_id", F.octet_length("bytes").cast("long").alias("n_bytes"), F.sha2("bytes", 256).alias("sha")).checkpoint()
    cut, copied = repeated_passages(_long(rows, length), length)
    changed = cut.drop("kept").join(copied, "key", "left_anti").withColumn("_all", F.lit(False))
    none = F.lit(None)
    fate = changed.unionByName(copied.select(
        "key", none.cast("long").alias("n_removed"), none.cast("long").alias("n_spans"), none.cast("string").alias("kept_sha256"),
        F.lit(True).alias("_all"),
    ))
    # One join, the last step: adaptive execution may split a text of many copies.
    joined = base.withColumn("key", _key(F.col("sha"))).join(fate, "key", "left")
    gone = F.coalesce(F.col("_all"), F.lit(False))  # such texts have ``length`` bytes and more
    empty = hashlib.sha256(b"").hexdigest()
    return joined.select(
        "doc_id", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(gone, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", F.lit(0).cast("long"))).alias("n_spans"),
        F.when(gone, F.lit(empty)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )


def strip_repeats(docs: DataFrame, text_col: str = "text", length: int = 400) -> DataFrame:
    """The input rows with the remainder as their text (a character cut in
    half is dropped, the others stay); rows whose whole text goes are left
    out."""
    prepare(docs.sparkSession)
    _check(length)
    cols = docs.columns
    rows = docs.select(F.coalesce(utf8(text_col), F.lit(b"")).alias("bytes"))
    cut, copied = repeated_passages(_long(rows, length), length)

    kept = (
        cut.select("key", F.col("kept").alias("_kept")).join(copied, "key", "left_anti")
        .unionByName(copied.select("key", F.lit("").alias("_kept")))
    )
    marked = docs.withColumn("_key", _key(F.sha2(F.coalesce(utf8(text_col), F.lit(b"")), 256)))
    names = [F.col(f"`{c}`") for c in cols]
    # Only texts that may have changed are shuffled to meet their remainder.
    keys = _tidy(cut.select("key").unionByName(copied).distinct().checkpoint())
    few = counted_filter(keys.select(_slot(F.col("key")).alias("h")), "h", most=TEXT_BITS)
    if few is not None:
        marked = marked.withColumn("_maybe", few.column(_slot(F.col("_key"))))
    met = marked if few is None else marked.where("_maybe")
    met = met.join(kept.withColumnRenamed("key", "_key"), "_key", "left")
    text = F.when(F.col("_kept").isNull(), F.col(text_col)).otherwise(F.col("_kept"))
    met = met.where("_kept is null or length(_kept) > 0").select(
        *[text.alias(c) if c == text_col else n for c, n in zip(cols, names)]
    )
    return met if few is None else marked.where("not _maybe").select(*names).unionByName(met)


def _long(rows: DataFrame, length: int) -> DataFrame:
    return rows.where(F.octet_length("bytes") >= length).select(_key(F.sha2("bytes", 256)).alias("key"), "bytes")


def _check(length: int) -> None:
    least = 6 * WINDOW + GRAM - 3  # three phrases within reach
    if length < least:
        raise ValueError(f"length must be at least {least}")
