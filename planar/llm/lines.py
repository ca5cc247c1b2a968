"""Line de-duplication by a range-partitioned stream of line hashes.

Every line long enough to count leaves one row: a 128-bit hash of its key,
the document and its position.  The rows are range-partitioned by hash and
document and sorted by hash, document (largest first) and position, so each
task streams whole stretches of equal hashes and sees the document that keeps
the line before all others.  A hash that very many documents hold spans
several partitions; what its partitions saw of it (two rows per partition at
most) is added up, and the rows concerned are settled by that.  The result is
a compressed keep bitmap per document; no text is moved.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from planar.llm.common import counted_filter, prepare, saved, tidy_worker, utf8

SPACE = " \t\n\x0b\x0c\r"
NO_ID = -(1 << 63)  # stands for a null id: smaller than any other


def _identity(id_col: str, text_col: str) -> list[Column]:
    """A row's document and a hash of its text: equal rows share their fate."""
    return [
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(F.coalesce(utf8(text_col), F.lit(b""))).alias("text_hash"),
    ]


def _n_lines(text_col: str) -> Column:
    """Lines of a text: one more than its line feeds (null and empty: one)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1


HASHES = "h1 long, h2 long, doc long, text_hash long, pos int"


def _hash_lines(min_chars: int):
    """The lines of ``(doc, text_hash, bytes)`` whose key has ``min_chars``
    code points, by the two halves of the key's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, space = xxhash.xxh3_128_digest, SPACE.encode()
        for batch in batches:
            row, pos, keys = [], [], []
            for r, buf in enumerate(batch.column(2)):
                for i, line in enumerate(buf.as_py().split(b"\n")):
                    if len(line) < min_chars:  # no more code points than bytes
                        continue
                    key = line.strip(space)
                    if (len(key) if key.isascii() else len(key.decode("utf-8", "replace"))) >= min_chars:
                        row.append(r)
                        pos.append(i)
                        keys.append(digest(key.lower()))  # bytes: A-Z alone
            h = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            at = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[:, 0]), pa.array(h[:, 1]), batch.column(0).take(at), batch.column(1).take(at), pa.array(pos, pa.int32())],
                names=["h1", "h2", "doc", "text_hash", "pos"],
            )
        tidy_worker(always=True)

    return run


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``(h1, h2, doc, text_hash, pos)`` of the lines whose key has at least
    ``min_chars`` code points, copies of a row once."""
    rows = docs.select(*_identity(id_col, text_col), F.coalesce(utf8(text_col), F.lit(b"")).alias("bytes"))
    rows = rows.where(F.octet_length("bytes") >= min_chars)
    return rows.mapInArrow(_hash_lines(min_chars), HASHES).distinct()


# Kinds of rows that a task of the stream returns.
DROP, OPEN, SEEN = 0, 1, 2
STREAM = "kind int, h1 long, h2 long, doc long, text_hash long, pos int, n long"


def _stream(min_docs: int):
    """Stream rows sorted by hash, document (descending) and position.

    A stretch of equal hashes that begins and ends within the partition is
    decided at once (``DROP`` rows).  One that touches the partition's start
    may have larger documents before it, so its rows leave undecided
    (``OPEN``); so do the withheld rows of one that touches its end with fewer
    than ``min_docs`` documents.  Both leave a ``SEEN`` row: documents seen
    and the largest."""

    def out(kind, h1, h2, doc, text, pos, n=0):
        k = len(doc)
        full = lambda v, t: pa.array(np.full(k, v), t)
        return pa.RecordBatch.from_arrays(
            [full(kind, pa.int32()), full(h1, pa.int64()), full(h2, pa.int64()), pa.array(doc), pa.array(text),
             pa.array(pos, pa.int32()), full(n, pa.int64())],
            names=["kind", "h1", "h2", "doc", "text_hash", "pos", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_start = True  # no stretch of the partition is finished yet
        key = None  # the stretch that is still open
        n = largest = last = 0
        held: list = []  # its rows of documents 2 .. min_docs - 1

        def release(kind):
            for doc, text, pos in held:
                yield out(kind, *key, doc, text, pos)
            held.clear()

        def seen():
            yield out(SEEN, *key, np.array([largest]), np.array([0]), np.array([0]), n)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            h1, h2, doc, text, pos = (batch.column(i).to_numpy() for i in range(5))
            new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
            begin = np.flatnonzero(new)
            end = np.r_[begin[1:], len(h1)]
            lead = key is not None and (int(h1[0]), int(h2[0])) == key
            if key is not None and not lead:
                if at_start:
                    yield from seen()
                    at_start = False
                held.clear()
                key = None
            # Stretches inside the batch: decided together.
            lo, hi = (1 if lead or at_start else 0), len(begin) - 1
            if hi > lo:
                a, b = begin[lo], end[hi - 1]
                g = np.cumsum(new[a:b]) - 1
                step = new[a:b] | np.r_[True, doc[a + 1 : b] != doc[a : b - 1]]
                order = np.cumsum(step)
                first = order[begin[lo:hi] - a]
                docs_of = np.r_[first[1:], order[-1] + 1] - first
                drop = (docs_of[g] >= min_docs) & (order > first[g])
                if drop.any():
                    at = np.flatnonzero(drop) + a
                    yield out(DROP, 0, 0, doc[at], text[at], pos[at])
            # The first stretch, where it goes on or opens the partition, and the last.
            for k in sorted({0, hi} if lo else {hi}):
                s, e = begin[k], end[k]
                if not (k == 0 and lead):
                    if key is not None:
                        if at_start:
                            yield from seen()
                            at_start = False
                        held.clear()
                    key, n, largest, last = (int(h1[s]), int(h2[s])), 0, int(doc[s]), None
                d = doc[s:e]
                step = np.r_[last is None or d[0] != last, d[1:] != d[:-1]]
                order = n + np.cumsum(step)  # 1 for the largest document
                n, last = int(order[-1]), d[-1]
                if at_start:
                    yield out(OPEN, *key, d, text[s:e], pos[s:e])
                elif n >= min_docs:
                    yield from release(DROP)
                    at = np.flatnonzero(order > 1) + s
                    if len(at):
                        yield out(DROP, 0, 0, doc[at], text[at], pos[at])
                else:
                    at = np.flatnonzero(order > 1) + s
                    if len(at):
                        held.append((doc[at], text[at], pos[at]))
        if key is not None:
            yield from release(OPEN)
            yield from seen()

    return run


def dropped_lines(hashes: DataFrame, min_docs: int) -> DataFrame:
    """``(doc, text_hash, pos)`` of the lines to drop, from ``line_hashes``."""
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc()]
    found = saved(
        hashes.repartitionByRange(*order).sortWithinPartitions(*order, "text_hash", "pos").mapInArrow(_stream(min_docs), STREAM)
    )
    # At most two rows per partition.
    edges = found.where(F.col("kind") == SEEN).groupBy("h1", "h2").agg(F.sum("n").alias("docs"), F.max("doc").alias("largest"))
    settled = (
        found.where(F.col("kind") == OPEN).join(F.broadcast(edges), ["h1", "h2"])
        .where((F.col("docs") >= min_docs) & (F.col("doc") != F.col("largest")))
    )
    out = ["doc", "text_hash", "pos"]
    return found.where(F.col("kind") == DROP).select(*out).unionByName(settled.select(*out))


@F.pandas_udf(T.BinaryType())
def pack_bitmap(n_lines: pd.Series, drop: pd.Series) -> pd.Series:
    """Keep bits of ``n_lines`` lines (first line: highest bit), compressed."""
    out = []
    for n, d in zip(n_lines, drop):
        bits = np.ones(n, np.uint8)
        if d is not None:
            bits[d] = 0
        out.append(zlib.compress(np.packbits(bits).tobytes(), 1))
    return pd.Series(out)


def unpack_bitmap(packed: bytes, n_lines: int) -> np.ndarray:
    """The bits of ``pack_bitmap`` as booleans."""
    return np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), count=n_lines).astype(bool)


def line_keep_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5,
    keep_all: bool = True,
) -> DataFrame:
    """``(doc, text_hash, n_lines, n_dropped, keep)``: one row for each
    distinct document and text, with its compressed keep bitmap; with
    ``keep_all`` off only for those that lose a line.

    A line's key is the line without ASCII white space at its ends, A-Z
    lower-cased.  Keys of at least ``min_chars`` code points that ``min_docs``
    documents hold lose all lines outside the largest document that holds
    them.  Null and empty texts are one empty line, which stays.  Rows of one
    id are one document; rows without an id are one too, smaller than all
    others.  Ids are whole numbers; other columns are ignored, whatever their
    names; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    gone = dropped_lines(line_hashes(docs, id_col, text_col, min_chars), min_docs)
    gone = gone.groupBy("doc", "text_hash").agg(F.sort_array(F.collect_list("pos")).alias("_drop"))
    rows = docs.select(*_identity(id_col, text_col), _n_lines(text_col).alias("n_lines")).distinct()
    rows = rows.join(gone, ["doc", "text_hash"], "left" if keep_all else "inner")
    return rows.select(
        "doc", "text_hash", F.col("n_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_dropped"),
        pack_bitmap("n_lines", "_drop").alias("keep"),
    )


@F.pandas_udf(T.StringType())
def keep_lines(text: pd.Series, n_lines: pd.Series, keep: pd.Series) -> pd.Series:
    """The lines whose bits are set, joined by line feeds."""
    out = []
    for t, n, k in zip(text, n_lines, keep):
        lines = (t or "").split("\n")
        out.append("\n".join([lines[i] for i in np.flatnonzero(unpack_bitmap(k, n)).tolist()]))
    return pd.Series(out)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc, text_hash, n_dropped, text)`` for the documents of ``bitmaps``
    that lose lines: their remaining text, once per distinct document and
    text.  Other documents' texts are not shuffled, as long as a filter of the
    documents concerned stays within 16 MB."""
    some = saved(bitmaps.where("n_dropped > 0").select("doc", "text_hash", "n_lines", "n_dropped", "keep"))
    texts = docs.select(*_identity(id_col, text_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spread = F.xxhash64("doc", "text_hash")
    few = counted_filter(some.select(spread.alias("h")), "h")
    if few is not None:
        texts = texts.where(few.column(spread))
    return (
        texts.dropDuplicates(["doc", "text_hash"]).join(some, ["doc", "text_hash"])
        .select("doc", "text_hash", "n_dropped", keep_lines("text", "n_lines", "keep").alias("text"))
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_sha256)``, one row per input row
    (see ``line_keep_bitmaps``), from the bitmaps applied to the texts."""
    bitmaps = line_keep_bitmaps(docs, id_col, text_col, min_chars, min_docs, keep_all=False)
    cut = apply_bitmaps(docs, bitmaps, id_col, text_col).select(
        "doc", "text_hash", "n_dropped", F.sha2("text", 256).alias("sha")
    )
    rows = docs.select(
        F.col(id_col).alias("doc_id"), *_identity(id_col, text_col), _n_lines(text_col).cast("long").alias("n_lines"),
        F.sha2(F.coalesce(utf8(text_col), F.lit(b"")), 256).alias("whole"),
    )
    return rows.join(cut, ["doc", "text_hash"], "left").select(
        "doc_id", "n_lines", F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        F.coalesce("sha", "whole").alias("kept_sha256"),
    )


LINE_DEDUP_SQL = r"""
with d as (select row_number() over () rid, doc_id, coalesce(text, '') t from documents),
l as (select rid, doc_id, unnest(range(len(x))) pos, unnest(x) line from (select rid, doc_id, string_split(t, chr(10)) x from d)),
k as (select rid, doc_id, pos, line,
        translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') key from l),
c as (select key, max(doc_id) last from k where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
m as (select k.rid, k.pos, k.line, c.key is not null and k.doc_id <> c.last gone from k left join c on k.key = c.key)
select any_value(d.doc_id) doc_id, count(*)::bigint n_lines, count(*) filter (gone)::bigint n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) kept_sha256
from m join d using (rid) group by rid
"""
