"""Exact top-k search by tiles.

Vectors become integers, candidates and queries are packed into tiles (a
binary matrix per row), every query tile meets every candidate tile in a
keyed join, each pair is one matrix product of which every query keeps its k
best, and the lists are merged in two rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from planar.llm.common import prepare

EXACT = 1 << 53  # integers a double holds exactly


def _tiles(rows: int):
    """Pack rows ``(vec_id, copies, vec)`` of a partition, each lot of one
    length, into tiles sorted by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lots: dict[int, list[tuple]] = {}

        def tile(dim):
            lot = sorted(lots.pop(dim))
            ids = np.array([x[0] for x in lot], "<i8")
            mat = np.frombuffer(b"".join(x[2] for x in lot), "<i8")
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([dim], pa.int32()), pa.array([int(ids[0])], pa.int64()), pa.array([ids.tobytes()], pa.binary()),
                    pa.array([np.array([x[1] for x in lot], "<i8").tobytes()], pa.binary()), pa.array([_shrink(mat)], pa.binary()),
                ],
                names=["dim", "tile", "ids", "copies", "mat"],
            )

        for batch in batches:
            for i, c, v in zip(*(batch.column(k).to_pylist() for k in range(3))):
                vec = np.array(v, "<i8").tobytes()
                lots.setdefault(len(v), []).append((i, c, vec))
                if len(lots[len(v)]) >= rows:
                    yield tile(len(v))
        for dim in list(lots):
            yield tile(dim)

    return run


def _top(mat: np.ndarray) -> int:
    return max(int(mat.max(initial=0)), -int(mat.min(initial=0)))


def _shrink(mat: np.ndarray) -> bytes:
    """The narrowest integers that hold a matrix, after a byte naming them."""
    top = _top(mat)
    width = 2 if top < 1 << 15 else 4 if top < 1 << 31 else 8
    return bytes([width]) + mat.astype(f"<i{width}").tobytes()


def _grow(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, f"<i{blob[0]}", offset=1).reshape(n, -1).astype(np.int64)


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    top = _top(q) * _top(c) * max(1, q.shape[1])
    if top < EXACT:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    if top < 1 << 63:
        return q @ c.T
    big = q.astype(object) @ c.astype(object).T  # beyond 64 bits the score saturates
    return np.clip(big, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def best_of_tile(qid, qvec, cid, copies, cvec, k: int):
    """Per query the k best of a tile as ``(query row, candidate row, score)``;
    candidates are sorted by id, a row with copies counts as many times, and
    one copy of the query's own row is left out."""
    scores = _products(qvec, cvec)
    out_q, out_c, out_s = [], [], []
    n = len(cid)
    for lo in range(0, len(qid), 256):
        s = scores[lo : lo + 256]
        # The k + 1 best distinct rows suffice: one of them may be the own one.
        take = min(n, k + 1)
        if n > take:
            edge = np.partition(s, n - take, axis=1)[:, n - take]
        else:
            edge = s.min(axis=1)
        rows, cols = np.nonzero(s >= edge[:, None])  # by query, then by id
        vals = s[rows, cols]
        # Own row: same id and same vector.
        own = (cid[cols] == qid[lo + rows]) & (cvec[cols] == qvec[lo + rows]).all(axis=1)
        count = np.minimum(copies[cols] - own, k)
        rows, cols, vals = (np.repeat(x, count) for x in (rows, cols, vals))
        order = np.lexsort((cols, -vals, rows))
        rows, cols, vals = rows[order], cols[order], vals[order]
        first = np.searchsorted(rows, np.arange(len(s)))
        keep = np.arange(len(rows)) - first[rows] < k
        out_q.append(lo + rows[keep])
        out_c.append(cols[keep])
        out_s.append(vals[keep])
    return np.concatenate(out_q), np.concatenate(out_c), np.concatenate(out_s)


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                qids, qcopies, qmat, tile, cids, ccopies, cmat = (batch.column(i)[r].as_py() for i in range(7))
                qid, cid = np.frombuffer(qids, "<i8"), np.frombuffer(cids, "<i8")
                qn, copies = np.frombuffer(qcopies, "<i8"), np.frombuffer(ccopies, "<i8")
                q, c, s = best_of_tile(qid, _grow(qmat, len(qid)), cid, copies, _grow(cmat, len(cid)), k)
                # Tile and row name the query: one id may have several rows.
                name = int.from_bytes(hashlib.blake2b(qids + qmat, digest_size=8).digest(), "little", signed=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(qid[q]), pa.array(np.full(len(q), name)), pa.array(q.astype(np.int64)), pa.array(qn[q]),
                        pa.array(cid[c]), pa.array(s), pa.array(np.full(len(q), tile)),
                    ],
                    names=["query_id", "q_tile", "q", "q_copies", "vec_id", "score", "c_tile"],
                )

    return run


def groups_of(tiles: int) -> int:
    """Groups of candidate tiles: one per tile up to 64, then one for four, so
    that a group's work stays the same however many rows there are."""
    return max(1, min(tiles, 64), tiles // 4)


def exact_top_k(
    vectors: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 50,
    scale: float = 256.0,
    tile_rows: int = 4096,
    query_rows: int = 1024,
    spread: int | None = None,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose id is divisible
    by ``every``, the k rows of highest integer inner product among all other
    rows of its length, ties to the smaller id.

    Components become ``floor(scale * x)``.  Rows with a null id, a null or
    empty vector, or a null or non-finite component take no part.  Repeated
    rows count each: as candidates they take a place each, as queries they
    give a list each; only the query's own row is left out.  Scores beyond 64
    bits saturate (and tie).  Other columns are ignored; an empty table gives no rows.

    Candidate tiles are dealt to groups and query tiles sent to each group: a
    keyed join in which no side is broadcast or collected, and whose work is
    the queries times the rows.  The groups follow the number of tiles (see
    ``groups_of``) unless ``spread`` names it.
    """
    spark = vectors.sparkSession
    prepare(spark)
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = (
        vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite)
        .select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("vec"))
        .groupBy("vec_id", "vec").agg(F.count(F.lit(1)).alias("copies"))
        .select("vec_id", "copies", "vec")
    )
    schema = "dim int, tile long, ids binary, copies binary, mat binary"
    # Written out: a tile's rows depend on the order in which they arrive.
    cand = rows.mapInArrow(_tiles(tile_rows), schema).checkpoint()
    spread = spread or groups_of(cand.count())
    cand = cand.withColumn("p", F.pmod(F.xxhash64("ids", "mat"), F.lit(spread)))
    query = (
        rows.where(F.col("vec_id") % every == 0).mapInArrow(_tiles(query_rows), schema).checkpoint()
        .select("dim", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("p"), F.col("ids").alias("qids"), F.col("copies").alias("qcopies"), F.col("mat").alias("qmat"))
    )
    lists = (
        query.join(cand, ["dim", "p"])
        .select("qids", "qcopies", "qmat", "tile", "ids", "copies", "mat")
        .mapInArrow(_search(k), "query_id long, q_tile long, q long, q_copies long, vec_id long, score long, c_tile long")
    )
    order = [F.col("score").desc(), F.col("vec_id")]
    near = Window.partitionBy("q_tile", "q", F.pmod("c_tile", F.lit(16))).orderBy(*order)
    lists = lists.withColumn("r", F.row_number().over(near)).where(F.col("r") <= k)
    final = Window.partitionBy("q_tile", "q").orderBy(*order)
    lists = lists.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
    return lists.select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", F.explode(F.sequence(F.lit(1).cast("long"), "q_copies")).alias("_")
    ).drop("_")


TOP_K_SQL = """
with v as (select row_number() over () rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) w from embeddings
           where vec_id is not null and embedding is not null and len(embedding) > 0
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.rid, a.vec_id query_id, b.vec_id, list_sum(list_transform(list_zip(a.w, b.w), lambda z: z[1] * z[2]))::bigint score
      from v a join v b on a.rid <> b.rid and len(a.w) = len(b.w) where a.vec_id % 50 = 0),
r as (select *, row_number() over (partition by rid order by score desc, vec_id) k from s)
select query_id, k::int "rank", vec_id, score from r where k <= 5
"""
