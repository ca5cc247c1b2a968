"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from planar.plans.session import ensure_checkpoint_dir, ship_package


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
TEXT_BATCH, UNSET = "2m", "1b"


def prepare(spark: SparkSession) -> None:
    """Make the package importable in workers and the checkpoint folder known,
    and hold Arrow batches to ``TEXT_BATCH`` where the session names no size:
    ten thousand long texts at once (the usual limit) would fill a worker."""
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    if spark.conf.get(BATCH_BYTES, UNSET) == UNSET:
        spark.conf.set(BATCH_BYTES, TEXT_BATCH)


# What operators keep in a worker process between tasks, as functions that
# drop it; workers are used again by other operators.
_CACHES: dict[str, Callable[[], None]] = {}
_FULL: set[str] = set()


def keeps(owner: str, drop: Callable[[], None]) -> None:
    """Say that ``owner`` keeps something in this worker, and how to drop it."""
    _CACHES[owner] = drop
    _FULL.add(owner)


def tidy_worker(owner: str | None = None, always: bool = False) -> None:
    """Drop what operators other than ``owner`` left in this Python worker and
    give the memory back.  Does nothing where nothing was left, unless
    ``always``: Arrow then gives back the memory of past batches."""
    others = [k for k in _FULL if k != owner]
    for k in others:
        _CACHES[k]()
        _FULL.discard(k)
    if others or always:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def utf8(col: str) -> Column:
    """The UTF-8 bytes of a text column; null stays null."""
    return F.col(col).cast("binary")


def saved(df: DataFrame) -> DataFrame:
    """A small result, checkpointed in a few files per core: a partition each
    would leave many tiny files in the shared folder, and Hadoop's local file
    system starts a process for each to set its rights."""
    return df.coalesce(4 * max(1, df.sparkSession.sparkContext.defaultParallelism)).checkpoint()


def text_key(col: str) -> Column:
    """A 16-byte key of a whole text (null counts as empty): the first half of
    its SHA-256.  Results that depend on the text alone are keyed by it, so
    repeated, null or clashing ids do no harm."""
    return F.substring(F.unhex(F.sha2(F.coalesce(utf8(col), F.lit(b"")), 256)), 1, 16)


def fold(col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as '')."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % modulus


def word_chunks(buf: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words (split at ASCII white space) of a text in order, in lists
    that cover about ``size`` bytes each, so that a huge text is never turned
    into one huge list."""
    if len(buf) <= size:
        yield buf.split()
        return
    pos, n = 0, len(buf)
    while pos < n:
        end = pos + size
        if end < n:
            while end < n and buf[end] not in b" \t\n\x0b\x0c\r":
                end += 1
        yield buf[pos:end].split()
        pos = end


def pack_docs(bufs: list[bytes | None], limit: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Ranges ``[i, j)`` of documents whose bytes sum to about ``limit``
    (a longer document has a range of its own)."""
    i, total = 0, 0
    for j, b in enumerate(bufs):
        n = len(b) if b else 0
        if j > i and total + n > limit:
            yield i, j
            i, total = j, 0
        total += n
    if i < len(bufs):
        yield i, len(bufs)


FILTER_BITS = 27  # most bits of a counted filter: 16 MB


def counted_filter(hashes: DataFrame, col: str, count: int | None = None, most: int = FILTER_BITS) -> BitTable | None:
    """A ``BitTable`` with 32 bits per hash, or at least eight where 32 take
    more than ``2 ** most`` bits, from their counted number; None where eight
    do too (the caller then joins all rows)."""
    n = hashes.count() if count is None else count
    if max(12, (8 * n).bit_length()) > most:
        return None
    return BitTable(hashes, col, min(most, max(12, (32 * n).bit_length())))


class BitTable:
    """A set of 64-bit hashes as a bit table of 2^bits bits, whatever the
    number of hashes.  Tests may pass hashes that are not in the set, never
    refuse one that is, so it only thins out what a join checks."""

    def __init__(self, hashes: DataFrame, col: str, bits: int):
        self.bits = bits
        words = (
            hashes.groupBy(F.expr(f"cast(shiftrightunsigned({col}, {64 - bits + 6}) as int)").alias("w"))
            .agg(F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned({col}, {64 - bits}) & 63 as int)))").alias("b"))
            .toArrow()  # at most 2^(bits - 6) rows
        )
        table_ = np.zeros(1 << (bits - 6), np.int64)
        table_[words["w"].to_numpy()] = words["b"].to_numpy()
        self.held = hashes.sparkSession.sparkContext.broadcast(table_.view(np.uint64))

    def __call__(self, h: np.ndarray) -> np.ndarray:
        p = h.view(np.uint64) >> np.uint64(64 - self.bits)
        return (self.held.value[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)

    def column(self, col: Column) -> Column:
        """The test as a column.  It is declared nondeterministic so that Spark
        runs it where it stands and nowhere else: from a join on the hashed
        column it would infer the same test for the other side, which puts a
        second Python worker into tasks that have one."""
        test = self.__call__

        @F.pandas_udf("boolean")
        def passes(h: pd.Series) -> pd.Series:
            return pd.Series(test(np.ascontiguousarray(h.to_numpy(np.int64))))

        return passes.asNondeterministic()(col)

    def __getstate__(self):
        return {"bits": self.bits, "held": self.held}
