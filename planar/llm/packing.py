"""Harmonic packing of token sequences.

Lengths fall into reciprocal-capacity classes: class ``k`` takes pieces of
``capacity / k`` tokens, ``k`` of them to a bin.  Documents may be cut, so a
document is cut into whole bins (class 1) and the binary parts of the rest:
each piece has exactly its class's size and every full bin is full to the
last token.  Each worker fills its own bins, one open bin per class; what is
open at its end is closed in runs of a power of two, which need no padding.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planar.llm.common import keeps, prepare, tidy_worker, utf8

MEMO_ENTRIES = 120_000
FORGET = 20  # parts encoded beside a full memory, as a multiple of it, before it starts anew
SPECIAL = "<|"
UNSAFE = re.compile(r" (?:\s|$)")
SAFE_CUT = re.compile(r" (?=\S)")


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for:
    printable Latin-1 letters stand for themselves, the other bytes, in
    order, for the letters from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class WordEncoder:
    """Byte-level BPE ids of a text, as little-endian 32-bit bytes.

    The tokenizer's pattern never joins a space to what stands before it, so
    a text may be cut before any space that a non-space follows; the ids of
    the parts are remembered (the first ``MEMO_ENTRIES`` parts).  New parts are
    encoded with the tokenizer's own vocabulary and merges (ids of a
    byte-level vocabulary are in merge order) by the faster of the two
    installed encoders; texts that may hold a special token's string go
    through the tokenizer whole."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.path, self.whole = path, None
        tok, letters = Tokenizer.from_file(path), _byte_letters()
        special = {t.content for t in tok.get_added_tokens_decoder().values()}
        ranks = {bytes(letters[c] for c in t): i for t, i in tok.get_vocab().items() if t not in special}
        del tok
        self.encode = tiktoken.Encoding(
            "parts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.memo: dict[str, bytes] = {}
        self.missed = 0

    def __call__(self, text: str) -> bytes:
        if SPECIAL in text:
            if self.whole is None:  # few texts need it
                from tokenizers import Tokenizer

                self.whole = Tokenizer.from_file(self.path)
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(self._parts(p) for p in _slices(text))

    def _parts(self, text: str) -> bytes:
        if UNSAFE.search(text):
            # A run of white space stays whole, with what precedes it.
            words = SAFE_CUT.split(text)
        else:
            words = text.split(" ")
        memo, encode = self.memo, self.encode
        rest = words[1:]  # each stands for itself after a space
        new = {w: array("I", encode(" " + w)).tobytes() for w in set(rest).difference(memo)}
        if len(memo) + len(new) <= MEMO_ENTRIES:
            memo.update(new)
            ids = map(memo.__getitem__, rest)
        else:
            # Full: what came first is what comes often, until it is not.
            ids = [new[w] if w in new else memo[w] for w in rest] if new else map(memo.__getitem__, rest)
            self.missed += len(new)
        out = array("I", encode(words[0])).tobytes() + b"".join(ids)
        if self.missed > FORGET * MEMO_ENTRIES:
            memo.clear()
            self.missed = 0
        return out


def _slices(text: str, size: int = 1 << 19) -> Iterator[str]:
    """A long text in slices, each cut before a space that a non-space follows."""
    pos, n = 0, len(text)
    while pos < n:
        end = min(n, pos + size)
        while end < n:
            end = text.find(" ", end)
            if end < 0:
                end = n
            elif end + 1 < n and not text[end + 1].isspace():
                break
            else:
                end += 1
        yield text[pos:end]
        pos = end


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    keeps("packing", _ENCODERS.clear)
    return _ENCODERS[path]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` tokens: whole bins, then the
    binary parts of the rest, largest first."""
    out = [(i, capacity) for i in range(0, n - n % capacity, capacity)]
    at, rest = n - n % capacity, n % capacity
    while rest:
        size = 1 << (rest.bit_length() - 1)
        out.append((at, size))
        at, rest = at + size, rest - size
    return out


class HarmonicPacker:
    """Bins of one worker.  ``add`` yields the rows of every bin that fills;
    ``close`` those of the open ones.  A bin's rows carry its number and
    their place in it."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next, self.open = capacity, first, {}

    def _bin(self, rows, size):
        for i, row in enumerate(rows):
            yield (*row, self.next, i * size)
        self.next += 1

    def add(self, row: tuple, size: int):
        rows = self.open.setdefault(size, [])
        rows.append(row)
        if len(rows) * size == self.capacity:
            del self.open[size]
            yield from self._bin(rows, size)

    def close(self):
        for size, rows in sorted(self.open.items(), reverse=True):
            while rows:
                k = 1 << (len(rows).bit_length() - 1)
                yield from self._bin(rows[:k], size)
                rows = rows[k:]
        self.open = {}


def pack_sequences(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 0
) -> DataFrame:
    """``(doc_id, start, length, ids, doc_tokens, sequence_id, offset)``, one
    row per piece; ``ids`` are the piece's ids as little-endian 32-bit bytes.

    A document is its ids followed by ``end_id`` (null text: empty, so the
    end id alone).  Every id lies in one piece; a sequence's pieces are
    gapless from offset 0 and sum to ``capacity`` or another power of two, so
    nothing is padded.  ``capacity`` must be a power of two.  Repeated rows
    are packed each; other columns are ignored, whatever their names; an
    empty table gives no rows.

    One pass without a shuffle: each task packs its own documents, and open
    bins hold less than ``capacity`` tokens per class.  ``sequence_id`` is the
    task's partition number followed by its count of bins, so a rerun task
    repeats its rows as long as its input partition rereads alike (as files do).
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy_worker("packing", always=True)
        encode = _encoder(tokenizer_path)
        packer = HarmonicPacker(capacity, TaskContext.get().partitionId() << 36)
        tail = int(end_id).to_bytes(4, "little")
        id_type = None

        def batch_of(rows):
            c = list(zip(*rows))
            long = pa.int64()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(c[0], id_type), pa.array(c[1], long), pa.array(c[2], long), pa.array(c[3], pa.binary()),
                    pa.array(c[4], long), pa.array(c[5], long), pa.array(c[6], long),
                ],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        rows: list[tuple] = []
        for batch in batches:
            id_type = batch.schema.field(0).type
            bufs = batch.column(1)
            for r, doc_id in enumerate(batch.column(0).to_pylist()):
                buf = bufs[r].as_py()
                ids = (encode(buf.decode("utf-8", "replace")) if buf else b"") + tail
                n = len(ids) // 4
                for start, size in cuts(n, capacity):
                    rows.extend(packer.add((doc_id, start, size, ids[4 * start : 4 * (start + size)], n), size))
                if len(rows) >= 1024:
                    yield batch_of(rows)
                    rows = []
        rows.extend(packer.close())
        if rows:
            yield batch_of(rows)
        tidy_worker("packing", always=True)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), utf8(text_col).alias("bytes")).mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
