"""Token counts of a unigram segmentation, shared over a trie.

A pre-token (a word led by the word mark) is cut into vocabulary pieces so
that the sum of piece log probabilities is greatest.  The best score up to a
position depends only on the prefix before it, so pre-tokens go into a trie
whose nodes hold that score: a prefix that many words share is worked out
once, and every word's count is stored at its end.

Piece probabilities follow from the vocabulary's order by Zipf's law,
``p(rank) ~ 1 / (rank + 2.7)``; characters outside the vocabulary fall back
to their UTF-8 bytes, each as improbable as the last rank.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planar.llm.common import prepare, utf8, word_chunks

MARK = "▁"
UNIT = 1 << 32  # a score is micro-nats times UNIT, less one per token
MAX_NODES, MAX_WORDS, MAX_SHARED = 400_000, 500_000, 64


def piece_scores(model_path: str) -> tuple[dict[str, int], int]:
    """Score of each piece of a sentencepiece vocabulary, and of a fallback
    byte.  Scores carry the token count in their low part: adding them adds
    both, and of equal sums the one with fewer tokens is greater."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    n = sp.get_piece_size()
    norm = math.log(sum(1 / (r + 2.7) for r in range(n)))

    def score(rank: int) -> int:
        return round(-(math.log(rank + 2.7) + norm) * 1e6) * UNIT - 1

    pieces = {
        sp.id_to_piece(i): score(i) for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))
    }
    return pieces, score(n - 1)


def tokens_in(score: int) -> int:
    return -score % UNIT


class UnigramTrie:
    def __init__(self, pieces: dict[str, int], byte_score: int):
        self.byte = byte_score
        # Every piece's score; every proper end of a piece that is none
        # itself is there without one, so that a string missing here ends no
        # piece, nor does any longer one.
        self.ends: dict[str, int | None] = {p[i:]: None for p in pieces for i in range(1, len(p))}
        self.ends.update(pieces)
        self.counts: dict[bytes, int] = {}
        self._clear()

    def _clear(self) -> None:
        # The trie, a node under each prefix: its forward score.
        self.score: dict[str, int] = {"": 0}

    def _best(self, text: str, i: int, before) -> int:
        """Best score of ``text[:i]``; ``before[j]`` is that of ``text[:j]``."""
        get, c = self.ends.get, text[i - 1]
        s = get(c)
        best = before(i - 1) + (self.byte * len(c.encode("utf-8", "replace")) if s is None else s)
        for j in range(i - 2, -1, -1):
            s = get(text[j:i], 0)
            if s is None:
                continue
            if s == 0:  # scores are negative
                break
            s += before(j)
            if s > best:
                best = s
        return best

    def _insert(self, text: str) -> int:
        if len(text) > MAX_SHARED:  # too long to share: the same recurrence on its own
            row = [0]
            for i in range(1, len(text) + 1):
                row.append(self._best(text, i, row.__getitem__))
            return tokens_in(row[-1])
        score = self.score
        n = i = len(text)
        while text[:i] not in score:
            i -= 1
        for i in range(i + 1, n + 1):
            score[text[:i]] = self._best(text, i, lambda j: score[text[:j]])
        return tokens_in(score[text])

    def learn(self, words: set[bytes]) -> None:
        if len(self.counts) + len(words) > MAX_WORDS:
            self.counts.clear()
        for w in words:
            if len(self.score) > MAX_NODES:
                self._clear()
            self.counts[w] = self._insert(MARK + w.decode("utf-8", "replace"))

    def count(self, buf: bytes) -> tuple[int, int]:
        """``(pre-tokens, tokens)`` of a text."""
        n = total = 0
        for words in word_chunks(buf):
            new = set(words).difference(self.counts)
            if new:
                self.learn(new)
                if new and not all(map(self.counts.__contains__, words)):
                    self.learn(set(words).difference(self.counts))  # the store was emptied
            n += len(words)
            total += sum(map(self.counts.__getitem__, words))
        return n, total


_TRIES: dict[str, UnigramTrie] = {}


def _trie(path: str) -> UnigramTrie:
    """One trie per worker process and vocabulary."""
    if path not in _TRIES:
        _TRIES[path] = UnigramTrie(*piece_scores(path))
    return _TRIES[path]


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_tokens)``, one row per input row.

    Words are split at ASCII white space.  Null, empty and blank texts have
    no words and no tokens.  Repeated rows give a row each; other columns are
    ignored; an empty table gives no rows.  One pass without a shuffle; a
    worker's trie and store of counts are emptied when they reach a fixed
    size, which costs time and changes no count.
    """
    prepare(docs.sparkSession)

    @F.pandas_udf("n_words long, n_tokens long")
    def counts(bufs: pd.Series) -> pd.DataFrame:
        trie = _trie(model_path)
        got = np.array([trie.count(b) if b else (0, 0) for b in bufs], np.int64).reshape(-1, 2)
        return pd.DataFrame({"n_words": got[:, 0], "n_tokens": got[:, 1]})

    return docs.select(F.col(id_col).alias("doc_id"), counts(utf8(text_col)).alias("c")).select("doc_id", "c.*")
