import random

import public_tokenizers
import pytest

from planar.llm import tokens as tk
from planar.llm.queries import op4_token_counts
from tests.llm.helpers import clashing, docs_df, words_of

PATH = str(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def vocab():
    return tk.piece_scores(PATH)


def brute(text, vocab):
    """Every word on its own, forwards from each position."""
    pieces, byte = vocab
    words = [w for w in (text or "").encode().split()]
    total = 0
    for w in words:
        t = "▁" + w.decode()
        best = [None] * (len(t) + 1)
        best[0] = 0
        for i in range(len(t)):
            for j in range(i + 1, min(len(t), i + 20) + 1):
                s = pieces.get(t[i:j])
                if s is None and j == i + 1:
                    s = byte * len(t[i].encode())
                if s is not None and (best[j] is None or best[i] + s > best[j]):
                    best[j] = best[i] + s
        total += -best[-1] % (1 << 32)
    return len(words), total


TEXTS = [None, "", " \n", "the", "The houses unbelievable", "Ünï 漢字 🎉 ñ", "a" * 500, "x y z", "in in in " * 400, "0123 <0x0A> <s> </s>"]


def test_counts(vocab):
    rng = random.Random(1)
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice("abethinogr é") for _ in range(300)) for _ in range(20)]
    trie = tk.UnigramTrie(*vocab)
    for t in texts:
        assert trie.count(t.encode()) == brute(t, vocab)


def test_small_stores_change_nothing(vocab, monkeypatch):
    monkeypatch.setattr(tk, "MAX_NODES", 20)
    monkeypatch.setattr(tk, "MAX_WORDS", 3)
    monkeypatch.setattr(tk, "MAX_SHARED", 6)
    trie = tk.UnigramTrie(*vocab)
    for t in ["the there therefore the then a", words_of(random.Random(2), 50), "there the"]:
        assert trie.count(t.encode()) == brute(t, vocab)


def test_prefixes_are_shared(vocab):
    trie = tk.UnigramTrie(*vocab)
    trie.count(b"there therefore therein the")
    assert len(trie.score) == len("▁therefore") + 2 + 1


def test_rows(spark, vocab):
    got = tk.token_counts(clashing(docs_df(spark, TEXTS, [1, 1, None, *range(3, len(TEXTS))])), PATH)
    assert got.columns == ["doc_id", "n_words", "n_tokens"]
    assert sorted((r["n_words"], r["n_tokens"]) for r in got.collect()) == sorted(brute(t, vocab) for t in TEXTS)
    assert tk.token_counts(docs_df(spark, []), PATH).count() == 0


def test_query(spark, vocab):
    sf = "/root/testdata/sf0.001"
    want = {r["doc_id"]: brute(r["text"], vocab) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in op4_token_counts(spark, sf).collect()} == want
