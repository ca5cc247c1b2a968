import random
import zlib

import numpy as np
import pytest

from planar.llm import packing as pk
from planar.llm.queries import byte_bpe_path, op5_packing
from tests.llm.helpers import clashing, docs_df, words_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_bpe_path())


ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n b", "\n\n", "x y z", "x  y", "a \x1c b", "it's we'll 'll 's",
    "Ünï cödé ñ 漢字 かな 🎉🎉", "tab\tsep \t x", "a <|endoftext|> b", "12 345 x9 !! ?? ...", "w " * 3000, "a" * 5000, " " * 700 + "b",
]


def test_word_encoder_equals_the_tokenizer(tok, monkeypatch):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("ab \n\t.,'1é ") for _ in range(rng.randrange(200))) for _ in range(300)]
    enc = pk.WordEncoder(byte_bpe_path())
    for size in (1 << 19, 7):
        monkeypatch.setattr(pk._slices, "__defaults__", (size,))
        for t in texts:
            assert np.frombuffer(enc(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)
    monkeypatch.setattr(pk, "MEMO_ENTRIES", 5)
    for t in texts[-50:] + ["one two three four five six seven eight"]:
        assert np.frombuffer(enc(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_cuts():
    for n in [1, 2, 1023, 1024, 1025, 5000, 2047]:
        c = pk.cuts(n, 1024)
        assert [s for s, _ in c] == list(np.cumsum([0] + [x for _, x in c])[:-1]) and sum(x for _, x in c) == n
        assert all(x & (x - 1) == 0 and x <= 1024 for _, x in c)


def check(rows, want_tokens, capacity=1024):
    """Every id once, gapless sequences, no padding."""
    docs, seqs = {}, {}
    for r in rows:
        docs.setdefault(r["doc_id"], []).append(r)
        seqs.setdefault(r["sequence_id"], []).append(r)
    assert set(docs) == set(want_tokens)
    for d, ps in docs.items():
        at = 0
        for p in sorted(ps, key=lambda r: r["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(want_tokens[d])
            ids = want_tokens[d][at : at + p["length"]]
            assert p["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
            at += p["length"]
        assert at == len(want_tokens[d])
    for ps in seqs.values():
        ps.sort(key=lambda r: r["offset"])
        total = 0
        for p in ps:
            assert p["offset"] == total
            total += p["length"]
        assert total <= capacity and total & (total - 1) == 0
    return len(seqs)


def test_query(spark, tok):
    rows = op5_packing(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {d["doc_id"]: tok.encode(d["text"] or "", add_special_tokens=False).ids + [0] for d in docs}
    n = check(rows, want)
    total = sum(map(len, want.values()))
    assert n <= total / 1024 + 11 * 11


def test_edge_rows(spark, tok, tmp_path):
    rng = random.Random(2)
    texts = [None, "", "x"] + ODD + [words_of(rng, 2500)]
    df = clashing(docs_df(spark, texts))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    want = {i: tok.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    check(op5_packing(spark, str(tmp_path)).collect(), want)
    docs_df(spark, ["a b", "a b"], [None, None], parts=1).write.parquet(f"{tmp_path}/n/documents.parquet")
    assert {r["doc_id"] for r in op5_packing(spark, f"{tmp_path}/n").collect()} == {None}
    docs_df(spark, []).write.parquet(f"{tmp_path}/e/documents.parquet")
    assert op5_packing(spark, f"{tmp_path}/e").count() == 0
