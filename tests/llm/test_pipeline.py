import random

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as cp
from planar.llm.queries import byte_bpe_path
from tests.llm.helpers import docs_df, words_of
from tests.llm.test_simhash import brute_components, brute_fp
from tests.llm.test_suffix import brute as brute_suffix
from tests.llm.test_winnow import brute as brute_hits

SF = "/root/testdata/sf0.001"


def by_hand(rows, items, languages):
    """The stages by brute force; ``languages``: ids that the first keeps."""
    rows = [r for r in rows if r[0] in languages]
    fps = [brute_fp(t) for _, t in rows]
    comp = brute_components(fps)
    first = {}
    for (i, _), c in zip(rows, comp):
        first[c] = min(first.get(c, i), i)
    rows = [r for r in rows if r[0] in set(first.values())]
    _, kept = brute_suffix([t for _, t in rows])
    rows = [(i, k.decode("utf-8", "ignore")) for (i, _), k in zip(rows, kept) if k]
    bad = {r[0] for r in brute_hits(rows, items) if r[5]}
    return {i: t for i, t in rows if i not in bad}


def docs_of(pieces):
    out = {}
    for r in sorted(pieces, key=lambda r: (r["doc_id"], r["start"])):
        out.setdefault(r["doc_id"], []).extend(np.frombuffer(bytes(r["ids"]), "<u4").tolist())
    return out


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    passed = {r["doc_id"] for r in cp.language_id(spark, docs, SF).collect()}
    # Clean texts pass; those without a letter go.
    assert {i for i, t in rows if not any(c.isalpha() for c in t or "")}.isdisjoint(passed)
    assert len(passed) > 0.95 * len(rows)
    want = by_hand(rows, items, passed)
    tok = Tokenizer.from_file(byte_bpe_path())
    got = docs_of(cp.run(spark, SF).collect())
    assert got == {i: tok.encode(t, add_special_tokens=False).ids + [0] for i, t in want.items()}
    assert 0 < len(got) < len(rows)


def test_stages_keep_columns_and_survive_odd_rows(spark, tmp_path):
    rng = random.Random(1)
    texts = [None, "", "123", "x", "\n", *["the old house by the river and the sea " * 3] * 3, words_of(rng, 900), "ü" * 500]
    ids = [None, 1, 2, None, 3, 4, 4, 5, 6, 7]
    docs = docs_df(spark, texts, ids, ["en"] * 5 + ["en", None, "en", "de", "en"])
    for c in ("fp", "_text", "key", "rank", "sha", "bytes", "score"):
        docs = docs.withColumn(c, docs["source"])
    docs.limit(0).select("doc_id", "text").withColumnRenamed("doc_id", "item_id").write.parquet(f"{tmp_path}/benchmark.parquet")
    for frame in (docs, docs.limit(0)):
        now = frame
        for name, stage in cp.STAGES[:-1]:
            now = stage(spark, now, str(tmp_path)).checkpoint()
            assert now.columns == docs.columns, name
        cp.packing(spark, now, str(tmp_path)).count()


def test_nothing_to_learn_a_language_from(spark):
    docs = docs_df(spark, ["abc", None, "12", "дом"])
    assert sorted(r["doc_id"] for r in cp.language_id(spark, docs, SF).collect()) == [0, 3]


def test_clean_documents_stay(spark, tmp_path):
    rng = random.Random(2)
    texts = [words_of(rng, 200, 4000) for _ in range(40)]
    docs = docs_df(spark, texts, lang=["en"] * 40)
    docs.limit(0).select("doc_id", "text").withColumnRenamed("doc_id", "item_id").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).checkpoint()
    assert sorted(r["text"] for r in docs.collect()) == sorted(texts)
