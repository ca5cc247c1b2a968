import numpy as np
import pytest
from pyspark.sql import functions as F

from planar.llm import language as lg
from planar.llm.queries import op3_language
from tests.llm.helpers import clashing, docs_df

SF = "/root/testdata/sf0.01"


def brute_viterbi(scores, pen):
    n, L = scores.shape
    best = scores[0].astype(float)
    back = []
    for t in range(1, n):
        step = best[:, None] - pen * (1 - np.eye(L))
        back.append(step.argmax(axis=0))
        best = step.max(axis=0) + scores[t]
    return best.max()


def path_score(scores, labels, pen):
    return sum(scores[i, l] for i, l in enumerate(labels)) - pen * int((labels[1:] != labels[:-1]).sum())


@pytest.mark.parametrize("L", [1, 2, 5])
def test_viterbi_finds_the_best_path(L):
    rng = np.random.default_rng(L)
    sizes = [1, 2, 127, 128, 129, 700, 1, 256]
    scores = rng.normal(size=(sum(sizes), L)) * 3
    starts = np.cumsum(sizes) - sizes
    labels = lg.viterbi(scores, starts, 2.5)
    for s, n in zip(starts, sizes):
        assert path_score(scores[s : s + n], labels[s : s + n], 2.5) == pytest.approx(brute_viterbi(scores[s : s + n], 2.5))


TEXTS = [
    None, "", "  \n", "123 456 -- !!", "the house is under the old tree and the river " * 5,
    "das haus ist unter dem alten baum und der fluss " * 5, "дом стоит под старым деревом у реки " * 5,
    "the house is under the old tree and the river " * 6 + "das haus ist unter dem alten baum und der fluss " * 3,
    "the " * 30000,
]
LANGS = [None, "en", "en", "en", "en", "de", "ru", None, None]


def test_small_corpus(spark):
    df = clashing(docs_df(spark, TEXTS, lang=LANGS))
    model = lg.train_language_model(df, penalty=4.0)
    assert model.langs == ["de", "en", "ru"]
    got = {r["doc_id"]: r["language_id"] for r in lg.identify_languages(df, model).collect()}
    assert [got[i]["lang_pred"] for i in range(len(TEXTS))] == ["und"] * 4 + ["en", "de", "ru", "en", "en"]
    assert [got[i]["score"] for i in range(4)] == [0.0] * 4 and got[6]["score"] == 1.0
    assert 0.5 < got[7]["score"] < 0.8
    spans = lg.language_spans(df.where("doc_id = 7"), model).orderBy("start").collect()
    assert [r["lang"] for r in spans] == ["en", "de"]
    assert sum(r["words"] for r in spans) == len(TEXTS[7].split())


def test_empty_and_untrained(spark):
    assert lg.predict_languages(docs_df(spark, [])).count() == 0
    out = lg.predict_languages(docs_df(spark, ["abc def", None], lang=[None, None])).collect()
    assert {(r["lang_pred"], r["score"]) for r in out} == {("und", 0.0)}


def test_held_out_accuracy(spark):
    out = op3_language(spark, SF)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    rows = out.join(docs, "doc_id").where(F.col("held_out") & F.col("text").rlike("[a-zA-Z]{2}")).select("lang", "lang_pred").collect()
    assert len(rows) > 150
    assert sum(r[0] == r[1] for r in rows) / len(rows) > 0.97
    assert out.count() == docs.count()
