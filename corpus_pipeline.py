"""Training-corpus pipeline: documents in, packed token sequences out.

``STAGES`` lists the stages in order.  Each takes ``(spark, docs, sf_dir)``
and returns a DataFrame; all but the last return the columns of ``docs``.
``run`` applies them to the ``documents`` table, writing every stage's rows
as Parquet into the shared folder and reading them back, so a lost executor
costs no more than the stage at hand.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planar.llm.common import table
from planar.llm.language import UND, identify_languages, train_language_model
from planar.llm.packing import pack_sequences
from planar.llm.queries import byte_bpe_path
from planar.llm.simhash import keep_one_per_component
from planar.llm.suffix import strip_repeats
from planar.llm.winnow import decontaminate
from planar.plans.session import ensure_checkpoint_dir

def _only(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in like.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: texts without a letter (null and empty ones
    too) go; mixtures stay, whatever the share of their leading language.
    Where no row names a language there is nothing to learn and all letters
    pass."""
    model = train_language_model(docs)
    found = identify_languages(docs, model)
    if model.langs:
        keep = F.col("language_id.lang_pred") != UND
    else:
        keep = F.col("text").rlike(r"\p{L}")
    return _only(found.where(keep), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id."""
    return keep_one_per_component(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 400 bytes and more that occur elsewhere
    (``n_chars`` follows the text); documents left empty go."""
    stripped = strip_repeats(docs)
    if "n_chars" in docs.columns:
        stripped = stripped.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return _only(stripped, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    marked = decontaminate(docs, table(spark, sf_dir, "benchmark"), keep_columns=True)
    return _only(marked.where(~F.col("_contaminated")), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1,024 tokens, with their ids."""
    return pack_sequences(docs, byte_bpe_path())


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Viterbi, XXH64 fingerprints and BPE ids are beyond SQL: tests compare the
# pipeline with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
