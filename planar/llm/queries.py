"""Registered queries of this folder and their DuckDB SQL.

Every query reads its whole table; parameters are the production ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planar.llm.common import table
from planar.llm.filters import FILTER_AUDIT_SQL, filter_audit
from planar.llm.language import predict_languages
from planar.llm.lines import LINE_DEDUP_SQL, dedup_lines
from planar.llm.packing import pack_sequences
from planar.llm.quality import predict_quality
from planar.llm.runs import RUNS_SQL, run_digests
from planar.llm.sharding import shard, shard_sql
from planar.llm.simhash import simhash_near_dups
from planar.llm.suffix import remove_repeats
from planar.llm.tokens import token_counts
from planar.llm.topk import TOP_K_SQL, exact_top_k
from planar.llm.toxicity import predict_toxicity
from planar.llm.winnow import DECONTAMINATE_SQL, decontaminate


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_dups(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.withColumn("has_repeats", F.col("n_removed") > 0)


SHARD_BYTES = 1 << 20


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), str(public_tokenizers.path("piece_bpe_32k.model")))


def byte_bpe_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_sequences(table(spark, sf_dir, "documents"), byte_bpe_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), max_bytes=SHARD_BYTES)


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": op1_simhash,
        "op2_quality": op2_quality,
        "op3_language": op3_language,
        "op4_token_counts": op4_token_counts,
        "op5_packing": op5_packing,
        "op6_decontamination": op6_decontamination,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_sharding": op8_sharding,
        "op9_topk": op9_topk,
        "op10_toxicity": op10_toxicity,
        "op11_line_dedup": op11_line_dedup,
        "op12_filter_audit": op12_filter_audit,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_decontamination": DECONTAMINATE_SQL,
        "op8_sharding": shard_sql(SHARD_BYTES),
        "op9_topk": TOP_K_SQL,
        "op11_line_dedup": LINE_DEDUP_SQL,
        "op12_filter_audit": FILTER_AUDIT_SQL,
        "op13_periodic_runs": RUNS_SQL,
    }
