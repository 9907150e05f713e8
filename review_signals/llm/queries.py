"""The operators as named queries over the given tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_signals.llm import (
    gam,
    hyperdim,
    jaccard_join,
    line_windows,
    merge_encoding,
    preference_format,
    risk_thresholds,
    spaced_seeds,
    spelling_variants,
    suffix_dedup,
    token_scan,
    vector_packing,
    whitening,
)
from review_signals.llm.oracle import ORACLE
from review_signals.llm.tokens import vocabulary

__all__ = ["ORACLE", "REGISTRY"]

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(run: Query) -> Query:
    REGISTRY[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op6_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_packing.pack(table(spark, sf_dir, "documents"), vocabulary())


@query
def op1_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks are shown as text, ``start:end`` of each range."""
    chosen, rejected = preference_format.branch_pairs(table(spark, sf_dir, "conversations"))
    shown = [
        F.expr(f"array_join(transform({side}_mask, m -> concat(m.start, ':', m.end)), ',')").alias(f"{side}_mask")
        for side in ("chosen", "rejected")
    ]
    return preference_format.format_pairs(chosen, rejected).select("pair_id", "n_prompt_turns", "prompt", "chosen", "rejected", *shown)


@query
def op2_risk_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk_thresholds.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_seeds.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``start`` and ``file_id`` depend on how Spark cut the input, so the digest leaves them out."""
    counted = token_scan.count_documents(table(spark, sf_dir, "documents"), vocabulary())
    return counted.select("doc_id", "n_tokens")


@query
def op7_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_windows.deduplicate(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_removed", "n_spans", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op4_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return gam.score(docs, gam.learn(docs, table(spark, sf_dir, "labels")))


@query
def op9_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return hyperdim.predict(docs, hyperdim.learn(docs))


@query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(table(spark, sf_dir, "documents")).drop("text_key")


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_backtracking_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merge_encoding.digest(merge_encoding.encode_decode(docs, vocabulary("piece_bpe_32k.model")))


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(table(spark, sf_dir, "documents"))


@query
def op13_lanczos_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return whitening.digest(rows, whitening.learn(rows))
