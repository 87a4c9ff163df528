"""The queries of this subpackage, with production parameters, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lectern.llm import bpe, edit_counts, jaccard, line_dedup, mixing, neighbours, packing, periodic, secrets, token_files, topk, toxicity, variants
from lectern.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), words=3, threshold=(9, 10))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.line_dedup(docs).drop("source")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return edit_counts.count_edits(docs, edit_counts.revision, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), size=1024, end_id=0)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mixing.mix(docs).select("doc_id", "topic", "n_tokens", "probability", "sampled")


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return topk.search(docs, docs.filter("doc_id % 50 = 0"), k=10)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.collapse(table(spark, sf_dir, "documents"), revise=periodic.recurring))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"), variants.lost_letter)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_secret_scan, op2_neighbours, op3_jaccard_join, op4_toxicity, op5_line_dedup, op6_token_counts, op7_packing, op8_token_files, op9_mixing, op10_topk_search, op11_periodic_runs, op12_bpe, op13_spelling_variants)}


def oracle_sql() -> dict[str, str]:
    return {"op5_line_dedup": line_dedup.oracle(), "op9_mixing": mixing.oracle()}
