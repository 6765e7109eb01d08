"""The registered queries of the subpackage, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, intervals, jaccard, language, pii, quality, shards, simhash, spelling, substrings, toxicity, warc
from .common import table
from .sql import ORACLE_SQL

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_bpe(spark: SparkSession, sf_dir: str, *, vocabulary_path: str | None = None) -> DataFrame:
    import public_tokenizers

    return bpe.encode_and_decode(table(spark, sf_dir, "documents"), vocabulary_path or public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"))


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(table(spark, sf_dir, "documents"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(substrings.deduplicate(table(spark, sf_dir, "documents")))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op13_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.relate(table(spark, sf_dir, "sales"), table(spark, sf_dir, "sale_lines"), table(spark, sf_dir, "clicks"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_bpe, op3_simhash, op4_quality, op5_toxicity, op6_warc, op7_shards, op8_substrings, op9_pii, op10_language, op11_spelling, op12_jaccard, op13_intervals, pipeline)}

__all__ = ["ORACLE_SQL", "QUERIES"]
