"""One query per operator: whole table in, contract columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.llm.line_dedup import line_report
from smelter.llm.merkle import manifest
from smelter.llm.mixing import repetitions
from smelter.llm.ngram_join import jaccard_components
from smelter.llm.packing import pack
from smelter.llm.quality_rules import quality
from smelter.llm.scoring import score
from smelter.llm.shared import table
from smelter.llm.sharding import shard_documents
from smelter.llm.token_counts import token_counts
from smelter.llm.topk import top_k
from smelter.llm.url_filters import judged
from smelter.llm.warc import archived_records
from smelter.llm.whitening import whitened
from smelter.session import new_folder


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), width=4, p=85, q=100)


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=24)


def web_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_records(spark, table(spark, sf_dir, "pages"), new_folder(spark, "archive"))


def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetitions(table(spark, sf_dir, "documents")).drop("copies")


def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


def count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", limit=512)


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), "word_bpe_49k.json", capacity=2048)


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"), most=32)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": ngram_jaccard_join,
    "op2_sharding": sharding,
    "op3_web_archive": web_archive,
    "op4_mixing": mixing,
    "op5_lm_scoring": lm_scoring,
    "op6_token_counts": count_tokens,
    "op7_url_filters": url_filters,
    "op8_top_k": top_k_search,
    "op9_quality_rules": quality_rules,
    "op10_packing": packing,
    "op11_line_dedup": line_dedup,
    "op12_merkle_manifest": merkle_manifest,
    "op13_embedding_whitening": embedding_whitening,
}
