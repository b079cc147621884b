"""The operators bound to the driver's tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cirrus.llm.common import columns_of
from cirrus.llm.sql import ORACLE as ORACLE

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cirrus.llm.topk import top_k

    return top_k(columns_of(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0, k=20)


#: Bytes of text that a shard may hold.
SHARD_BYTES = 1 << 20


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cirrus.llm.sharding import shards

    return shards(columns_of(spark, sf_dir, "documents", "doc_id", "text"), limit=SHARD_BYTES)


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cirrus.llm.neardup import components

    return components(columns_of(spark, sf_dir, "documents", "doc_id", "text"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cirrus.llm.quality import assess

    return assess(columns_of(spark, sf_dir, "documents", "doc_id", "text"), columns_of(spark, sf_dir, "labels", "doc_id", "quality"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cirrus.llm.secretscan import digest, scan

    return digest(scan(columns_of(spark, sf_dir, "documents", "doc_id", "text")))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cirrus.llm.licenses import scan

    return scan(columns_of(spark, sf_dir, "documents", "doc_id", "text"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cirrus.llm.tokencount import token_counts

    return token_counts(columns_of(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path(), limit=512)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cirrus.llm.mixing import mix

    return mix(columns_of(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cirrus.llm.toxicity import score

    return score(columns_of(spark, sf_dir, "documents", "doc_id", "text"), columns_of(spark, sf_dir, "labels", "doc_id", "toxic"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cirrus.llm.packing import pack

    return pack(columns_of(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path(), capacity=2048, end_id=0)


def op11_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cirrus.llm.common import scratch
    from cirrus.llm.tokenids import read, write

    path = scratch(spark, "token-ids")
    return read(write(columns_of(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path(), end_id=2, path=path), path)


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cirrus.llm.centroids import clusters

    return clusters(columns_of(spark, sf_dir, "embeddings", "vec_id", "embedding"), k=40, rounds=5, dims=64, by=256, seed="2")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cirrus.llm.phrases import collocations

    return collocations(columns_of(spark, sf_dir, "documents", "text", "lang"), least=100, longest=5, percent=100, top=2000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_top_k": op1_top_k,
    "op2_sharding": op2_sharding,
    "op3_near_dedup": op3_near_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_secret_scan": op5_secret_scan,
    "op6_license_scan": op6_license_scan,
    "op7_token_counts": op7_token_counts,
    "op8_mixing": op8_mixing,
    "op9_toxicity": op9_toxicity,
    "op10_packing": op10_packing,
    "op11_token_ids": op11_token_ids,
    "op12_clusters": op12_clusters,
    "op13_phrases": op13_phrases,
}
