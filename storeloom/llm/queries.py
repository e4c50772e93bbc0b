"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom.llm import (
    bpe,
    collocate,
    exact,
    hardnegs,
    jaccard,
    licenses,
    mixing,
    pii,
    quality,
    tokenfile,
    topk,
    toxicity,
    warc,
)
from storeloom.llm.common import shared_folder, table
from storeloom.llm.oracle import ORACLE


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken",
        F.array_sort(F.array_distinct("draws.shard")).alias("shards"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokenfile.write_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN, shared_folder(spark, "tokens"))
    return tokenfile.read_tokens(spark, files, with_ids=False)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(licenses.paths_of(table(spark, sf_dir, "documents")))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"bigint(size(filter(base, x -> x.kind = {k})))").alias(f"n_{kind}")
              for k, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.span_text("base"), 256).alias("base_sha256"),
                        pii.span_text("spans").alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.fit_severity(docs, table(spark, sf_dir, "labels")))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.apply_quality(docs, model, keep_columns=["doc_id"])


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    warc.register(spark)
    folder = shared_folder(spark, "warc")
    warc.with_revisits(table(spark, sf_dir, "pages")).write.format("warc").mode("append").save(folder)
    # Digests and lengths are in the headers; the reader skips what else a payload has.
    return spark.read.format("warc").option("payload", "false").load(folder).select(
        warc.page_of("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
        "payload_digest", "record_type", warc.page_of("refers_to").alias("refers_to"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", noisy)
    return hardnegs.mine(vectors, vectors.where("vec_id % 50 = 0"), 5, 3, 50, 95)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocate.collocations(table(spark, sf_dir, "documents"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.mark(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_mix_sources, op2_token_files, op3_licenses, op4_personal_data, op5_toxicity,
        op6_byte_bpe, op7_jaccard_join, op8_quality_rules, op9_exact_top_k, op10_warc,
        op11_hard_negatives, op12_collocations, op13_exact_dedup)}

__all__ = ["ORACLE", "QUERIES"]
