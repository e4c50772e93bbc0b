"""Stages from raw documents to token ids; each but the last takes and returns documents.

An empty table passes through all stages as one, very long texts are read whole, and columns beyond
those of ``documents`` come along whatever their names are, up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom.llm import bpe, jaccard, mixing, pii, quality
from storeloom.llm.common import shared_folder, table
from storeloom.session import remove_stored, stored_frames

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now, where documents have that column."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


#: Frames that the stage before has stored.
_left: list[str] = []


def _stage(function: Stage) -> Stage:
    """A stage that first removes what the one before it has stored: its result is written by then, as
    the next one reads it. Frames of other work stay."""
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove_stored(spark, _left)
        before = set(stored_frames())
        out = function(spark, docs, sf_dir)
        _left[:] = [p for p in stored_frames() if p not in before]
        return out

    return run_stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, judged against their own corpus. A null or empty text
    fails the base rules; repeated rows are judged alike."""
    return quality.keep_good(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


@_stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts that share four fifths of their five-word runs: that of
    the least id, null ids last, and one of repeated rows. Texts without a word all stay."""
    return jaccard.keep_first(docs)


@_stage
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; null texts stay null."""
    return _with_length(pii.redact(docs))


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes, shard by shard: one row for each stretch of a document that one of its
    runs takes for a shard. Null and empty texts have no words to take; repeated rows count each."""
    return _with_length(mixing.mixed_documents(docs))


@_stage
def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each row's token ids and of the bytes that they decode to; a null text has no ids."""
    return bpe.encoding_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]

#: Scores, links and draws are no SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
