"""Quality rules: base counts of every text, then a hashed n-gram log-likelihood ratio.

The n-grams are four consecutive bytes of the words joined by single spaces, hashed into a fixed
number of buckets. One multinomial over the buckets is estimated from all documents, one from
trusted documents. A document's score is the mean over its n-grams of
``log(p_trusted / p_corpus)``, and one threshold decides for every document alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.llm.common import BLANKS, slices, texts_of, unused, without
from storeloom.session import cut_lineage

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8
GRAM = 4
BUCKETS = 1 << 16
#: Labelled documents from which the trusted multinomial and the threshold are fitted, at most:
#: those whose ids have the smallest hashes.
LABELLED = 20_000

METRICS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
           "n_repeat_words long, base_failed boolean")
RESULTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
           "score", "kept"]
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class QualityModel:
    """Log ratio of each bucket, and the score from which on a document is kept."""

    log_ratio: np.ndarray
    threshold: float


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` (a power of two) words found twice or more."""
    n = len(words)
    if n <= window:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    if len(seen) == n:
        return 0
    width = 1
    while width < window:  # equal ids now stand for equal runs of ``width`` words
        pairs = ids[:-width] * np.int64(n) + ids[width:]
        _, ids, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        if counts.max(initial=0) < 2:
            return 0
        width *= 2
    found = np.flatnonzero(counts[ids] > 1)
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, found, 1)
    np.add.at(marks, found + window, -1)
    return int((np.cumsum(marks[:n]) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed of one text."""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    repeated = repeated_words(words)
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated,
            len(words) < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * len(words))


def gram_buckets(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashed n-grams of all texts one after another, and how many each text has."""
    joined = [b" ".join(t.encode().split()) for t in texts]
    counts = np.array([max(0, len(b) - GRAM + 1) for b in joined], np.int64)
    data = np.frombuffer(b"".join(b for b, n in zip(joined, counts, strict=True) if n), np.uint8)
    if not len(data):
        return np.zeros(0, np.int64), counts
    grams = np.zeros(len(data) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        grams |= data[k:len(data) - GRAM + 1 + k].astype(np.uint64) << np.uint64(8 * k)
    inside = np.ones(len(grams), bool)  # not across two texts
    for end in np.cumsum(counts[counts > 0] + GRAM - 1)[:-1]:
        inside[end - GRAM + 1:end] = False
    hashed = (grams[inside] * _MIX) >> np.uint64(40)
    return (hashed % np.uint64(buckets)).astype(np.int64), counts


def scores(texts: list[str], model: QualityModel) -> np.ndarray:
    """Mean log ratio of each text; 0 for a text without an n-gram."""
    grams, counts = gram_buckets(texts, len(model.log_ratio))
    out = np.zeros(len(texts))
    some = counts > 0
    if some.any():
        starts = np.cumsum(counts[some]) - counts[some]
        out[some] = np.add.reduceat(model.log_ratio[grams], starts) / counts[some]
    return out


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Occurrences of each bucket over all texts; a task sends one row per bucket at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches, text):
            total += np.bincount(gram_buckets(texts_of(batch, text), buckets)[0],
                                 minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(buckets)
    sums = docs.select(text).mapInArrow(count, "bucket long, n long")
    for row in sums.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # ``buckets`` at most
        out[row.bucket] = row.n
    return out


def fit_quality(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id",
                quality: str = "quality", labelled: int = LABELLED, buckets: int = BUCKETS,
                keep: float = 0.999, slack: float = 0.5, smooth: float = 1.0) -> QualityModel:
    """Corpus multinomial over all of ``docs``, trusted one over documents of quality 1.

    Trusted documents come from at most ``labelled`` labelled ids. The threshold is the score that
    a share ``keep`` of those which pass the base rules reaches, lowered by ``slack`` times its
    distance to their median. An id labelled twice counts with its lowest quality. Without a
    trusted document the model keeps every document.
    """
    chosen = (labels.where(F.col(quality).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("_id")).agg(F.min(quality).alias("_quality"))
              .orderBy(F.xxhash64("_id"), "_id").limit(labelled).where("_quality = 1"))
    trusted = cut_lineage(docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
                          .join(F.broadcast(chosen), "_id").select("_text"))
    target = bucket_counts(trusted, "_text", buckets)
    if not target.sum():
        return QualityModel(np.zeros(buckets), float("-inf"))
    corpus = bucket_counts(docs, text, buckets)
    ratio = (np.log((target + smooth) / (target.sum() + smooth * buckets))
             - np.log((corpus + smooth) / (corpus.sum() + smooth * buckets)))
    model = QualityModel(ratio, float("-inf"))
    passing = apply_quality(trusted.withColumnRenamed("_text", text), model, text, []).where(
        "not base_failed")
    low, middle = passing.select(F.percentile("score", F.array(F.lit(1 - keep), F.lit(0.5)))
                                 ).first()[0] or (float("-inf"), 0.0)
    return QualityModel(ratio, low - slack * (middle - low))


def apply_quality(docs: DataFrame, model: QualityModel, text: str = "text",
                  keep_columns: list[str] | None = None) -> DataFrame:
    """``keep_columns`` (all columns by default) with the base counts, score and verdict.

    A null text is an empty one. Repeated rows are judged one by one, alike; a score equal to the
    threshold is kept. An empty table gives no rows, a very long text is a batch of its own. A
    result column takes the place of a kept one of its name.
    """
    kept = without(docs.columns if keep_columns is None else keep_columns, RESULTS)
    body = unused("_text", kept)
    source = docs.select(*kept, F.col(text).alias(body))
    kinds = docs.select(*kept).schema

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, body):
            texts = texts_of(batch, body)
            found = list(zip(*map(base_counts, texts), strict=True))
            score = scores(texts, model)
            failed = np.array(found[5], bool)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *[pa.array(c, pa.int64()) for c in found[:5]],
                 pa.array(failed), pa.array(score), pa.array(~failed & (score >= model.threshold))],
                [*kept, *RESULTS])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kinds],
                        METRICS, "score double", "kept boolean"])
    return source.mapInArrow(judge, schema)


def keep_good(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text the rules keep."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            texts = texts_of(batch, text)
            good = scores(texts, model) >= model.threshold
            good &= [not base_counts(t)[5] for t in texts]
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(judge, docs.schema)
