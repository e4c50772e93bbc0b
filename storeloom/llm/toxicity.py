"""Severity of toxic texts by cumulative-link ordinal regression.

Features are the distinct words of a text, the beginnings of its words, and the beginnings that several
of its distinct words share. One weight vector serves all grades: with ordered thresholds
``t1 < t2 < t3`` the model has ``P(grade < k) = sigmoid(t_k - w.x)``. A document's severity is its
expected grade.

Features, weights and thresholds are fitted on a bounded sample of labelled documents. The labels
say toxic or not; the grade of a toxic document is 1, 2 or 3 by how much of it is toxic: the number of
its sentences that hold a marked feature (one far more frequent in toxic than in other labelled
documents), cut at thirds. The model sees distinct features of whole texts only, not sentences.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.llm.common import slices, texts_of, unused, without
from storeloom.session import cut_lineage

#: Labelled documents of each label that are fitted on, at most: those with the smallest hashes.
LABELLED = 10_000
#: Features that the model has, at most, and how many labelled documents must have one.
VOCABULARY = 1 << 16
LEAST_DOCUMENTS = 3
#: Features are chosen whose share differs between the labels by so many standard errors.
LEAST_Z = 4.0
GRADES = 4
BEGINNINGS = (4, 5, 6, 7)
#: A beginning counts once more where so many distinct words share it.
SHARED = (2, 3)
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def features_of(text: str, known: Collection[str] | None = None) -> set[str]:
    """Features of a text; with ``known`` only those that are among them."""
    words = set(_WORD.findall(text.lower()))
    starts: dict[str, int] = {}
    for w in words:
        for n in BEGINNINGS:
            if len(w) > n and (known is None or "^" + w[:n] in known):
                starts[w[:n]] = starts.get(w[:n], 0) + 1
    found = words if known is None else words.intersection(known)
    for start, n in starts.items():
        found.add("^" + start)
        found.update(f"^{start}#{k}" for k in SHARED if n >= k)
    return found if known is None else found.intersection(known)


def marked_sentences(text: str, marked: Collection[str]) -> int:
    """Sentences that have a marked feature."""
    return sum(bool(features_of(x, marked)) for x in _SENTENCE.findall(text))


@dataclass(frozen=True)
class SeverityModel:
    """Weight of each feature and the thresholds between grades."""

    weights: dict[str, float]
    thresholds: np.ndarray

    def grades(self, texts: list[str]) -> np.ndarray:
        """Probability of each grade (column) for each text (row)."""
        eta = np.array([sum(self.weights[f] for f in sorted(features_of(t, self.weights)))
                        for t in texts])
        below = _sigmoid(self.thresholds[None, :] - eta[:, None])
        edges = np.hstack([np.zeros((len(texts), 1)), below, np.ones((len(texts), 1))])
        return np.diff(edges, axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, width: int,
                weights: np.ndarray | None = None, steps: int = 250, rate: float = 0.05,
                decay: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by Adam on the whole sample; feature ``columns[i]`` is in document
    ``rows[i]``, and ``weights`` are those of the documents. The gaps between thresholds are
    exponentials, so that their order holds."""
    n, cuts = len(grades), int(grades.max(initial=1))
    share = np.ones(n) / n if weights is None else weights / weights.sum()
    shares = np.array([share[grades < k + 1].sum() for k in range(cuts)]).clip(1e-3, 1 - 1e-3)
    start = np.log(shares / (1 - shares))
    w = np.zeros(width)
    free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    moments = [[np.zeros_like(v), np.zeros_like(v)] for v in (w, free)]
    pick = np.arange(n)
    for step in range(1, steps + 1):
        gaps = np.exp(free[1:])
        cut = np.concatenate([free[:1], free[0] + np.cumsum(gaps)])
        eta = np.bincount(rows, weights=w[columns], minlength=n)
        below = np.hstack([np.zeros((n, 1)), _sigmoid(cut[None, :] - eta[:, None]), np.ones((n, 1))])
        slope = below * (1 - below)
        chance = np.maximum(below[pick, grades + 1] - below[pick, grades], 1e-12) / share
        d_eta = (slope[pick, grades + 1] - slope[pick, grades]) / chance
        d_w = np.bincount(columns, weights=d_eta[rows], minlength=width) + decay * w
        d_cut = np.zeros(cuts)
        for k in range(cuts):
            d_cut[k] = (((grades == k + 1) * 1.0 - (grades == k)) * slope[:, k + 1] / chance).sum()
        tail = np.cumsum(d_cut[::-1])[::-1]  # a gap moves all thresholds above it
        d_free = np.concatenate([tail[:1], tail[1:] * gaps])
        for v, d, (m, s) in zip((w, free), (d_w, d_free), moments, strict=True):
            m += 0.1 * (d - m)
            s += 0.001 * (d * d - s)
            v -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    gaps = np.exp(free[1:])
    return w, np.concatenate([free[:1], free[0] + np.cumsum(gaps)])


def _sample(docs: DataFrame, labels: DataFrame, text: str, id_col: str, toxic: str,
            labelled: int) -> DataFrame:
    """Texts and labels of at most ``labelled`` documents of each label."""
    known = (labels.where(F.col(toxic).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(toxic).cast("int")).alias("_toxic")))
    order = [F.xxhash64("_id"), F.col("_id")]
    chosen = (known.where("_toxic = 1").orderBy(*order).limit(labelled)
              .union(known.where("_toxic = 0").orderBy(*order).limit(labelled)))
    return cut_lineage(docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
                       .join(F.broadcast(chosen), "_id").select("_text", "_toxic"))


def fit_severity(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id",
                 toxic: str = "toxic", labelled: int = LABELLED, vocabulary: int = VOCABULARY,
                 least: int = LEAST_DOCUMENTS) -> SeverityModel | None:
    """The model, or None where no labelled document is toxic. An id labelled twice is toxic if
    either label says so."""
    sample = _sample(docs, labels, text, id_col, toxic, labelled)
    totals = {r._toxic: r.n for r in sample.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    if not totals.get(1):
        return None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[tuple[str, int]] = Counter()

        def counted() -> pa.RecordBatch:
            names, bad = zip(*seen, strict=True) if seen else ((), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(bad, pa.int32()),
                 pa.array(list(seen.values()), pa.int64())], ["feature", "toxic", "n"])

        for batch in slices(batches, "_text"):
            for body, bad in zip(texts_of(batch, "_text"), batch.column(1).to_pylist(), strict=True):
                seen.update((f, bad) for f in features_of(body))
                if len(seen) > 200_000:
                    yield counted()
                    seen.clear()
        yield counted()

    bad_, clean = totals[1], totals.get(0, 0)
    share = F.col("n") / (bad_ + clean)
    apart = F.col("bad") / bad_ - (F.col("n") - F.col("bad")) / max(clean, 1)
    error = F.sqrt(share * (1 - share) * (1 / bad_ + 1 / max(clean, 1)))
    # At most ``vocabulary`` rows.
    listed = (sample.mapInArrow(count, "feature string, toxic int, n long").groupBy("feature")
              .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("toxic")).alias("bad"))
              .where(F.col("n") >= least)
              .withColumn("z", F.round(F.abs(apart) / F.greatest(error, F.lit(1e-9)), 6))
              .where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "feature").limit(vocabulary).collect())
    index = {r.feature: i for i, r in enumerate(listed)}
    marked = {r.feature for r in listed if np.log((r.bad + 0.5) / (bad_ + 1)) - np.log(
        (r.n - r.bad + 0.5) / (clean + 1)) > 3}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            texts, toxic_ = texts_of(batch, "_text"), batch.column(1)
            found = [sorted(index[f] for f in features_of(t, index)) for t in texts]
            said = [marked_sentences(t, marked) if bad else 0
                    for t, bad in zip(texts, toxic_.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.array(f, np.int32).tobytes() for f in found], pa.binary()),
                 pa.array(said, pa.int64()), toxic_], ["features", "said", "toxic"])

    # At most ``labelled`` rows of each label, with a number for each of their features.
    data = sorted(sample.mapInArrow(encode, "features binary, said long, toxic int").collect(),
                  key=lambda r: (r.toxic, r.said, bytes(r.features)))
    features = [np.frombuffer(r.features, np.int32) for r in data]
    bad = np.array([r.toxic for r in data])
    found = np.array([r.said for r in data])
    low, high = np.quantile(found[bad == 1], [1 / 3, 2 / 3])
    grades = np.where(bad == 1, 1 + (found > low) + (found > high), 0)
    # Grades that no document has would have no threshold.
    levels, grades = np.unique(grades, return_inverse=True)
    rows = np.repeat(np.arange(len(data)), [len(f) for f in features])
    balance = np.where(bad == 1, np.sqrt(max(clean, 1) / bad_), 1.0)
    w, cuts = fit_ordinal(rows, np.concatenate(features).astype(int), grades, len(index), balance)
    if len(levels) == 1:  # toxic documents only
        cuts = np.array([-500.0])
    return SeverityModel({f: float(w[i]) for f, i in index.items()}, cuts)


def severity(docs: DataFrame, model: SeverityModel | None, text: str = "text",
             keep: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """``keep`` (``doc_id`` by default) with ``severity`` (expected grade), ``grade`` (the likeliest)
    and ``toxic`` (the chance of any grade above 0 is at least ``threshold``).

    A null text is an empty one; without a model nothing is toxic. Repeated rows score alike. A result
    column takes the place of a kept one of its name.
    """
    kept = without(["doc_id"] if keep is None else keep, ["severity", "grade", "toxic"])
    body = unused("_text", kept)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, body):
            texts = texts_of(batch, body)
            chances = model.grades(texts) if model else np.eye(GRADES)[[0] * len(texts)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(chances @ np.arange(chances.shape[1], dtype=float)),
                 pa.array(chances.argmax(axis=1).astype(np.int32)),
                 pa.array(chances[:, 1:].sum(axis=1) >= threshold)],
                [*kept, "severity", "grade", "toxic"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    return docs.select(*kept, F.col(text).alias(body)).mapInArrow(
        score, f"{kinds}, severity double, grade int, toxic boolean")
