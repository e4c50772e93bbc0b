"""Hard negatives for each anchor's positives by a secondary sort of scored pairs.

Vectors and anchors are packed into blocks that meet on a grid, whose cells hold their anchors while the
blocks of vectors pass, and each meeting is one matrix product, of rows of the same label where only those
count. Twice, pairs are shuffled by anchor and sorted inside the partitions by (anchor, descending
score, positives first, id), the DataFrame form of repartitionAndSortWithinPartitions, and read as a
stream that holds counters only, never an anchor's pairs. The first stream takes each anchor's
positives. The second one has the positives and the candidates of their windows: a positive opens
its window of scores when it passes, a negative goes to every open window that it lies in, and a
full window takes no more. A cell sends only pairs that can still count: the first positives that an
anchor meets there, and the first negatives of each window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.llm import topk
from storeloom.llm.topk import AT_ONCE, HELD, RESULTS, Best, Rows, first_of, meetings, pack, quantised, usable
from storeloom.session import cut_lineage

__all__ = ["bounds", "first_of", "mine", "product"]

#: Vectors and anchors of a block.
BLOCK = 4096
ANCHOR_BLOCK = 512
POSITIVE, NEGATIVE = 0, 1
_KINDS = ["anchor", "anchor_id", "score", "kind", "id"]
_PAIR = "anchor long, anchor_id long, score long, kind int, id long"


def bounds(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest score n with low * score <= 100 * n <= high * score."""
    return -(-low * score // 100), high * score // 100


def product(anchors: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products, exact."""
    return topk.product(Rows(anchors), np.arange(len(anchors)), Rows(vectors)).astype(np.int64)


class Positives:
    """Each anchor's first rows of its label and another id among those that have passed."""

    def __init__(self, keys: np.ndarray, heads: np.ndarray, anchors: np.ndarray, k: int):
        order = np.argsort(heads[:, 1], kind="stable")
        self.keys, self.labels = keys[order], heads[order, 1]
        self.best = Best(heads[order, 0], anchors[order].astype(np.int64), k)

    def look(self, ids: np.ndarray, heads: np.ndarray, vectors: np.ndarray) -> None:
        order = np.lexsort((ids, heads[:, 0]))
        ids, labels, vectors = ids[order], heads[order, 0], vectors[order]
        for label in np.intersect1d(labels, self.labels):
            mine = np.arange(*(np.searchsorted(self.labels, label, side) for side in ("left", "right")))
            rows = slice(*(np.searchsorted(labels, label, side) for side in ("left", "right")))
            self.best.meet(mine, ids[rows], Rows(vectors[rows]))

    def results(self) -> Iterator[list[np.ndarray]]:
        for key, own, ids, scores in self.best.results(self.keys, self.best.own):
            yield [key, own, scores, np.full(len(key), POSITIVE, np.int32), ids]


class Windows:
    """The first rows of another label and id in each window of an anchor's scores, among those that
    have passed. A row that is first in several windows is there once."""

    def __init__(self, keys: np.ndarray, heads: np.ndarray, anchors: np.ndarray, k: int, low: int, high: int):
        self.keys, self.own, self.labels = keys, heads[:, 0], heads[:, 1]
        self.anchors, self.k, self.passed = Rows(anchors.astype(np.int64)), k, 0
        found = [[bounds(s, low, high) for s in scores[:n]] + [(1, 0)] * (len(scores) - n)
                 for n, scores in zip(heads[:, 2].tolist(), heads[:, 3:].tolist(), strict=True)]
        #: Least and largest score that still counts in each window, and those of the window itself.
        self.window = np.array(found, np.int64).reshape(len(keys), -1, 2)
        self.least = self.window[:, :, 0].copy()
        self.found = [np.zeros((3, 0), np.int64)] * len(keys)  # score, id, place among all that have passed

    def look(self, ids: np.ndarray, heads: np.ndarray, vectors: np.ndarray) -> None:
        labels, vectors = heads[:, 0], Rows(vectors)
        for start in range(0, len(self.keys), AT_ONCE):
            some = np.arange(start, min(start + AT_ONCE, len(self.keys)))
            scores = topk.product(self.anchors, some, vectors)
            hit = np.zeros(len(some), bool)
            for least, largest in zip(self.least[some].T.astype(scores.dtype),
                                      self.window[some, :, 1].T.astype(scores.dtype), strict=True):
                rest = np.flatnonzero(~hit)
                here = scores if len(rest) == len(some) else scores[rest]
                hit[rest] = ((here >= least[rest, None]) & (here <= largest[rest, None])).any(axis=1)
            for i in np.flatnonzero(hit).tolist():
                self._add(start + i, scores[i], ids, labels)
        self.passed += len(ids)

    def _add(self, anchor: int, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        open_ = self.least[anchor] <= self.window[anchor, :, 1]
        least, largest = self.least[anchor][open_].min(), self.window[anchor, :, 1][open_].max()
        places = np.flatnonzero((scores >= scores.dtype.type(least)) & (scores <= scores.dtype.type(largest)))
        places = places[(labels[places] != self.labels[anchor]) & (ids[places] != self.own[anchor])]
        if not len(places):
            return
        rows = np.concatenate([self.found[anchor], np.stack(
            [scores[places].astype(np.int64), ids[places], self.passed + places])], axis=1)
        rows = rows[:, np.lexsort((rows[2], rows[1], -rows[0]))]
        falling, chosen = -rows[0], [np.zeros(0, np.int64)]
        for window, (low, high) in enumerate(self.window[anchor].tolist()):
            first = int(np.searchsorted(falling, -high, "left"))
            last = min(int(np.searchsorted(falling, -low, "right")), first + self.k)
            chosen.append(np.arange(first, last))
            if last - first == self.k:
                self.least[anchor, window] = rows[0, last - 1]
        self.found[anchor] = rows[:, np.unique(np.concatenate(chosen))]

    def results(self) -> Iterator[list[np.ndarray]]:
        counts = np.array([f.shape[1] for f in self.found], np.int64)
        step = max(1, RESULTS // max(1, self.k * self.window.shape[1]))
        for start in range(0, len(counts), step):
            n, part = counts[start:start + step], slice(start, start + step)
            if n.sum():
                score, other, _ = np.concatenate(self.found[part], axis=1)
                yield [np.repeat(self.keys[part], n), np.repeat(self.own[part], n), score,
                       np.full(len(score), NEGATIVE, np.int32), other]


def _sorted_pairs(pairs: DataFrame) -> DataFrame:
    """The secondary sort: each anchor's pairs one after another, best first."""
    return pairs.repartition(F.col("anchor")).sortWithinPartitions(
        "anchor", F.desc("score"), "kind", "id")


def _first_positives(pairs: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, taken = None, 0
        for batch in batches:
            keep = []
            for row, key in enumerate(batch.column(0).to_pylist()):
                if key != anchor:
                    anchor, taken = key, 0
                if taken < k:
                    keep.append(row)
                    taken += 1
            yield batch.take(pa.array(keep, pa.int64()))

    return _sorted_pairs(pairs).mapInArrow(run, _PAIR)


def _window_negatives(pairs: DataFrame, k: int, low: int, high: int) -> DataFrame:
    schema = pa.schema([(c, pa.int32() if c == "rank" else pa.int64()) for c in (
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, windows = None, []  # one [least, largest, positive, its score, taken] per positive
        for batch in batches:
            found = []
            for key, own, score, kind, other in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != anchor:
                    anchor, windows = key, []
                if kind == POSITIVE:
                    windows.append([*bounds(score, low, high), other, score, 0])
                    continue
                for window in windows:
                    if window[0] <= score <= window[1] and window[4] < k:
                        window[4] += 1
                        found.append((own, window[2], window[4], other, window[3], score))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)],
                schema=schema) if found else pa.RecordBatch.from_pylist([], schema)

    return _sorted_pairs(pairs).mapInArrow(
        run, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
             "negative_score long")


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95, id_col: str = "vec_id", vector: str = "embedding",
         label: str = "label", scale: int = 256, block: int = BLOCK,
         anchor_block: int = ANCHOR_BLOCK, held: int = HELD) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A row's score is its integer inner product with the anchor, of vectors quantised by ``scale``;
    higher scores come first, ties by smaller id. An anchor's positives are its first ``positives`` rows
    of the same label and another id. For each of them come the first ``negatives`` rows of another label
    whose score is from ``low`` to ``high`` percent of the positive's (none if that is below zero,
    scores of zero if it is zero); all, if there are fewer.

    Rows without id, label or vector, or with a null or non-finite component, take no part; vectors
    of different lengths do not meet. Labels are whole numbers. Repeated rows are candidates one by
    one, and a repeated positive has a window for each time; an anchor repeated with its label
    and vector counts once. Other columns may have any name. Scores must fit in 64 bits. Without
    anchors, or without rows, the result is empty.
    """
    if not 0 <= low <= high <= 100:
        raise ValueError("windows need 0 <= low <= high <= 100")

    def clean(df: DataFrame) -> DataFrame:
        return df.where(usable(vector) & F.col(id_col).isNotNull() & F.col(label).isNotNull()).select(
            F.col(id_col).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
            quantised(vector, scale).alias("vector"))

    data = cut_lineage(pack(clean(vectors).select("id", F.array("label").alias("head"), "vector"), block))
    asked = cut_lineage(clean(anchors).dropDuplicates().withColumn(
        "anchor", F.monotonically_increasing_id()))

    def first(keys, heads, rows):
        return Positives(keys, heads, rows, positives)

    def inside(keys, heads, rows):
        return Windows(keys, heads, rows, negatives, low, high)

    found = cut_lineage(_first_positives(meetings(data, cut_lineage(pack(asked.select(
        F.col("anchor").alias("id"), F.array("id", "label").alias("head"), "vector"),
        anchor_block)), first, _KINDS, _PAIR, held), positives))
    # At most ``positives`` scores for each anchor, filled up to that number with zeros.
    scores = found.groupBy("anchor").agg(F.collect_list("score").alias("found"))
    windows = asked.join(scores, "anchor").select(F.col("anchor").alias("id"), F.concat(
        F.array("id", "label", F.size("found").cast("long")), "found",
        F.array_repeat(F.lit(0).cast("long"), positives - F.size("found"))).alias("head"), "vector")
    candidates = meetings(data, cut_lineage(pack(windows, anchor_block)), inside, _KINDS, _PAIR, held)
    return _window_negatives(found.unionByName(candidates), negatives, low, high)
