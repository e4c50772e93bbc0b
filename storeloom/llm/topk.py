"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

All vectors are packed into blocks, and so are the queries. Groups of blocks meet on a grid whose cells
are shuffle partitions: a cell holds its queries, whose number is bounded, and the blocks of vectors pass one
by one. Each dimension of a block is one list. A query reads its lists from the end
that helps it (the smallest values first where its component is negative), a few rows deeper each
time; rows seen for the first time get their whole score. The values at the present depth bound the
score of every row not seen yet, and the query stops as soon as that bound is below its k-th score, which
it keeps from block to block. Queries whose bound tells that they would see much of a block get the
scores of all its rows by one matrix product. The best of each cell then meet in one ranking per query.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeloom.session import cut_lineage

#: Vectors and queries of a block.
BLOCK = 4096
QUERY_BLOCK = 256
#: Components of all queries that a cell of the grid holds, about.
HELD = 1 << 22
#: Depth of the first look into the lists; it doubles.
FIRST_DEPTH = 8
#: A look at more than this share of a block reads it whole.
WHOLE = 1 / 4
#: Queries of a matrix product.
AT_ONCE = 256
#: Rows of a block whose best score tells how low the k-th can be.
GROUP = 64
#: Rows of a batch of results.
RESULTS = 1 << 16
_PACKED = "part int, number int, dim int, n int, width int, ids binary, heads binary, vectors binary"
_NONE = np.iinfo(np.int64).min


def quantised(vector: str, scale: int = 256) -> Column:
    """floor(scale * x) of each component x, as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: str) -> Column:
    """The vector is not null and has finite components only."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                               & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def narrow(values: np.ndarray) -> np.ndarray:
    """The same whole numbers in the narrowest type of two, four or eight bytes."""
    for kind in (np.int16, np.int32):
        if not values.size or (values.min() >= np.iinfo(kind).min and values.max() <= np.iinfo(kind).max):
            return values.astype(kind)
    return values


def pack(vectors: DataFrame, size: int) -> DataFrame:
    """``id``, ``head`` (array<long>, of one length) and ``vector`` (array<long>) as rows of up to ``size``
    vectors of one dimension, numbered inside their partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        number = 0
        waiting: dict[int, list[list[np.ndarray]]] = defaultdict(lambda: [[], [], []])

        def packed(dim: int) -> pa.RecordBatch:
            nonlocal number
            ids, heads, rows = (np.concatenate(x) for x in waiting.pop(dim))
            rows = narrow(rows)
            number += 1
            return pa.RecordBatch.from_pylist([{
                "part": part, "number": number, "dim": dim, "n": len(ids), "width": rows.itemsize,
                "ids": ids.tobytes(), "heads": heads.tobytes(), "vectors": rows.tobytes()}],
                pa.schema([*((c, pa.int32()) for c in ("part", "number", "dim", "n", "width")),
                           *((c, pa.binary()) for c in ("ids", "heads", "vectors"))]))

        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            heads = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            heads = heads.reshape(len(ids), -1)
            dims = pa.compute.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(dims)
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                values = flat[(ends[rows] - dim)[:, None] + np.arange(dim)].astype(np.int64)
                while len(rows):
                    room = size - sum(map(len, waiting[dim][0]))
                    for kept, new in zip(waiting[dim], (ids[rows[:room]], heads[rows[:room]],
                                                        values[:room]), strict=True):
                        kept.append(new)
                    rows, values = rows[room:], values[room:]
                    if sum(map(len, waiting[dim][0])) == size:
                        yield packed(dim)
        for dim in list(waiting):
            yield packed(dim)

    return vectors.select("id", "head", "vector").mapInArrow(run, _PACKED)


class Rows:
    """Vectors of whole numbers, as the types that products need, each made once."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self._made: dict[type, np.ndarray] = {}

    def __len__(self) -> int:
        return len(self.values)

    def made(self, kind: type) -> np.ndarray:
        if kind not in self._made:
            self._made[kind] = self.values.astype(kind)
        return self._made[kind]

    @cached_property
    def lengths(self) -> np.ndarray:
        """The length of each vector, or a little more."""
        return 1.001 * np.sqrt(np.square(self.values, dtype=np.float64).sum(axis=1))


def product(queries: Rows, some: np.ndarray, vectors: Rows) -> np.ndarray:
    """Inner products of the queries at some places with all vectors, exact in the type that they come in: no
    sum of products, taken in any order, is beyond the product of the lengths, and floats hold whole
    numbers up to 2**24 or 2**53."""
    most = queries.lengths[some].max(initial=0) * vectors.lengths.max(initial=0)
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    return queries.made(kind)[some] @ vectors.made(kind).T


def first_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, highest first, ties in the order of places."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.argsort(-scores[places], kind="stable")][:k]


def lowest_of(scores: np.ndarray) -> float | int:
    return _NONE if scores.dtype == np.int64 else -np.inf


def without_own(scores: np.ndarray, own: np.ndarray, ids: np.ndarray) -> None:
    """Gives the lowest score to rows of the queries' own ids; ``ids`` are in order."""
    left, right = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
    for i in np.flatnonzero(left < right).tolist():
        scores[i, left[i]:right[i]] = lowest_of(scores)


class Best:
    """The ``k`` best rows that each query has met so far, ties to the smaller id, without those of its
    own id."""

    def __init__(self, own: np.ndarray, queries: np.ndarray, k: int):
        self.own, self.queries, self.k = own, Rows(queries), k
        self.count = np.zeros(len(own), np.int64)
        #: Of each query's best rows; the number tells rows of the same id apart.
        self.ids, self.scores, self.numbers = np.zeros((3, len(own), k), np.int64)
        #: The least score that still counts: the k-th of each query once there are k.
        self.least = np.full(len(own), _NONE)

    def add(self, queries: np.ndarray, ids: np.ndarray, scores: np.ndarray, numbers: np.ndarray) -> None:
        """More rows that the queries at these places have met."""
        touched = np.unique(queries)
        count = self.count[touched]
        old = np.arange(self.k) < count[:, None]
        at = np.concatenate([np.repeat(touched, count), queries])
        ids = np.concatenate([self.ids[touched][old], ids])
        scores = np.concatenate([self.scores[touched][old], scores])
        numbers = np.concatenate([self.numbers[touched][old], numbers])
        order = np.lexsort((numbers, ids, -scores, at))
        at, ids, scores, numbers = at[order], ids[order], scores[order], numbers[order]
        first = np.searchsorted(at, touched)
        met = np.diff(np.append(first, len(at)))
        rank = np.arange(len(at)) - np.repeat(first, met)
        kept = rank < self.k
        for mine, new in ((self.ids, ids), (self.scores, scores), (self.numbers, numbers)):
            mine[at[kept], rank[kept]] = new[kept]
        self.count[touched] = np.minimum(met, self.k)
        full = touched[met >= self.k]
        self.least[full] = self.scores[full, -1]

    def take(self, some: np.ndarray, scores: np.ndarray, ids: np.ndarray, passed: int = 0) -> None:
        """The rows of a block by their scores for the queries at the places ``some``; rows of the lowest
        number of the scores' type take no part. ``passed`` rows came before them."""
        n, lowest = len(ids), lowest_of(scores)
        whole = n - n % GROUP
        most = scores[:, :whole].reshape(len(some), -1, GROUP).max(axis=2)
        if whole < n:
            most = np.concatenate([most, scores[:, whole:].max(axis=1, keepdims=True)], axis=1)
        least = self.least[some].astype(scores.dtype)
        hit = np.flatnonzero(most.max(axis=1) >= least)
        if not len(hit):
            return
        least, most = least[hit], most[hit]
        if most.shape[1] >= self.k:
            # The best rows of k groups are k rows.
            least = np.maximum(least, np.partition(most, most.shape[1] - self.k, axis=1)[:, -self.k])
        good = (scores if len(hit) == len(some) else scores[hit]) >= least[:, None]
        at, places = np.divmod(np.flatnonzero(good.ravel()), n)
        at = hit[at]
        found = scores[at, places]
        there = found > lowest
        if there.any():
            at, places = at[there], places[there]
            self.add(some[at], ids[places], found[there].astype(np.int64), passed + places)

    def meet(self, asked: np.ndarray, ids: np.ndarray, vectors: Rows) -> None:
        """Queries at the places ``asked`` against all rows of a block in the order of ids."""
        for start in range(0, len(asked), AT_ONCE):
            some = asked[start:start + AT_ONCE]
            scores = product(self.queries, some, vectors)
            without_own(scores, self.own[some], ids)
            self.take(some, scores, ids)

    def results(self, *columns: np.ndarray) -> Iterator[list[np.ndarray]]:
        """The given columns, one value for each query, with its best rows' ids and scores."""
        step = max(1, RESULTS // max(1, self.k))
        for start in range(0, len(self.count), step):
            part = slice(start, start + step)
            n = self.count[part]
            if n.sum():
                there = np.arange(self.k) < n[:, None]
                yield [*(np.repeat(c[part], n) for c in columns), self.ids[part][there], self.scores[part][there]]


class Lists:
    """Sorted lists of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors

    @cached_property
    def order(self) -> np.ndarray:
        return np.argsort(-self.vectors.astype(np.int64), axis=0, kind="stable")

    @cached_property
    def values(self) -> np.ndarray:
        return np.take_along_axis(self.vectors, self.order, axis=0).astype(np.int64)

    @cached_property
    def largest(self) -> int:
        return int(np.abs(self.vectors.astype(np.int64)).max(initial=0))

    @cached_property
    def floats(self) -> np.ndarray:
        return self.vectors.astype(np.float64)

    @cached_property
    def ends(self) -> tuple[np.ndarray, np.ndarray]:
        """The values that the lists have at some depths from their small and from their large end; looks to
        these depths are at no more than a part of the block."""
        n, dim = self.vectors.shape
        depths, depth = [1], FIRST_DEPTH
        while depth * max(dim, 1) <= WHOLE * n:
            depths.append(depth)
            depth *= 2
        places = np.array(depths) - 1
        ranked = np.partition(self.vectors, np.unique([*places, *(n - 1 - places)]), axis=0)
        return ranked[places], ranked[n - 1 - places]

    def frontiers(self, queries: np.ndarray) -> np.ndarray:
        """For each query and each depth of ``ends``, what rows not seen by that depth cannot exceed."""
        small, large = self.ends
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        most = float(np.abs(queries).max(initial=0)) * max(
            -float(small.min(initial=0)), float(large.max(initial=0)))
        # Scores fit in 64 bits, but what bounds them may not.
        kind = np.float64 if most * max(small.shape[1], 1) < 1 << 53 else object
        return up.astype(kind) @ large.T.astype(kind) + down.astype(kind) @ small.T.astype(kind)

    def top(self, query_id: int, query: np.ndarray, k: int,
            floor: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows of other ids, ties to the smaller id; of rows of a score of
        ``floor`` at least, if it is given."""
        n, dim = self.vectors.shape
        # Products and sums below 2**53 are exact as doubles.
        exact = self.largest * int(np.abs(query).max(initial=0)) * max(dim, 1) < 1 << 53
        rows, weights = (self.floats, query.astype(np.float64)) if exact \
            else (self.vectors.astype(np.int64), query)
        wide = np.int64 if exact else object
        up = query < 0
        order, values = self.order, self.values
        seen = np.zeros(n, bool)
        best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, upto = 0, min(n, FIRST_DEPTH) if dim else n
        while depth < n:
            if dim:
                look = np.where(up, order[n - upto:n - depth][::-1], order[depth:upto])
                new = np.zeros(n, bool)
                new[look.ravel()] = True
                new = np.flatnonzero(new & ~seen)
                seen[new] = True
            else:
                new = np.arange(n)
            new = new[self.ids[new] != query_id]
            scores = (rows[new] @ weights).astype(np.int64)
            least = best[-1] if len(best) == k else floor
            if least is not None:
                better = scores >= least
                new, scores = new[better], scores[better]
            if len(new):
                all_ids = np.concatenate([best_ids, self.ids[new]])
                all_scores = np.concatenate([best, scores])
                first = np.lexsort((all_ids, -all_scores))[:k]
                best_ids, best = all_ids[first], all_scores[first]
            if not dim:
                break
            frontier = np.where(up, values[n - upto], values[upto - 1])
            least = best[-1] if len(best) == k else floor
            if least is not None and int(frontier.astype(wide) @ query.astype(wide)) < least:
                break
            depth, upto = upto, min(n, 2 * upto)
        return best_ids, best


class Search(Best):
    """The threshold algorithm of held queries over passing blocks."""

    def look(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        deep = np.arange(len(self.own))
        full = self.least > _NONE
        if full.any():
            lists = Lists(ids, vectors)
            known = np.flatnonzero(full)
            # At the first of these depths that is below the k-th score a query stops, or before.
            below = np.concatenate([
                lists.frontiers(self.queries.values[some]) < self.least[some][:, None]
                for some in np.array_split(known, -(-len(known) // AT_ONCE))])
            for i in known[below.any(axis=1) & ~below[:, 0]].tolist():
                found = lists.top(int(self.own[i]), self.queries.values[i], self.k, int(self.least[i]))
                self.add(np.full(len(found[0]), i), *found, np.zeros(len(found[0]), np.int64))
            deep = np.concatenate([np.flatnonzero(~full), known[~below.any(axis=1)]])
        self.meet(deep, ids, Rows(vectors))


def meetings(data: DataFrame, asked: DataFrame, begin: Callable, names: list[str], schema: str,
             held: int = HELD) -> DataFrame:
    """What packed queries find among packed vectors of their dimension, on a grid.

    Blocks of queries are dealt to as many groups as keep about ``held`` components each, those of vectors
    to as many as give the session's number of shuffle partitions; every two groups are a cell, which is
    one partition. There ``begin(keys, heads, queries)`` makes what the cell holds of a dimension, its
    ``look(ids, heads, vectors)`` gets each block, and its ``results()`` are lists of columns.
    """
    spark = data.sparkSession
    held_here = asked.agg(F.sum(F.col("n").cast("long") * F.greatest("dim", F.lit(1)))).first()[0] or 0
    across = max(1, -(-held_here // held))
    down = max(1, min(-(-int(spark.conf.get("spark.sql.shuffle.partitions")) // across), data.count()))

    def dealt(groups: int) -> Column:
        """Each partition deals its blocks in turn, from a place of its own."""
        return F.pmod(F.xxhash64("part") + F.col("number"), F.lit(groups)).cast("int")

    def every(groups: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))

    columns = ["dim", "n", "width", "ids", "heads", "vectors"]
    left = data.select(dealt(down).alias("row"), every(across).alias("col"), F.lit(1).alias("kind"), *columns)
    right = asked.select(dealt(across).alias("col"), every(down).alias("row"), F.lit(0).alias("kind"), *columns)
    met = left.unionByName(right).withColumn("cell", F.col("row") * across + F.col("col"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, asked_here, holds = None, [], None

        def found() -> Iterator[pa.RecordBatch]:
            for columns in holds.results() if holds else ():
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

        for batch in batches:
            for row in range(batch.num_rows):
                cell, kind, dim, n, width, ids, heads, vectors = (c[row].as_py() for c in batch.columns)
                if (cell, dim) != at:
                    yield from found()
                    at, asked_here, holds = (cell, dim), [], None
                block = (np.frombuffer(ids, np.int64),
                         np.frombuffer(heads, np.int64).reshape(n, len(heads) // 8 // n),
                         np.frombuffer(vectors, f"i{width}").reshape(n, dim))
                if kind == 0:
                    asked_here.append(block)
                    continue
                if asked_here:
                    holds = begin(*(np.concatenate(x) for x in zip(*asked_here, strict=True)))
                    asked_here = []
                if holds:
                    holds.look(*block)
        yield from found()

    return (met.repartitionById(down * across, "cell").sortWithinPartitions("cell", "dim", "kind")
            .select("cell", "kind", *columns).mapInArrow(run, schema))


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id",
          vector: str = "embedding", scale: int = 256, block: int = BLOCK,
          query_block: int = QUERY_BLOCK, held: int = HELD) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the ``k`` best rows of ``vectors`` by the inner
    product of quantised vectors, ties to the smaller id, all if there are fewer.

    Every row is a candidate, repeated ones too, but for rows with the query's own id; a query that
    is repeated with the same id and vector counts once. Rows without an id, without a vector, or
    with null or non-finite components take no part, and vectors of different lengths do not
    meet. Scores must fit in 64 bits.
    """
    def clean(df: DataFrame) -> DataFrame:
        return df.where(usable(vector) & F.col(id_col).isNotNull()).select(
            F.col(id_col).cast("long").alias("id"), quantised(vector, scale).alias("vector"))

    data = cut_lineage(pack(clean(vectors).withColumn("head", F.array().cast("array<long>")), block))
    asked = cut_lineage(pack(clean(queries).dropDuplicates().select(
        F.monotonically_increasing_id().alias("id"), F.array("id").alias("head"), "vector"), query_block))

    class Cell:
        def __init__(self, keys, heads, rows):
            self.keys, self.best = keys, Search(heads[:, 0], rows.astype(np.int64), k)

        def look(self, ids, heads, rows):
            self.best.look(ids, rows)

        def results(self):
            return self.best.results(self.keys, self.best.own)

    found = meetings(data, asked, Cell, ["query", "query_id", "vec_id", "score"],
                     "query long, query_id long, vec_id long, score long", held)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
