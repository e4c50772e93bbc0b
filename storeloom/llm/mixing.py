"""Mixing sources to target weights.

The words of a source, its documents in the order of a hash, are cut into blocks of equal size (to
one word). A source whose target is ``t`` of ``s`` words gives ``round(blocks * t / s)`` draws: first
every block once in a permuted order, then again from the start of another permutation. A
splitting tree deals the draws of all sources out among the shards: at each node the draws of the left
shards are one sample without replacement from those of the node, so their numbers by source
follow a multivariate hypergeometric distribution and every draw lands in exactly one shard. A shard
takes its draws of a source from consecutive places of the source's permutation, and is shuffled
by itself. Sizes, targets, quotas and shares of the shards are a frame with a row per source. The tree
is drawn first for groups of sources, about as many as a group has members, then in each group for
its sources, given what the group has: together that is one draw for all sources.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeloom.llm.common import WORD, whole_text
from storeloom.operators.ordered import ordered_scan
from storeloom.session import cut_lineage

#: Sources whose shares of the shards one task draws, at least.
LEAST_GROUP = 256
#: Words of a block, at most; a small source has blocks of 1/256 of its words instead.
BLOCK_WORDS = 1024
#: Weights of the sources in order, repeating.
DEFAULT_WEIGHTS = (3.0, 1.0, 2.0)
LEAST_BLOCKS = 256
#: Words of the largest source in one hash range, on average; running sums are taken range by range.
RANGE_WORDS = 1 << 20
#: Words of one part of a large shard, on average.
SHARD_WORDS = 1 << 22


def word_count(text: str) -> Column:
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], share: float = 1.5,
            most: float = 2.0) -> list[float]:
    """Words for each source: ``share`` of all words by weight, at most ``most`` times its size; what
    is over goes to the others by weight, until none is above its limit."""
    limits = [most * s for s in sizes]
    out = [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), share * sum(sizes)
    while open_:
        total = sum(weights[i] for i in sorted(open_))
        full = [i for i in sorted(open_) if left * weights[i] / total >= limits[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = float(limits[i])
        left -= sum(limits[i] for i in full)
        open_ -= set(full)
    return out


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Good ones among ``draws`` without replacement, for numbers of any size: the ratios of
    neighbouring probabilities are summed over twelve standard deviations around the mode."""
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    total = good + bad
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    spread = (draws * (good / total) * (bad / total) * ((total - draws) / max(1, total - 1))) ** 0.5
    first, last = max(low, mode - int(12 * spread) - 12), min(high, mode + int(12 * spread) + 12)
    k = np.arange(first, last, dtype=np.float64)
    steps = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    odds = np.cumsum(np.exp(logs - logs.max()))
    return first + int(np.searchsorted(odds, rng.random() * odds[-1], side="right"))


def splitting_tree(quotas: Sequence[int], shards: int, seed: int = 0,
                   totals: Sequence[int] | None = None) -> np.ndarray:
    """Draws of each shard (row) from each source (column); columns sum to the quotas exactly, rows
    to ``totals``, by default to the same number, to one."""
    out = np.zeros((shards, len(quotas)), np.int64)
    all_draws = sum(quotas)
    sizes = list(totals) if totals is not None else [
        all_draws * (i + 1) // shards - all_draws * i // shards for i in range(shards)]

    def split(first: int, last: int, places: list[int], counts: list[int]) -> None:
        if last - first == 1:
            out[first, places] = counts
            return
        middle = (first + last) // 2
        rng = np.random.default_rng([seed, first, last])
        need, rest = sum(sizes[first:middle]), sum(counts)
        left = []
        for n in counts:
            rest -= n
            left.append(hypergeometric(rng, n, rest, need))
            need -= left[-1]
        for start, end, some in ((first, middle, left),
                                 (middle, last, [n - x for n, x in zip(counts, left, strict=True)])):
            held = [(i, n) for i, n in zip(places, some, strict=True) if n]
            if held:
                split(start, end, *map(list, zip(*held, strict=True)))

    held = [(i, int(n)) for i, n in enumerate(quotas) if n]
    if held:
        split(0, shards, *map(list, zip(*held, strict=True)))
    return out


def _permutation(seed: int, name: str | None, run: int, n: int) -> tuple[int, int]:
    """Factor and shift of the order ``block -> (factor * block + shift) mod n``. Factors stay
    under 2**28, so that products of up to 2**35 blocks fit in 64 bits."""
    digest = hashlib.blake2b(repr((seed, name, run)).encode(), digest_size=16).digest()
    most = min(n, 1 << 28)
    factor = int.from_bytes(digest[:8], "little") % most or 1
    while math.gcd(factor, n) != 1:
        factor = factor % most + 1
    return factor, int.from_bytes(digest[8:], "little") % n


def weighted_sources(sized: DataFrame, weights: dict[str | None, float] | DataFrame | None) -> DataFrame:
    """``source_``, ``source_size``, ``weight`` and ``number`` (by code point, null last) of each source."""
    sizes = sized.groupBy(F.col("source").alias("source_")).agg(F.sum("size").alias("source_size"))
    numbered = ordered_scan(sizes, [F.col("source_").isNull(), "source_"], number="number")
    if weights is None:
        return numbered.withColumn("weight", F.element_at(
            F.array(*map(F.lit, DEFAULT_WEIGHTS)), ((F.col("number") - 1) % len(DEFAULT_WEIGHTS) + 1).cast("int")))
    if isinstance(weights, dict):
        weights = sized.sparkSession.createDataFrame(
            [(k, float(v)) for k, v in weights.items()], "source string, weight double")
    given = weights.select(F.col("source").alias("_given"), F.col("weight").cast("double").alias("weight"))
    lost = F.concat(F.lit("no weight for source "), F.coalesce(F.col("source_"), F.lit("NULL")))
    return numbered.join(given, F.col("source_").eqNullSafe(F.col("_given")), "left").withColumn(
        "weight", F.coalesce("weight", F.raise_error(lost).cast("double"))).drop("_given")


def with_targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """``sources`` with ``target``: the rounds of ``targets`` as one aggregate each. A round only
    needs what is left and the weight that shares it; who was full stays full."""
    limit, weight = most * F.col("source_size").cast("double"), F.col("weight")
    total = sources.agg(F.sum("source_size"), F.sum("weight"), F.count("*")).first()
    left, open_, full = share * (total[0] or 0), total[1] or 0.0, 0
    while open_ > 0:
        over = weight * F.lit(left) / F.lit(open_) >= limit
        used, closed, n = sources.agg(F.sum(F.when(over, limit)), F.sum(F.when(over, weight)), F.count_if(over)).first()
        if n == full:
            break
        full, left, open_ = n, share * total[0] - (used or 0.0), total[1] - (closed or 0.0)
    if full == total[2]:
        return sources.withColumn("target", limit)
    part = F.lit(left) * weight / F.lit(open_)
    return sources.withColumn("target", F.when(part >= limit, limit).otherwise(part))


def mix_plan(sources: DataFrame, shards: int, share: float = 1.5, most: int = 2, seed: int = 0,
             block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per source: size, target, blocks, and for each run through the source the order of
    its blocks; ``ends`` has the draws up to the end of each shard."""
    size = F.col("source_size")
    blocks = F.least(size, F.greatest(F.lit(LEAST_BLOCKS), F.ceil(size / block_words))).cast("long")
    draws = F.when(size > 0, F.least(most * blocks, F.round(blocks * F.col("target") / size))).otherwise(0)
    planned = cut_lineage(with_targets(sources, share, most).withColumns({"blocks": blocks})
                          .withColumn("draws", draws.cast("long")))
    group = max(LEAST_GROUP, math.isqrt(planned.count()))
    grouped = planned.withColumn("group", F.expr(f"(number - 1) div {group}").cast("long"))
    # About the square root of the number of sources.
    sums = sorted(map(tuple, grouped.groupBy("group").agg(F.sum("draws")).collect()))
    shares = splitting_tree([n for _, n in sums], shards, seed)
    held = planned.sparkSession.createDataFrame(
        [(g, shares[:, i].tolist()) for i, (g, _) in enumerate(sums)], "group long, totals array<long>")

    def deal(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("number", ignore_index=True)
        number = int(rows["group"].iloc[0])
        ends = splitting_tree(rows["draws"].tolist(), shards, hash_seed(seed, number), rows["totals"].iloc[0]).cumsum(axis=0)
        orders = [[_permutation(seed, name, run, max(1, n)) for run in range(most)]
                  for name, n in zip(rows["source_"], rows["blocks"].tolist(), strict=True)]
        return pd.DataFrame({
            "source_": rows["source_"], "source_size": rows["source_size"], "target": rows["target"],
            "blocks": rows["blocks"], "draws": rows["draws"], "factors": [[a for a, _ in o] for o in orders],
            "shifts": [[b for _, b in o] for o in orders], "ends": ends.T.tolist()})

    return cut_lineage(grouped.join(held, "group").groupBy("group").applyInPandas(
        deal, "source_ string, source_size long, target double, blocks long, draws long, "
              "factors array<long>, shifts array<long>, ends array<long>"))


def hash_seed(seed: int, number: int) -> int:
    """A seed of its own for the tree of each group."""
    return int.from_bytes(hashlib.blake2b(repr((seed, number)).encode(), digest_size=6).digest(), "little")


#: Every run and block of a document: the block's place among the source's draws.
_PLACES = """
filter(flatten(transform(sequence(0, size(factors) - 1), run ->
    if(size > 0, transform(sequence(first_block, last_block), block -> named_struct(
        'run', run, 'block', block, 'place',
        run * blocks + pmod(factors[run] * block + shifts[run], blocks))), array()))),
    x -> x.place < draws)"""
#: What of the document lies in a block, and the shard that the block's draw belongs to.
_DRAWS = """
transform(places, x -> named_struct(
    'run', x.run, 'block', x.block, 'shard', size(filter(ends, e -> e <= x.place)),
    'first', greatest(x.block * base + least(x.block, extra), start) - start,
    'words', least((x.block + 1) * base + least(x.block + 1, extra), start + size)
             - greatest(x.block * base + least(x.block, extra), start)))"""


def mix(docs: DataFrame, weights: dict[str | None, float] | DataFrame | None = None, shards: int = 64,
        share: float = 1.5, most: int = 2, seed: int = 0, block_words: int = BLOCK_WORDS,
        text: str = "text", id_col: str = "doc_id", source: str = "source",
        keep: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, size, source_size, target, taken, key, draws``.

    ``draws`` lists what the mix takes of the document: run, block, shard, first word and words. The sum
    of the words is ``taken``; no run takes a word twice. ``weights`` gives a weight for each
    source, as a dictionary or a frame ``source, weight``; without it the sources by code point, null
    last, weigh 3, 1, 2, repeating. There may be any number of sources. A null source is a source; a null or empty text has no words and is never taken; an empty table
    gives an empty mix. ``key`` is a hash of id and text; rows equal in id, source and text are
    interchangeable. The same rows, weights and seed give the same mix on any cluster. ``keep``
    columns come along in a struct ``row``, whatever their names are.
    """
    return _mixed(docs, weights, shards, share, most, seed, block_words, text, id_col, source, keep)[0]


def _mixed(docs: DataFrame, weights: dict[str | None, float] | DataFrame | None = None, shards: int = 64,
           share: float = 1.5, most: int = 2, seed: int = 0, block_words: int = BLOCK_WORDS,
           text: str = "text", id_col: str = "doc_id", source: str = "source",
           keep: Sequence[str] = ()) -> tuple[DataFrame, float]:
    """``mix``, and the words of a shard."""
    columns = [F.col(id_col).alias("doc_id"), F.col(source).cast("string").alias("source"),
               word_count(text).alias("size"),
               F.xxhash64(F.lit(seed), F.col(id_col), F.col(text)).alias("key")]
    sized = cut_lineage(docs.select(*columns))
    plan = mix_plan(weighted_sources(sized, weights), shards, share, most, seed, block_words)
    largest, wanted = (x or 0 for x in plan.agg(F.max("source_size"), F.sum("target")).first())
    bits = min(48, max(0, (largest // RANGE_WORDS).bit_length()))

    hash_range = F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0).cast("long")
    sums = sized.groupBy(F.col("source").alias("_source"), hash_range.alias("_at")).agg(
        F.sum("size").alias("_n"))
    before = Window.partitionBy("_source").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_source", "_at", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(
        "_before"))
    rows = docs.select(*columns, F.struct(*keep).alias("row")) if keep else sized
    local = (Window.partitionBy("source", "_range").orderBy("key", "doc_id")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = (rows.withColumn("_range", hash_range)
              .withColumn("_upto", F.sum("size").over(local))
              .join(offsets, F.col("source").eqNullSafe(F.col("_source"))
                    & (F.col("_range") == F.col("_at")))
              .join(plan, F.col("source").eqNullSafe(F.col("source_")))
              .withColumns({
                  "start": F.col("_before") + F.col("_upto") - F.col("size"),
                  # The first ``extra`` blocks have one word more than the others.
                  "base": F.expr("if(blocks > 0, source_size div blocks, 0)"),
                  "extra": F.expr("if(blocks > 0, source_size % blocks, 0)")}))
    block = "if({0} < extra * (base + 1), {0} div (base + 1), extra + ({0} - extra * (base + 1)) div base)"
    drawn = (placed.withColumn("first_block", F.expr(block.format("start")))
             .withColumn("last_block", F.expr(block.format("(start + size - 1)")))
             .withColumn("places", F.expr(_PLACES)).withColumn("draws", F.expr(_DRAWS)))
    taken = F.expr("aggregate(draws, 0L, (sum, x) -> sum + x.words)")
    return drawn.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"),
                        "key", "draws", *["row"] * bool(keep)), wanted / shards


#: Draws of a run and a shard that follow each other without a gap, joined.
_SPANS = """
aggregate(array_sort(transform(draws, x -> named_struct(
        'run', x.run, 'first', x.first, 'shard', x.shard, 'words', x.words))),
    cast(array() as array<struct<run: int, first: bigint, shard: int, words: bigint>>),
    (done, x) -> if(size(done) > 0 and element_at(done, -1).run = x.run
                    and element_at(done, -1).shard = x.shard
                    and element_at(done, -1).first + element_at(done, -1).words = x.first,
        concat(slice(done, 1, size(done) - 1), array(named_struct(
            'run', x.run, 'first', element_at(done, -1).first, 'shard', x.shard,
            'words', element_at(done, -1).words + x.words))),
        concat(done, array(x))))"""


def _shard_by_shard(docs: DataFrame, text: str, seed: int, options: dict) -> DataFrame:
    """``row``, ``shard`` and the text of each stretch of a document that a run takes for one shard, each
    shard together in an order of its own. A large shard is cut into parts of its order, so that no
    task has to sort it."""
    mixed, per_shard = _mixed(docs, text=text, seed=seed, keep=docs.columns, **options)
    bits = min(32, (int(per_shard) // SHARD_WORDS).bit_length())
    spans = mixed.select("row", "size", "key", F.explode(F.expr(_SPANS)).alias("span"))
    words = F.regexp_extract_all(F.col(f"row.`{text}`"), F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    cut = F.array_join(F.slice(words, (F.col("span.first") + 1).cast("int"),
                               F.col("span.words").cast("int")), "")
    whole = F.col("span.words") == F.col("size")
    order = F.xxhash64(F.lit(seed), "span.shard", "key", "span.run", "span.first")
    return (spans.select("row", F.col("span.shard").alias("shard"), order.alias("_order"),
                         F.when(whole, F.col(f"row.`{text}`")).otherwise(cut).alias("_taken"))
            .withColumn("_part", F.shiftrightunsigned("_order", 64 - bits) if bits else F.lit(0).cast("long"))
            .repartition("shard", "_part").sortWithinPartitions("shard", "_part", "_order"))


def mixed_documents(docs: DataFrame, text: str = "text", seed: int = 0, **options) -> DataFrame:
    """The mix as rows with the columns of ``docs``, shard by shard, each in an order of its own: a
    row for each stretch of a document that a run takes for a shard, its text cut to that stretch where
    that is not the whole document. Documents that the mix does not take are gone, those it takes
    twice come twice. Nulls, empty texts and tables as in ``mix``."""
    spans = _shard_by_shard(docs, text, seed, options)
    return spans.select(*[F.col("_taken").alias(c) if c == text else F.col(f"row.`{c}`").alias(c)
                          for c in docs.columns])


def write_shards(docs: DataFrame, path: str, text: str = "text", id_col: str = "doc_id", seed: int = 0,
                 **options) -> None:
    """The mix as Parquet, one folder per shard, each in the order of ``mixed_documents``: ``doc_id`` and
    the words taken."""
    spans = _shard_by_shard(docs, text, seed, {"id_col": id_col, **options})
    (spans.select("shard", F.col(f"row.`{id_col}`").alias("doc_id"), F.col("_taken").alias("text"))
     .write.partitionBy("shard").parquet(path))
