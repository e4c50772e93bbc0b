"""N-gram Jaccard join by bands of minimum hashes, with verification.

A text is the set of its runs of five words, by 64-bit hashes of the runs; similarities are exact on these.
Texts with equal sets are one representative, which counts as often as it occurs. Each band ("trie") is
the first ``d`` of a sequence of minimum hashes of its own; texts of similarity ``s`` agree in some
band with chance ``1 - (1 - s**d)**tries``. ``d`` is the longest that reaches the target recall at the
least similarity, one length for all texts: this is plain banding, not the forest of sorted tries that
shortens prefixes where the data asks for it. What agrees in a band is a node.

Equal nodes of several tries are one, and a pair is looked at in the first trie that brings it
together. Nodes are cut into blocks of bounded size, and a task meets two blocks: large nodes
are spread over many tasks, pairs are counted where they are verified and never become rows. What leaves
a task is one row per representative: how many texts it links to there, and the least
representative of its part of the node, from which connected classes are put together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storeloom.llm.common import slices, texts_of
from storeloom.session import cut_lineage

SIMILARITY = 0.8
WORDS = 5
TRIES = 16
#: Hashes in a trie's string, before prefixes are shortened.
DEPTH = 6
RECALL = 0.9999
#: Representatives of a block; a task holds two blocks at most.
BLOCK = 512
#: Word hashes that a worker remembers before it starts anew.
REMEMBERED = 250_000
_FACTORS = np.random.default_rng(7).integers(1, 1 << 63, TRIES * DEPTH, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = np.random.default_rng(8).integers(0, 1 << 63, TRIES * DEPTH, np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_GROUP = ("trie", "node", "low", "high")


def prefix_length(similarity: float = SIMILARITY, tries: int = TRIES, depth: int = DEPTH,
                  recall: float = RECALL) -> int:
    """The longest prefix that reaches the target recall for texts of the least similarity."""
    while depth > 1 and 1 - (1 - similarity ** depth) ** tries < recall:
        depth -= 1
    return depth


_word_hashes: dict[bytes, int] = {}


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct runs of words; a shorter text is one run, one without a word none."""
    found = text.encode().split()
    if not found:
        return np.zeros(0, np.uint64)
    known = _word_hashes
    if len(known) > REMEMBERED:
        known.clear()
    for w in set(found).difference(known):
        known[w] = xxhash.xxh64_intdigest(w)
    ids = np.array([known[w] for w in found], np.uint64)
    width = min(words, len(ids))
    out = np.full(len(ids) - width + 1, width, np.uint64)
    for k in range(width):
        out = (out ^ ids[k:len(ids) - width + 1 + k]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def forest_keys(found: np.ndarray, length: int) -> np.ndarray:
    """The node of each trie at prefixes of ``length`` hashes."""
    use = np.arange(TRIES)[:, None] * DEPTH + np.arange(length)
    factors, shifts = _FACTORS[use.ravel()], _SHIFTS[use.ravel()]
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(found), 4096):
        part = found[start:start + 4096, None] * factors + shifts
        np.minimum(least, part.min(axis=0), out=least)
    least = least.reshape(TRIES, length)
    keys = np.arange(TRIES, dtype=np.uint64)
    for k in range(length):
        keys = (keys ^ least[:, k]) * _MIX
        keys ^= keys >> np.uint64(31)
    return keys.view(np.int64)


def set_key(found: np.ndarray) -> bytes | None:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None


def signatures(docs: DataFrame, text: str, id_col: str, length: int) -> DataFrame:
    """``doc_id, text_key, set_key, nodes, keys`` of every row, the last three null without a word;
    ``keys`` holds the nodes as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            sets = [shingles(t) for t in texts_of(batch, "_text")]
            nodes = [forest_keys(s, length) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(map(set_key, sets), pa.binary()),
                 pa.array(nodes, pa.list_(pa.int64())),
                 pa.array([None if x is None else x.tobytes() for x in nodes], pa.binary())],
                ["doc_id", "text_key", "set_key", "nodes", "keys"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"),
                       F.col(text).alias("_text")).mapInArrow(
        run, "doc_id long, text_key long, set_key binary, nodes array<long>, keys binary")


def shingle_sets(docs: DataFrame, text: str) -> DataFrame:
    """``set_key, shingles`` of every row that has a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            sets = [s for s in map(shingles, texts_of(batch, text)) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(set_key, sets), pa.binary()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], ["set_key", "shingles"])

    return docs.select(text).mapInArrow(run, "set_key binary, shingles binary")


def _by_group(df: DataFrame, columns: list[str], meet: Callable[[int, list[tuple]], Iterator[tuple]],
              schema: str, arrow: pa.Schema) -> DataFrame:
    """Rows of each group (two blocks of a node) through ``meet``, which gets the trie and the rows as
    tuples: their block and ``columns``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, out = None, [], []
        for batch in batches:
            names = list(zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True))
            values = zip(*(batch.column(k).to_pylist() for k in range(4, batch.num_columns)), strict=True)
            for name, value in zip(names, values, strict=True):
                if name != group:
                    if len(rows) > 1:
                        out += meet(group, rows)
                    group, rows = name, []
                    if len(out) > 5000:
                        yield _table(out, arrow)
                        out = []
                rows.append(value)
        if len(rows) > 1:
            out += meet(group, rows)
        if out:
            yield _table(out, arrow)

    return (df.select(*_GROUP, "block", *columns).repartition(*_GROUP)
            .sortWithinPartitions(*_GROUP, "set_key").mapInArrow(run, schema))


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _first_met(group: tuple, rows: list[tuple]) -> np.ndarray:
    """Which pairs of rows belong to this group: of its two blocks (once, for a block with itself), and
    not together in an earlier trie."""
    trie, _, low, high = group
    block = np.array([r[0] for r in rows])
    keys = np.array([np.frombuffer(r[2], np.int64) for r in rows])
    if low == high:
        pairs = np.triu(np.ones((len(rows), len(rows)), bool), 1)
    else:
        pairs = (block == low)[:, None] & (block == high)[None, :]
    for t in range(trie):
        pairs &= keys[:, t][:, None] != keys[:, t][None, :]
    return pairs


def _useful(group: tuple, rows: list[tuple]) -> Iterator[tuple]:
    """The rows that have a pair here."""
    pairs = _first_met(group, rows)
    some = pairs.any(axis=0) | pairs.any(axis=1)
    for i in np.flatnonzero(some).tolist():
        yield (*group, rows[i][0], rows[i][1], rows[i][2])


def common(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Numbers of hashes that each two of the sets share."""
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    keep = shared[at]
    of, at = of[keep], number[at[keep]]
    out = np.zeros((len(sets), len(sets)), np.int64)
    order = np.argsort(at, kind="stable")
    of, at = of[order], at[order]
    for start in range(0, int(at[-1]) + 1 if len(at) else 0, width):
        first, last = np.searchsorted(at, [start, start + width])
        held = np.zeros((len(sets), width), np.float32)
        held[of[first:last], at[first:last] - start] = 1
        out += (held @ held.T).astype(np.int64)
    return out


def _linked(similarity: float) -> Callable[[tuple, list[tuple]], Iterator[tuple]]:
    def meet(group: tuple, rows: list[tuple]) -> Iterator[tuple]:
        sets = [np.frombuffer(r[4], np.uint64) for r in rows]
        sizes = np.array([len(s) for s in sets])
        both = common(sets)
        links = _first_met(group, rows) & (
            both >= similarity * (sizes[:, None] + sizes[None, :] - both) - 1e-9)
        links |= links.T
        copies = np.array([r[3] for r in rows])
        partners = links @ copies
        root = np.arange(len(rows))  # rows are in the order of their keys
        while True:
            near = np.where(links, root[None, :], len(rows)).min(axis=1)
            new = np.minimum(root, near)
            new = np.minimum(new, new[new])
            if (new == root).all():
                break
            root = new
        for i in np.flatnonzero(partners).tolist():
            yield rows[i][1], int(partners[i]), rows[int(root[i])][1]

    return meet


def components(edges: DataFrame) -> DataFrame:
    """``set_key, label`` of every vertex of ``edges`` (``set_key, root``): the least vertex that it is
    connected with. Every round takes the least label around a vertex and then that vertex's
    own label; a round's labels are a stored table."""
    pairs = edges.where("set_key != root")
    both = cut_lineage(pairs.union(pairs.select("root", "set_key")).distinct().select(
        F.col("set_key").alias("u"), F.col("root").alias("v")))
    labels = both.groupBy("u").agg(F.min("v").alias("near")).select(
        F.col("u").alias("set_key"), F.least("u", "near").alias("label"))
    labels = cut_lineage(labels)
    while True:
        around = both.join(labels, F.col("v") == F.col("set_key")).groupBy("u").agg(
            F.min("label").alias("near"))
        least = labels.join(around, F.col("set_key") == F.col("u")).select(
            "set_key", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        hop = labels.select(F.col("set_key").alias("at"), F.col("label").alias("beyond"))
        new = cut_lineage(least.join(hop, F.col("label") == F.col("at"), "left").select(
            "set_key", F.least("label", F.coalesce("beyond", "label")).alias("label"), "old"))
        if new.where("label != old").isEmpty():
            return new.select("set_key", "label")
        labels = new.select("set_key", "label")


def join(docs: DataFrame, text: str = "text", id_col: str = "doc_id",
         similarity: float = SIMILARITY, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, class_id, n_links, text_key, first``.

    ``n_links`` is the number of other rows whose sets of five-word runs have a Jaccard similarity of at
    least ``similarity``, copies included. ``class_id`` is the least ``doc_id`` among the rows
    connected by links, and ``first`` is true for the rows with that id and the least text hash. A
    text of fewer than five words is one run. A null text, or one without a word, links to nothing and
    is its own class. Null ids come after all others; repeated rows are copies of each other. An empty
    table gives no rows. Very long texts are read whole; other columns may have any name.
    """
    length = prefix_length(similarity, TRIES, DEPTH, recall)
    signed = cut_lineage(signatures(docs, text, id_col, length))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_key"))
    reps = cut_lineage(signed.where(F.col("set_key").isNotNull()).groupBy("set_key").agg(
        least.alias("first"), F.count("*").alias("n"), F.any_value("nodes").alias("nodes"),
        F.any_value("keys").alias("keys")))

    placed = reps.select("set_key", F.posexplode("nodes").alias("trie", "node"))
    one = (F.xxhash64("set_key"), F.xxhash64("set_key", F.lit(1)))
    nodes = (placed.groupBy("trie", "node")
             .agg(F.count("*").alias("c"), *[F.bit_xor(x).alias(f"x{k}") for k, x in enumerate(one)])
             .where("c > 1").groupBy("c", "x0", "x1").agg(F.min(F.struct("trie", "node")).alias("at"))
             .select("at.trie", "at.node", F.ceil(F.col("c") / block).cast("int").alias("blocks")))
    members = (placed.join(nodes, ["trie", "node"])
               .withColumn("block", F.pmod(F.xxhash64("set_key", F.lit(2)), "blocks").cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
               .select("trie", "node", F.least("block", "other").alias("low"),
                       F.greatest("block", "other").alias("high"), "block", "set_key"))
    kinds = [("trie", pa.int32()), ("node", pa.int64()), ("low", pa.int32()), ("high", pa.int32()),
             ("block", pa.int32()), ("set_key", pa.binary()), ("keys", pa.binary())]
    useful = cut_lineage(_by_group(
        members.join(reps.select("set_key", "keys"), "set_key"), ["set_key", "keys"], _useful,
        "trie int, node long, low int, high int, block int, set_key binary, keys binary",
        pa.schema(kinds)))

    needed = useful.select("set_key").distinct().join(reps, "set_key").select(
        F.col("first.doc_id").alias("_id"), F.col("first.text_key").alias("_key"))
    texts = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"),
                         F.col(text).alias("_text"))
             .join(needed, F.col("doc_id").eqNullSafe(F.col("_id"))
                   & (F.col("text_key") == F.col("_key")), "left_semi"))
    sets = shingle_sets(texts, "_text").groupBy("set_key").agg(F.any_value("shingles").alias("shingles"))
    sets = sets.join(reps.select("set_key", "n"), "set_key")
    linked = cut_lineage(_by_group(
        useful.join(sets, "set_key"), ["set_key", "keys", "n", "shingles"], _linked(similarity),
        "set_key binary, links long, root binary",
        pa.schema([("set_key", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])))

    counts = linked.groupBy("set_key").agg(F.sum("links").alias("links"))
    labels = components(linked.select("set_key", "root").distinct())
    known = reps.select("set_key", "first", "n").join(counts, "set_key", "left").join(
        labels, "set_key", "left")
    known = cut_lineage(known.select("set_key", "first", "n", F.coalesce("links", F.lit(0)).alias("links"),
                                     F.coalesce("label", "set_key").alias("label")))
    classes = known.groupBy("label").agg(F.min("first").alias("of_class"))
    final = known.join(classes, "label").select(
        F.col("set_key").alias("_set"), (F.col("links") + F.col("n") - 1).alias("n_links"), "of_class")
    lone = F.col("set_key").isNull()
    return signed.join(final, F.col("set_key") == F.col("_set"), "left").select(
        "doc_id", F.when(lone, F.col("doc_id")).otherwise(F.col("of_class.doc_id")).alias("class_id"),
        F.when(lone, 0).otherwise(F.col("n_links")).cast("long").alias("n_links"), "text_key",
        F.when(lone, True).otherwise(
            F.col("doc_id").eqNullSafe(F.col("of_class.doc_id"))
            & (F.col("text_key") == F.col("of_class.text_key"))).alias("first"))


def keep_first(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each class of the join: of the rows with the class's id and the least text
    hash, one. Rows without a word stay."""
    found = join(docs, text, id_col).where("first").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("long").alias("_doc"),
                        F.xxhash64(text).alias("_text"),
                        (~F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))).alias("_bare"))
    one = Window.partitionBy("_doc", "_text").orderBy("_bare")
    kept = (keyed.where("not _bare").join(found, F.col("_doc").eqNullSafe(F.col("_id"))
                                          & (F.col("_text") == F.col("_key")), "left_semi")
            .withColumn("_at", F.row_number().over(one)).where("_at = 1").select("row"))
    return kept.union(keyed.where("_bare").select("row")).select(
        *[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
