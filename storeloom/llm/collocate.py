"""Phrase collocations by prefix-free parsing.

Each text is cut where the hash of a few words is a multiple of a number, so that equal passages
are cut alike in all documents. A chunk reaches over the window that starts the next one; the distinct chunks
are a dictionary, and how often each occurs is its parse frequency. Phrases are counted inside
distinct chunks only, weighted by that frequency. The windows where chunks overlap are in
both, so a phrase belongs to the chunk that owns its first word.

Counts go up by length: words first, then pairs of frequent words, then longer phrases of which every
pair is frequent. What is frequent is known from a bitmap of hashes with a fixed largest size; hashes
that share a bit cost rows, not correctness, because the last pass counts the phrases themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.llm.common import slices, whole_text
from storeloom.operators.ordered import ordered_scan
from storeloom.session import cut_lineage

#: A chunk starts at one window in so many.
ONE_IN = 32
#: Bits for each frequent phrase, and in all (32 MB, what is broadcast at most).
BITS_EACH, MOST_BITS = 16, 1 << 28
UNKNOWN = "und"
_BLANK, _BREAK = 32, 10
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32
_FOLDED[list(b".,;:!?\n\x0b\x0c\r")] = _BREAK
_FOLDED[9] = _BLANK
_SOLID = np.ones(256, bool)
_SOLID[[_BLANK, _BREAK]] = False
_MULTIPLIER = 0x9E3779B97F4A7C15
#: Bytes whose powers are kept at once.
_SPAN = 1 << 21


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads what differs between hashes over all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    def upto(base: int) -> np.ndarray:
        factors = np.full(_SPAN, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)

    return upto(_MULTIPLIER), upto(pow(_MULTIPLIER, -1, 1 << 64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each word's bytes: differences of running polynomial sums, over as many words
    as fit into a span of bytes at a time."""
    out = np.empty(len(starts), np.uint64)
    powers, inverse = _powers()
    lo = 0
    while lo < len(starts):
        first = int(starts[lo])
        hi = int(np.searchsorted(ends, first + _SPAN, "right"))
        if hi == lo:  # one word longer than the span
            out[lo] = xxhash.xxh64_intdigest(data[first:int(ends[lo])].tobytes())
            lo += 1
            continue
        part = data[first:int(ends[hi - 1])].astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * powers[:len(part)], dtype=np.uint64)])
        a, b = starts[lo:hi] - first, ends[lo:hi] - first
        out[lo:hi] = (sums[b] - sums[a]) * inverse[a]
        lo = hi
    return mixed(out)


class Words:
    """The words of a column of texts: where they are, of which row, and where pieces end."""

    def __init__(self, column: pa.Array):
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
        raw = np.frombuffer(data or b"", np.uint8)[offsets[0]:offsets[-1]]
        self.data = _FOLDED[raw]
        bounds = offsets.astype(np.int64) - int(offsets[0])
        solid = _SOLID[self.data]
        inner = bounds[(bounds > 0) & (bounds < len(raw))]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        first[inner] = solid[inner]
        last = solid.copy()
        last[:-1] &= ~solid[1:]
        last[inner - 1] = solid[inner - 1]
        self.solid = solid
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.rows = np.searchsorted(bounds, self.starts, "right") - 1
        #: After which words a piece ends.
        breaks = np.flatnonzero(self.data == _BREAK)
        self.stops = np.ones(len(self.starts), bool)
        self.stops[:-1] = (self.rows[1:] != self.rows[:-1]) | (
            np.searchsorted(breaks, self.starts[1:]) > np.searchsorted(breaks, self.ends[:-1]))
        self.hashes = word_hashes(self.data, self.starts, self.ends)
        #: Number of words of a row before each of its words.
        new = np.ones(len(self.rows), bool)
        new[1:] = self.rows[1:] != self.rows[:-1]
        heads = np.flatnonzero(new)
        self.heads = heads
        self.within = np.arange(len(self.rows)) - np.repeat(heads, np.diff(np.append(heads, len(self.rows))))


def chunks_of(words: Words, overlap: int, one_in: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Chunks in a normal form (words apart by a space, pieces by a line feed), the number of
    words that each owns, and its row."""
    n = len(words.starts)
    if not n:
        return [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    window = words.hashes.copy()
    for k in range(1, overlap):
        window[:n - k] = window[:n - k] * np.uint64(_MULTIPLIER) + words.hashes[k:]
    starts = mixed(window) % np.uint64(one_in) == 0
    starts[max(0, n - overlap + 1):] = False
    whole = n - overlap + 1
    if whole > 0:
        starts[:whole] &= words.rows[:whole] == words.rows[overlap - 1:]
    starts[words.heads] = True
    starts = np.flatnonzero(starts)
    ends = np.append(starts[1:], n)
    last = np.append(words.rows[starts[1:]] != words.rows[starts[:-1]], True)
    upto = np.where(last, ends, ends + overlap)

    lengths = words.ends - words.starts + 1
    after = np.cumsum(lengths)
    out = np.empty(int(after[-1]), np.uint8)
    gaps = np.zeros(len(out), bool)
    gaps[after - 1] = True
    out[~gaps] = words.data[words.solid]
    out[after - 1] = np.where(words.stops, _BREAK, _BLANK)
    body = out.tobytes()
    begin = (after - lengths)[starts].tolist()
    end = (after[upto - 1] - 1).tolist()
    return [body[a:b] for a, b in zip(begin, end, strict=True)], ends - starts, words.rows[starts]


def spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    """The bytes from each start to its end, which may overlap."""
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    at = np.arange(int(offsets[-1])) + np.repeat(starts - offsets[:-1], lengths)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[at])]).cast(pa.binary())


def dictionary(docs: DataFrame, text: str, lang: str, overlap: int, one_in: int) -> DataFrame:
    """Distinct chunks of each language with their parse frequency."""
    kinds = pa.schema([("lang", pa.string()), ("chunk", pa.string()), ("owned", pa.int64())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            chunks, owned, rows = chunks_of(Words(batch.column(1)), overlap, one_in)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(chunks, pa.binary()).cast(pa.string()),
                 pa.array(owned, pa.int64())], schema=kinds)

    cut = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("_lang"),
                      whole_text(text).alias("_text")).mapInArrow(parse, "lang string, chunk string, owned long")
    return cut_lineage(cut.groupBy("lang", "chunk", "owned").agg(F.count("*").alias("weight")))


class Grams:
    """Phrases inside a batch of the dictionary: hashes by length, and which may be frequent."""

    def __init__(self, batch: pa.RecordBatch, frequent: list[np.ndarray]):
        salt, chunk, owned, weight = (batch.column(k) for k in range(4))
        self.words = words = Words(chunk)
        n = len(words.starts)
        owned, weight, salt = (c.to_numpy(zero_copy_only=False) for c in (owned, weight, salt))
        self.mine = words.within < owned[words.rows]
        self.weights = weight[words.rows]
        self.salts = salt[words.rows].astype(np.uint64)
        #: How many words there are from each word to the end of its piece.
        stops = np.flatnonzero(words.stops)
        self.room = stops[np.searchsorted(stops, np.arange(n))] - np.arange(n) + 1
        self.hashes = mixed(words.hashes ^ mixed(self.salts))
        self.alive = np.ones(n, bool)
        self.frequent = frequent
        self.length = 1

    def known(self) -> np.ndarray:
        """Places whose phrase of the present length may be frequent, as far as that is known."""
        if self.length > len(self.frequent):
            return self.alive
        bits = self.frequent[self.length - 1]
        at = self.hashes & np.uint64(8 * len(bits) - 1)
        return self.alive & ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)

    def lengthen(self) -> None:
        """To phrases one word longer, alive where both parts may be frequent."""
        known, k = self.known(), self.length
        self.length = k + 1
        n = len(known)
        self.alive = known & (self.room > k)
        self.alive[:-1] &= known[1:]
        if n > k:
            self.hashes[:n - k] = mixed(
                self.hashes[:n - k] * np.uint64(_MULTIPLIER) + self.words.hashes[k:])


def _frequent(parsed: DataFrame, known: list[np.ndarray], upto: int, least: int) -> list[np.ndarray]:
    """Bitmaps of the phrases that occur ``least`` times at least, for lengths after those ``known`` to
    ``upto``, from one pass over the dictionary."""
    shared = parsed.sparkSession.sparkContext.broadcast(known)
    kinds = pa.schema([("k", pa.int32()), ("hash", pa.int64()), ("f", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "chunk", 1 << 23):
            grams = Grams(batch, shared.value)
            for k in range(1, upto + 1):
                if k > len(shared.value):
                    here = grams.alive & grams.mine
                    found = pa.table([pa.array(grams.hashes[here].view(np.int64)), pa.array(grams.weights[here])],
                                     ["hash", "f"]).group_by("hash", use_threads=False).aggregate([("f", "sum")])
                    for part in found.to_batches():
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(part.num_rows, k, np.int32)), part.column("hash"),
                             part.column("f_sum")], schema=kinds)
                if k < upto:
                    grams.lengthen()

    hashes = cut_lineage(parsed.mapInArrow(count, "k int, hash long, f long").groupBy("k", "hash").agg(
        F.sum("f").alias("f")).where(F.col("f") >= least).select("k", "hash"))
    return [_bitmap(hashes.where(F.col("k") == k)) for k in range(len(known) + 1, upto + 1)]


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """One bit for each hash, by its lowest bits, in a map whose size follows their number up to
    ``MOST_BITS``. Built in Spark; the driver gets the map only."""
    size = 1 << 15
    wanted = BITS_EACH * hashes.count()
    while size < min(wanted, MOST_BITS):
        size *= 2
    bit = F.col("hash").bitwiseAND(F.lit(size - 1)) + 1
    bits = np.zeros(size // 8, np.uint8)
    parts = hashes.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    for part, found in parts.toLocalIterator():
        start = (part - 1) * 4096
        bits[start:start + 4096] = np.frombuffer(found, np.uint8)
    return bits


def _phrases(parsed: DataFrame, frequent: list[np.ndarray], least: int) -> DataFrame:
    """``lang, phrase, k, f``: exact counts of all phrases that occur ``least`` times at least."""
    shared = parsed.sparkSession.sparkContext.broadcast(frequent)
    kinds = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("k", pa.int32()), ("f", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "chunk", 1 << 23):
            grams = Grams(batch, shared.value)
            words = grams.words
            langs = batch.column(4).dictionary_encode()
            for k in range(1, len(shared.value) + 1):
                at = np.flatnonzero(grams.known() & grams.mine)
                found = spans(words.data, words.starts[at], words.ends[at + k - 1]).dictionary_encode()
                # One number for language and phrase.
                lang_of = langs.indices.to_numpy(zero_copy_only=False)[words.rows[at]].astype(np.int64)
                pairs = lang_of * len(found.dictionary) + found.indices.to_numpy(zero_copy_only=False)
                counted = pa.table([pa.array(pairs), pa.array(grams.weights[at])], ["pair", "f"]).group_by(
                    "pair", use_threads=False).aggregate([("f", "sum")])
                for part in counted.to_batches():
                    pair = part.column("pair").to_numpy(zero_copy_only=False)
                    size = max(1, len(found.dictionary))
                    yield pa.RecordBatch.from_arrays(
                        [langs.dictionary.take(pa.array(pair // size)),
                         found.dictionary.take(pa.array(pair % size)).cast(pa.string()),
                         pa.array(np.full(len(pair), k, np.int32)), part.column("f_sum")], schema=kinds)
                if k < len(shared.value):
                    grams.lengthen()

    return cut_lineage(parsed.mapInArrow(count, "lang string, phrase string, k int, f long").groupBy(
        "lang", "phrase", "k").agg(F.sum("f").alias("f")).where(F.col("f") >= least))


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 5,
                     least: int = 100, one_in: int = ONE_IN) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, k, f`` of phrases of up to ``longest`` words that occur ``least`` times at
    least, overlaps included, and ``lang, n`` with the number of all words."""
    parse = dictionary(docs, text, lang, longest - 1, one_in)
    parsed = parse.select(F.xxhash64("lang").alias("salt"), "chunk", "owned", "weight", "lang")
    frequent: list[np.ndarray] = []
    for upto in sorted({1, min(2, longest), longest}):
        frequent += _frequent(parsed, frequent, upto, least)
    totals = parse.groupBy("lang").agg(F.sum(F.col("owned") * F.col("weight")).alias("n"))
    return _phrases(parsed, frequent, least), totals


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 5,
                 least: int = 100, absorbed: int = 100, top: int = 2000,
                 one_in: int = ONE_IN) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases.

    Texts are lower-cased in A-Z and split at ``.,;:!?`` and line ends into pieces, those at
    spaces and tabs into words; phrases of 2 to ``longest`` words lie in one piece. A phrase that occurs
    ``a >= least`` times is a candidate. Cut into two parts that occur ``l`` and ``r`` times it scores
    floor(1000 * a * n / (l * r)); its lowest cut counts, ties to the earlier one. A candidate is
    dropped if a longer one that holds it occurs ``absorbed`` percent of ``a`` or more. Order: score, a, both
    falling, then the phrase's bytes.

    A null language is ``und``, null and empty texts have no words, repeated rows count each time,
    texts are read whole whatever their length; an empty table gives no rows. Other columns are not
    read. Numbers are exact while 1000 * a * n has up to 38 digits.
    """
    found, totals = frequent_phrases(docs, text, lang, longest, least, one_in)
    parts = F.split("phrase", " ")
    candidates = found.where("k > 1").withColumnRenamed("f", "a")

    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    cuts = candidates.select("lang", "phrase", "a", parts.alias("w"), "k", cut).select(
        "lang", "phrase", "a", "cut", F.concat_ws(" ", F.slice("w", 1, F.col("cut"))).alias("head"),
        F.concat_ws(" ", F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut"))).alias("rest"))
    heads = found.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rests = found.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))

    score = F.expr("cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0))"
                   " div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))")
    scored = (cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"])
              .join(totals, "lang").withColumn("score", score)
              .groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best")))

    # What holds a phrase and is longer holds one that is longer by a single word and no rarer.
    inner = candidates.where("k > 2").select("lang", "a", F.explode(F.array(
        F.expr("substring_index(phrase, ' ', k - 1)"),
        F.expr("substring_index(phrase, ' ', 1 - k)"))).alias("phrase"))
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("held"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(
        F.col("held").isNull() | (100 * F.col("held") < absorbed * F.col("a"))).select(
        "lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n",
        F.col("best.score").alias("score"))

    # Numbered in range partitions of (lang, order): no task sorts a language.
    ranked = ordered_scan(kept, [F.desc("score"), F.desc("a"), "phrase"], number="rank", within=["lang"])
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
