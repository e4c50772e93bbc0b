"""Byte-level BPE, encoding and decoding.

Each match of the split pattern is encoded by itself. A segment tree over the byte positions of a
match holds at each inner node the position of the leftmost smallest pair rank below it. A merge
takes the position at the root, joins the token there with its right neighbour, and updates the
two or three leaves whose pairs changed, each along one path to the root.

Matches of up to 64 bytes are encoded many at a time, one row of a tree array for each; longer
ones have a tree of their own. Workers keep what they encoded, by pieces between two single spaces.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.llm import pieces
from storeloom.llm.common import slices, unused, whole_text, without

#: No pair: larger than any rank.
NONE = np.int64(1 << 40)
#: Matches up to this many bytes share a tree array.
WIDE = 64
#: Pieces that a worker remembers.
REMEMBERED = pieces.REMEMBERED
#: Bytes of text that are encoded at once; a worker keeps about 0.3 GB with it.
AT_ONCE = 500_000


def pieces_of(text: str) -> list[str]:
    """The pieces of a text, which give it back one after another."""
    found = pieces.Pieces(pa.array([text], pa.string()))
    return [found.distinct[i].decode() for i in found.index.tolist()]


class Ranks:
    """Vocabulary of a rank file: bytes of each id, and the id that each pair of ids merges to."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = [b""] * (max(self.ids.values()) + 1)
        for token, i in self.ids.items():
            self.bytes_of[i] = token
        pairs = {}
        for token, rank in self.ids.items():
            for cut in range(1, len(token)):
                left, right = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.of_byte = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        self.byte_parts = pa.array(self.bytes_of, pa.large_binary())
        self.number_parts = pa.array([f"{i} " for i in range(len(self.bytes_of))], pa.large_string())

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where the two do not merge."""
        key = left << np.int64(32) | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def one(self, data: bytes) -> list[int]:
        """Ids of one match by a tree of its own."""
        n = len(data)
        token = [int(self.of_byte[b]) for b in data]
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        width = 1
        while width < n:
            width *= 2
        none, pairs = int(NONE), self.pairs
        # A node holds rank << 32 | position, so that the smaller number is the leftmost minimum.
        tree = [none << 32] * (2 * width)
        for i in range(n - 1):
            tree[width + i] = pairs.get(token[i] << 32 | token[i + 1], none) << 32 | i
        for k in range(width - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def put(i: int, rank: int) -> None:
            k = width + i
            tree[k] = rank << 32 | i
            while k > 1:
                k >>= 1
                tree[k] = min(tree[2 * k], tree[2 * k + 1])

        while (best := tree[1] >> 32) < none:
            i = tree[1] & 0xFFFFFFFF
            gone = following[i]
            after = following[gone]
            token[i], following[i] = best, after
            if after < n:
                previous[after] = i
                put(i, pairs.get(best << 32 | token[after], none))
            else:
                put(i, none)
            put(gone, none)
            if (before := previous[i]) >= 0:
                put(before, pairs.get(token[before] << 32 | best, none))
        out, i = [], 0
        while i < n:
            out.append(token[i])
            i = following[i]
        return out

    def many(self, matches: list[bytes]) -> list[np.ndarray]:
        """Ids of matches of at most ``WIDE`` bytes, encoded together by width."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(matches)
        lengths = np.array([len(m) for m in matches], np.int64)
        width = 1
        while width <= WIDE:
            group = np.flatnonzero((lengths <= width) & (lengths > width // 2))
            for start in range(0, len(group), 8192):
                some = group[start:start + 8192]
                for i, ids in zip(some.tolist(), self._rows([matches[i] for i in some], width),
                                  strict=True):
                    out[i] = ids
            width *= 2
        return out

    def _rows(self, matches: list[bytes], width: int) -> list[np.ndarray]:
        rows = len(matches)
        length = np.array([len(m) for m in matches], np.int64)
        raw = np.frombuffer(b"".join(m.ljust(width, b"\0") for m in matches), np.uint8)
        token = self.of_byte[raw].reshape(rows, width)
        place = np.arange(width, dtype=np.int64)
        alive = place < length[:, None]
        following = np.broadcast_to(place + 1, (rows, width)).copy()
        previous = np.broadcast_to(place - 1, (rows, width)).copy()
        tree = np.full((rows, 2 * width), NONE << np.int64(8), np.int64)
        if width > 1:
            ranks = self.rank(token[:, :-1].ravel(), token[:, 1:].ravel()).reshape(rows, -1)
            ranks[~alive[:, 1:]] = NONE
            tree[:, width:2 * width - 1] = ranks << np.int64(8) | place[:-1]
            for k in range(width - 1, 0, -1):
                tree[:, k] = np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1])

        def put(at: np.ndarray, i: np.ndarray, rank: np.ndarray) -> None:
            k = width + i
            tree[at, k] = rank << np.int64(8) | i
            for _ in range(width.bit_length() - 1):
                k >>= 1
                tree[at, k] = np.minimum(tree[at, 2 * k], tree[at, 2 * k + 1])

        at = np.arange(rows)
        while True:
            root = tree[at, 1]
            going = root >> np.int64(8) < NONE
            at, root = at[going], root[going]
            if not len(at):
                break
            i, best = root & np.int64(255), root >> np.int64(8)
            gone = following[at, i]
            after = following[at, gone]
            token[at, i], following[at, i], alive[at, gone] = best, after, False
            right = after < length[at]
            previous[at[right], after[right]] = i[right]
            rank = np.full(len(at), NONE)
            rank[right] = self.rank(best[right], token[at[right], after[right]])
            put(at, i, rank)
            put(at, gone, np.full(len(at), NONE))
            before = previous[at, i]
            left = before >= 0
            put(at[left], before[left], self.rank(token[at[left], before[left]], best[left]))
        ends = np.cumsum(alive.sum(axis=1))
        return np.split(token[alive], ends[:-1])


@lru_cache(maxsize=4)
def ranks_of(path: str) -> Ranks:
    return Ranks(path)


class Encoder:
    """Ids of whole texts; pieces that were seen before are looked up."""

    def __init__(self, path: str, pattern: str):
        self.ranks = ranks_of(path)
        self.pattern = regex.compile(pattern)
        self.memory = pieces.Memory()

    def _learn(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that are not known yet, and how many each has; what they are made of is
        encoded once, all together."""
        found = []
        for p in new:
            t = p.decode()
            one = t[1:].isalpha() and (t[0] == " " or t[0].isalpha())
            found.append([p] if one else [m.encode() for m in self.pattern.findall(t)])
        matches: dict[bytes, np.ndarray] = {}
        short = []
        for m in {m for ms in found for m in ms}:
            whole = self.ranks.ids.get(m)
            if whole is not None:
                matches[m] = np.array([whole], np.uint32)
            elif len(m) > WIDE:
                matches[m] = np.array(self.ranks.one(m), np.uint32)
            else:
                short.append(m)
        for m, ids in zip(short, self.ranks.many(short), strict=True):
            matches[m] = ids.astype(np.uint32)
        parts = [matches[m] for ms in found for m in ms]
        ends = np.cumsum([0, *map(len, parts)])
        of = np.cumsum([0, *map(len, found)])
        return np.concatenate(parts), np.diff(ends[of])

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts, and the place of each text's first id."""
        return self.memory.encode(column, self._learn, REMEMBERED)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids, bounds = self.encode_column(pa.array(texts, pa.string()))
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


@lru_cache(maxsize=4)
def encoder_of(path: str, pattern: str) -> Encoder:
    """One encoder for each worker, which later tasks of the same worker use again."""
    return Encoder(path, pattern)


def decode(ids: np.ndarray, vocabulary: list[bytes]) -> bytes:
    return b"".join([vocabulary[i] for i in ids.tolist()])


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text",
                     keep: list[str] | None = None) -> DataFrame:
    """``keep`` (``doc_id`` by default) with ``ids``: the ids of each whole text.

    A null or empty text has no ids; repeated rows are encoded alike, one by one; a very long text is a
    batch of its own. An empty table gives no rows. A result column takes the place of a kept one
    of its name.
    """
    def lists(ids: np.ndarray, bounds: np.ndarray, _) -> list[pa.Array]:
        return [pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))]

    return _encoded(docs, path, pattern, text, keep, "ids array<int>", ["ids"], lists)


def _joined(parts: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> tuple[memoryview, list[int]]:
    """The parts that the ids stand for one after another, and where each text's ones begin."""
    taken = parts.take(pa.array(ids))
    _, offsets, data = taken.buffers()
    places = np.frombuffer(offsets, np.int64)[taken.offset:taken.offset + len(taken) + 1]
    return memoryview(data or b""), places[bounds].tolist()


def encoding_digests(docs: DataFrame, path: str, pattern: str, text: str = "text",
                     keep: list[str] | None = None) -> DataFrame:
    """As ``encode_documents``, with digests of the ids and of the bytes decoded from them."""
    def digests(ids: np.ndarray, bounds: np.ndarray, ranks: Ranks) -> list[pa.Array]:
        numbers, n = _joined(ranks.number_parts, ids, bounds)
        decoded, d = _joined(ranks.byte_parts, ids, bounds)
        sha = hashlib.sha256
        return [pa.array(np.diff(bounds), pa.int64()),
                # Each number has a space after it, the last one of a text too many.
                pa.array([sha(numbers[a:max(a, b - 1)]).hexdigest() for a, b in zip(n, n[1:], strict=False)],
                         pa.string()),
                pa.array([sha(decoded[a:b]).hexdigest() for a, b in zip(d, d[1:], strict=False)], pa.string())]

    return _encoded(docs, path, pattern, text, keep,
                    "n_tokens long, ids_sha256 string, decoded_sha256 string",
                    ["n_tokens", "ids_sha256", "decoded_sha256"], digests)


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids",
                     keep: list[str] | None = None) -> DataFrame:
    """``keep`` with ``text``: the text that the ids stand for; null ids give an empty text."""
    kept = without(["doc_id"] if keep is None else keep, ["text"])

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = ranks_of(path).bytes_of
        for batch in batches:
            texts = [decode(np.array(x or [], np.int64), vocabulary).decode("utf-8", "replace")
                     for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string())], [*kept, "text"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*kept).schema)
    return encoded.select(*kept, F.col(ids).alias(unused("_ids", kept))).mapInArrow(back, f"{kinds}, text string")


def _encoded(docs, path, pattern, text, keep, schema, names, columns) -> DataFrame:
    kept = without(["doc_id"] if keep is None else keep, names)
    body = unused("_text", kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, pattern)
        for batch in slices(batches, body, AT_ONCE):
            ids, bounds = encoder.encode_column(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *columns(ids, bounds, encoder.ranks)], [*kept, *names])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    return docs.select(*kept, whole_text(text).alias(body)).mapInArrow(run, f"{kinds}, {schema}")
