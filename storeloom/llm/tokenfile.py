"""Token ids as directly addressable codes, in files of one folder in ascending id order.

A file holds segments of 2**20 ids (the last is shorter). In a segment every id is cut into
chunks of eight bits, the lowest first. Level 0 has the first chunk of every id, level 1 the second
chunk of those that need one, and so on. Below the top level a bitmap tells which chunks go on in
the next level, and a rank directory holds how many do before every 512th chunk. Chunk ``i``
of a level then goes on at chunk ``rank(i)`` of the next, so any id is read without decoding others.

Layout, little-endian: ``DAC1``; the segments; the directory (ids of the documents as int64, one
byte for each that is 1 unless the id is null, first token of each document in the file as
int64); segment offsets as int64; then segments, documents and tokens as int64, the offset
of the directory as int64, and ``DAC1``.
A segment: ids, levels as uint32; for each level the number of chunks as uint32, the chunks, and below
the top level the bitmap (lowest bit first) and the directory as uint32.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyarrow import fs as files
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom.llm import pieces
from storeloom.llm.common import slices, whole_text

MAGIC = b"DAC1"
SEGMENT = 1 << 20
BLOCK = 512
#: Pieces that a worker remembers; they are all that it holds for long.
REMEMBERED = 600_000
#: Letters of matches that the library's model gets at once, and one match more.
TOGETHER = 1024
_TAIL = struct.Struct("<qqqq4s")


def segment_bytes(ids: np.ndarray) -> bytes:
    """One segment of at most ``SEGMENT`` ids."""
    out, rest = [], ids.astype(np.uint32)
    levels = []
    while True:
        chunks, rest = (rest & 255).astype(np.uint8), rest >> np.uint32(8)
        more = rest > 0
        if not more.any():
            levels.append((chunks, None))
            break
        levels.append((chunks, more))
        rest = rest[more]
    out.append(struct.pack("<II", len(ids), len(levels)))
    for chunks, more in levels:
        out += [struct.pack("<I", len(chunks)), chunks.tobytes()]
        if more is not None:
            sums = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.int64)
            ranks = np.cumsum(sums) - sums
            out += [np.packbits(more, bitorder="little").tobytes(), ranks.astype(np.uint32).tobytes()]
    return b"".join(out)


class Segment:
    """Reads single ids or runs of ids of a segment."""

    def __init__(self, data: bytes):
        self.n, count = struct.unpack_from("<II", data)
        at, self.levels = 8, []
        for level in range(count):
            (n,) = struct.unpack_from("<I", data, at)
            chunks = np.frombuffer(data, np.uint8, n, at + 4)
            at += 4 + n
            bits = ranks = None
            if level < count - 1:
                bits = np.frombuffer(data, np.uint8, -(-n // 8), at)
                at += len(bits)
                ranks = np.frombuffer(data, np.uint32, -(-n // BLOCK), at)
                at += 4 * len(ranks)
            self.levels.append((chunks, bits, ranks))

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Chunks before chunk ``i`` that go on."""
        block = i // BLOCK
        if block == len(ranks):
            block -= 1
        first = block * BLOCK // 8
        within = np.unpackbits(bits[first:-(-i // 8)], bitorder="little")[:i - block * BLOCK]
        return int(ranks[block]) + int(within.sum())

    def token(self, i: int) -> int:
        out = shift = 0
        for chunks, bits, ranks in self.levels:
            out |= int(chunks[i]) << shift
            if bits is None or not bits[i >> 3] >> (i & 7) & 1:
                break
            i, shift = self._rank(bits, ranks, i), shift + 8
        return out

    def run(self, start: int, end: int) -> np.ndarray:
        """The ids from ``start`` to before ``end``."""
        out = np.zeros(end - start, np.uint32)
        where, shift = np.arange(end - start), 0
        for chunks, bits, ranks in self.levels:
            out[where] |= chunks[start:end].astype(np.uint32) << np.uint32(shift)
            if bits is None or start == end:
                break
            first = start >> 3
            more = np.unpackbits(bits[first:-(-end // 8)], bitorder="little")[
                start - 8 * first:end - 8 * first].astype(bool)
            where = where[more]
            start = self._rank(bits, ranks, start)
            end, shift = start + len(where), shift + 8
        return out


class TokenFile:
    """One file: its documents, and the ids at any place. Segments are read when first needed."""

    def __init__(self, path: str):
        system, place = files.FileSystem.from_uri(path)
        self.file = system.open_input_file(place)
        size = self.file.size()
        segments, documents, self.tokens, at, magic = _TAIL.unpack(
            self.file.read_at(_TAIL.size, size - _TAIL.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file")
        directory = self.file.read_at(size - _TAIL.size - at, at)
        self.ids = np.frombuffer(directory, np.int64, documents)
        self.valid = np.frombuffer(directory, np.uint8, documents, 8 * documents)
        self.starts = np.frombuffer(directory, np.int64, documents, 9 * documents)
        self.offsets = np.append(np.frombuffer(directory, np.int64, segments, 17 * documents), at)
        self.segment = lru_cache(maxsize=2)(self._segment)

    def _segment(self, k: int) -> Segment:
        first, last = int(self.offsets[k]), int(self.offsets[k + 1])
        return Segment(self.file.read_at(last - first, first))

    def token(self, i: int) -> int:
        return self.segment(i // SEGMENT).token(i % SEGMENT)

    def run(self, start: int, end: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` to before ``end``, a part for each segment."""
        while start < end:
            k, i = divmod(start, SEGMENT)
            upto = min(end - k * SEGMENT, SEGMENT)
            yield self.segment(k).run(i, upto)
            start = k * SEGMENT + upto


class _Writer:
    def __init__(self, out):
        self.out, self.at, self.tokens = out, 0, 0
        self.offsets, self.waiting, self.size = [], [], 0
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, ids: np.ndarray) -> None:
        self.tokens += len(ids)
        while len(ids):
            some = ids[:SEGMENT - self.size]
            self.waiting.append(some)
            self.size, ids = self.size + len(some), ids[len(some):]
            if self.size == SEGMENT:
                self._flush()

    def _flush(self) -> None:
        if self.size:
            self.offsets.append(self.at)
            self._put(segment_bytes(np.concatenate(self.waiting)))
            self.waiting, self.size = [], 0

    def close(self, ids: list[int | None], starts: list[int]) -> None:
        self._flush()
        at = self.at
        self._put(np.array([i or 0 for i in ids], np.int64).tobytes())
        self._put(np.array([i is not None for i in ids], np.uint8).tobytes())
        self._put(np.array(starts, np.int64).tobytes())
        self._put(np.array(self.offsets, np.int64).tobytes())
        self._put(_TAIL.pack(len(self.offsets), len(ids), self.tokens, at, MAGIC))


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1
    characters stand for themselves, the other bytes for letters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class LibraryEncoder:
    """Ids of whole texts by the tokenizers library, which a worker asks once for a piece.

    The library's model gets each match of the split pattern by itself, as its pre-tokenizer would
    pass it on, or many at a time with a letter between them that it never merges; a piece that holds
    an added token of the vocabulary goes to the whole library.
    Added tokens must not reach over the places where texts are cut into pieces.
    """

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pattern = regex.compile(pattern)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.between = self._unmerged()
        self.memory = pieces.Memory()

    def _unmerged(self) -> int | None:
        """A byte that no text has, whose letter is a token and part of no other one, so that the model's
        merges on both sides of it do not meet; none if the model looks at more than merges."""
        from tokenizers.models import BPE

        model = self.tokenizer.model
        if not isinstance(model, BPE) or (model.dropout or model.ignore_merges
                                          or model.continuing_subword_prefix or model.end_of_word_suffix):
            return None
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        merged = set().union(*(t for t in vocabulary if len(t) > 1))
        return next((b for b in (*range(0xF5, 0x100), 0xC0, 0xC1)
                     if self.letters[b] in vocabulary and self.letters[b] not in merged), None)

    def _ids(self, matches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of matches of the split pattern one after another, and how many each has."""
        model = self.tokenizer.model
        if self.between is None:
            found = [[t.id for t in model.tokenize(m.decode("latin-1").translate(self.letters))] for m in matches]
            return (np.array([i for ids in found for i in ids], np.uint32),
                    np.fromiter(map(len, found), np.int64, len(found)))
        # A letter for each byte, and one after each match.
        letters = bytes([self.between]).join([*matches, b""]).decode("latin-1").translate(self.letters)
        ends = np.cumsum(np.fromiter(map(len, matches), np.int64, len(matches)) + 1)
        last = np.flatnonzero(np.diff(ends // TOGETHER, append=-1))
        ids: list[int] = []
        start = 0
        for end in ends[last].tolist():
            ids += [t.id for t in model.tokenize(letters[start:end])]
            start = end
        flat = np.array(ids, np.uint32)
        between = flat == model.token_to_id(self.letters[self.between])
        return flat[~between], np.diff(np.flatnonzero(between), prepend=-1) - 1

    def _learn(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        added = [t for t in self.added if t in b"\n".join(new)]
        matches: list[bytes] = []
        counts = np.ones(len(new), np.int64)
        whole: dict[int, np.ndarray] = {}
        for k, p in enumerate(new):
            if p[1:].isalpha() and (p[0] == 0x20 or p[:1].isalpha()):  # one match of ASCII letters
                matches.append(p)
                continue
            text = p.decode()
            if text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):  # one match
                matches.append(p)
            elif any(t in p for t in added):
                whole[k] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                counts[k] = 0
            else:
                found = self.pattern.findall(text)
                matches += [m.encode() for m in found]
                counts[k] = len(found)
        ids, lengths = self._ids(matches)
        places = np.append(0, np.cumsum(lengths))[np.append(0, np.cumsum(counts))]
        lengths = np.diff(places)
        if whole:
            ids = np.insert(ids, np.repeat(places[list(whole)], [len(x) for x in whole.values()]),
                            np.concatenate(list(whole.values())))
            lengths[list(whole)] = [len(x) for x in whole.values()]
        return ids, lengths

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts, and the place of each text's first id."""
        return self.memory.encode(column, self._learn, REMEMBERED)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids, bounds = self.encode_column(pa.array(texts, pa.string()))
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


@lru_cache(maxsize=4)
def library_encoder(path: str, pattern: str) -> LibraryEncoder:
    return LibraryEncoder(path, pattern)


def write_tokens(docs: DataFrame, tokenizer: str, pattern: str, folder: str, text: str = "text",
                 id_col: str = "doc_id", end_id: int = 0) -> list[tuple[int, str, int, int]]:
    """Encodes every whole text, appends ``end_id``, and writes one file for each partition of a
    range partitioning by id. Returns part, path, documents and tokens of each file, in order.

    Null ids come first, equal ids are ordered by a hash of their texts, a null text is an empty
    one, an empty table gives no file. A task writes under a name of its own and renames at the
    end, so a repeated task replaces what a lost one left.
    """
    ranged = (docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text).alias("_text"))
              .withColumn("_tie", F.xxhash64("_text"))
              .repartitionByRange("_id", "_tie").sortWithinPartitions("_id", "_tie")
              .select("_id", whole_text("_text").alias("_text")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = writer = None
        ids: list[int | None] = []
        starts: list[int] = []
        context = TaskContext.get()
        system, base = files.FileSystem.from_uri(folder)
        part = context.partitionId()
        name = f"{base}/part-{part:06d}.dac"
        own = f"{base}/.{part:06d}-{context.taskAttemptId()}"
        for batch in slices(batches, "_text", pieces.AT_ONCE):
            if writer is None:
                system.create_dir(base, recursive=True)
                encoder, writer = library_encoder(tokenizer, pattern), _Writer(
                    system.open_output_stream(own))
            tokens, bounds = encoder.encode_column(batch.column(1))
            ids += batch.column(0).to_pylist()
            starts += (writer.tokens + bounds[:-1] + np.arange(len(bounds) - 1)).tolist()
            writer.add(np.insert(tokens, bounds[1:], end_id))
        if writer:
            writer.close(ids, starts)
            writer.out.close()
            # A rename onto a name that is taken fails on some file systems.
            if system.get_file_info(name).type != files.FileType.NotFound:
                system.delete_file(name)
            system.move(own, name)
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "file": name.rsplit("/", 1)[1], "docs": len(ids),
                  "tokens": writer.tokens}],
                pa.schema([("part", pa.int32()), ("file", pa.string()), ("docs", pa.int64()),
                           ("tokens", pa.int64())]))

    # One row per file.
    found = ranged.mapInArrow(write, "part int, file string, docs long, tokens long").collect()
    return [(r.part, f"{folder}/{r.file}", r.docs, r.tokens) for r in sorted(found)]


def read_tokens(spark: SparkSession, manifest: list[tuple[int, str, int, int]],
                with_ids: bool = True) -> DataFrame:
    """Documents of the files: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens`` (with the end id), ``ids_crc32`` (of the ids as little-endian uint32) and, with
    ``with_ids``, ``ids``. One task reads one file, one document at a time."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    rows, before = [], 0
    for k, (_, path, _, tokens) in enumerate(manifest):
        rows.append((k, path, before))
        before += tokens

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(*(batch.column(k).to_pylist() for k in (1, 2)), strict=True):
                file = TokenFile(path)
                ends = np.append(file.starts[1:], file.tokens)
                for lo in range(0, len(ends), 1024):
                    columns: list[list] = [[], [], [], [], []]
                    for d in range(lo, min(lo + 1024, len(ends))):
                        crc, parts = 0, []
                        for ids in file.run(int(file.starts[d]), int(ends[d])):
                            crc = zlib.crc32(ids, crc)
                            parts.append(ids.astype(np.int32) if with_ids else None)
                        for column, value in zip(columns, (
                                int(file.ids[d]) if file.valid[d] else None,
                                before + int(file.starts[d]), int(ends[d] - file.starts[d]), crc,
                                np.concatenate(parts) if with_ids else None), strict=True):
                            column.append(value)
                    kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())] * with_ids
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)],
                        ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(kinds)])

    listed = spark.createDataFrame(rows, "part int, path string, before long")
    return listed.repartitionById(max(1, len(rows)), F.col("part")).mapInArrow(
        read, schema + ", ids array<int>" * with_ids)
