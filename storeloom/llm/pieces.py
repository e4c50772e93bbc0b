"""Texts as numbered pieces, for encoders that look at a piece once.

A column of texts is cut, without a string for any piece, before each space that stands between two
characters that are no white space, between an ASCII letter and a sign of ``_SIGN`` after it, and
between a line feed that stands alone and an ASCII letter. No match of a split pattern crosses such
a place if its letters never take in a sign, and its words nothing before them but one character
that is no line feed. Equal pieces of a batch get one number, and what a worker knows of a piece is
kept in one flat array, so that the ids of whole texts are gathered by position.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa

#: Pieces that a worker remembers before it forgets those that it rarely met.
REMEMBERED = 150_000
#: Ids that a worker remembers for each of these pieces, long ones and short ones together.
LONG = 8
#: Bytes of text that are cut at once.
AT_ONCE = 4_000_000
#: Cut after a letter; without the apostrophe of short forms, and without signs in or at the end of names
#: as ``<|end_of-text|>``.
_SIGN = np.zeros(256, bool)
_SIGN[list(b'.,;:!?"#$%&()*+<=@[\\^`{~\n')] = True


def _within(data: np.ndarray, first: int, last: int) -> np.ndarray:
    return data - np.uint8(first) <= np.uint8(last - first)


def _cuts(data: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each byte, as far as the bytes around it tell."""
    # First bytes of characters of two and three bytes that may be white space.
    two, three = data == 0xC2, _within(data, 0xE1, 0xE3)
    near = _within(data, 0x09, 0x0D) | _within(data, 0x1C, 0x20) | two | three
    new = data == 0x20
    new[:1] = new[-1:] = False
    new[1:] &= ~near[:-1]
    new[:-1] &= ~near[1:]
    # Such a character before the space shows its first byte two or three back.
    new[2:] &= ~two[:-2]
    new[3:] &= ~three[:-3]
    letter = _within(data | np.uint8(0x20), 0x61, 0x7A)
    new[1:] |= letter[:-1] & _SIGN[data[1:]]
    # What follows more than one white space can change how they are split.
    new[2:] |= _within(data[:-2], 0x21, 0x7E) & (data[1:-1] == 0x0A) & letter[2:]
    return new


class Pieces:
    """Where the pieces of a column of texts are, and which of them are equal."""

    def __init__(self, column: pa.Array):
        _, offsets, data = column.buffers()
        kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
        offsets = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
        data = np.frombuffer(data or b"", np.uint8)[offsets[0]:offsets[-1]]
        bounds = offsets - offsets[0]
        n = len(data)
        new = np.append(_cuts(data), False)
        new[bounds] = True
        starts = np.flatnonzero(new[:n])
        ends = np.append(starts, n).astype(np.int32)
        found = pa.BinaryArray.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        #: Number of each piece, the distinct pieces, and the first piece of each text.
        self.index = found.indices.to_numpy(zero_copy_only=False)
        self.distinct: list[bytes] = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.first = np.searchsorted(starts, bounds)


class Memory:
    """Ids of the pieces that a worker has met, in one array."""

    def __init__(self):
        self.slots: dict[bytes, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.lengths = self.starts = self.met = np.zeros(0, np.int64)

    def gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces in these slots one after another, and how many each has."""
        lengths = self.lengths[slots]
        after = np.cumsum(lengths)
        total = int(after[-1]) if len(after) else 0
        at = np.arange(total) + np.repeat(self.starts[slots] - (after - lengths), lengths)
        return self.flat[at], lengths

    def _forget(self, needed: np.ndarray, most: int) -> None:
        """Keeps what was met in more than one batch, and what the batch at hand needs."""
        keep = self.met > 1
        keep[needed] = True
        if keep.sum() > most // 2 or self.lengths[keep].sum() > LONG * most // 2:
            keep[:] = False
            keep[needed] = True
        kept = np.flatnonzero(keep)
        names = list(self.slots)
        self.flat, self.lengths = self.gather(kept)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.met = np.zeros(len(kept), np.int64)
        self.slots = {names[k]: i for i, k in enumerate(kept.tolist())}

    def encode(self, column: pa.Array, learn: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]],
               most: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts without nulls, and the place of each text's first id, with the
        end of the last. ``learn`` gives the ids of pieces that are not known yet one after another, and
        how many each has."""
        pieces = Pieces(column)
        slots = np.fromiter(map(self.slots.get, pieces.distinct, repeat(-1)), np.int64, len(pieces.distinct))
        unknown = np.flatnonzero(slots < 0)
        if len(unknown):
            new = [pieces.distinct[i] for i in unknown.tolist()]
            found, lengths = learn(new)
            first = len(self.slots)
            slots[unknown] = np.arange(first, first + len(new))
            self.slots.update(zip(new, range(first, first + len(new)), strict=True))
            self.flat = np.append(self.flat, found)
            self.lengths = np.append(self.lengths, lengths)
            self.starts = np.cumsum(self.lengths) - self.lengths
            self.met = np.append(self.met, np.zeros(len(new), np.int64))
        self.met[slots] += 1
        ids, lengths = self.gather(slots[pieces.index])
        if len(self.slots) > most or len(self.flat) > LONG * most:
            self._forget(slots, most)
        return ids, np.concatenate([[0], np.cumsum(lengths)])[pieces.first]
