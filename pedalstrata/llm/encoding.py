"""Token ids of whole texts, from a public tokenizer file, inside Arrow tasks.

``encode`` returns exactly what ``Tokenizer.encode(text, add_special_tokens=False)`` returns
with special-token strings taken as ordinary text. The byte-level pre-tokenizer never lets a
token reach from a visible character into the white space behind it, nor from a letter into
punctuation, so a text can be cut at such places, and the ids of the pieces, concatenated, are
the ids of the text. Pieces repeat, so each worker encodes a piece once and finds its ids again by
a 64-bit hash of its bytes; the store is emptied when it is full, which changes the time taken
and nothing else. Cutting, hashing and looking up work on whole Arrow buffers at once.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark already runs one task per core

END = 0  # closes every document
STORE_BITS = 21  # slots of a worker's store; it is emptied when half of them are taken
BATCH_BYTES = 1_000_000
TEXT_BYTES = 100_000  # of text encoded at a time: the arrays that takes are many times as long
LEARNED = 1000  # pieces given to the tokenizer at a time, which returns hundreds of bytes for each
HASHED_BYTES = 256  # longer pieces are not stored

# Kinds of bytes: white space, letters and punctuation of ASCII, anything else.
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 1
_KIND[[b for b in range(128) if chr(b).isalpha()]] = 2
_KIND[[b for b in range(33, 127) if not chr(b).isalnum()]] = 3
# A cut lies between anything visible and white space, and between a letter and punctuation.
_CUT = np.zeros(16, bool)
_CUT[[0 * 4 + 1, 2 * 4 + 1, 3 * 4 + 1, 2 * 4 + 3]] = True
# One random number per byte and place in a piece; their sum is the piece's hash.
_RANDOM = np.random.default_rng(11).integers(0, 2**64, HASHED_BYTES * 256, np.uint64)


class Store:
    """Open addressing from a 64-bit hash to a number, many hashes at a time."""

    def __init__(self, bits: int) -> None:
        self.bits = bits
        self.keys = np.zeros(1 << bits, np.uint64)
        self.numbers = np.zeros(1 << bits, np.int32)

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, or -1."""
        slots = self._slots(hashes)
        keys = self.keys[slots]
        out = np.where(keys == hashes, self.numbers[slots], -1)
        left = np.flatnonzero((keys != hashes) & (keys != 0))
        slots = slots[left]
        while len(left):
            slots = (slots + 1) & ((1 << self.bits) - 1)
            keys = self.keys[slots]
            same = keys == hashes[left]
            out[left[same]] = self.numbers[slots[same]]
            on = ~same & (keys != 0)
            left, slots = left[on], slots[on]
        return out

    def add(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        """Distinct hashes that are not in the store."""
        slots = self._slots(hashes)
        while len(hashes):
            free = self.keys[slots] == 0
            self.keys[slots[free]] = hashes[free]
            placed = self.keys[slots] == hashes
            self.numbers[slots[placed]] = numbers[placed]
            hashes, numbers = hashes[~placed], numbers[~placed]
            slots = (slots[~placed] + 1) & ((1 << self.bits) - 1)


class Encoder:
    def __init__(self, path: str, store_bits: int = STORE_BITS) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.store_bits = store_bits
        self._clear()

    def _clear(self) -> None:
        self.store = Store(self.store_bits)
        self.ids, self.ends, self.n = np.empty(1 << 16, np.int32), np.zeros(1 << 12, np.int64), 0

    def _learn(self, pieces: list[str]) -> np.ndarray:
        """Encode pieces and return their numbers."""
        begin = self.n
        for at in range(0, len(pieces), LEARNED):
            found = self.tokenizer.encode_batch_fast(pieces[at : at + LEARNED], add_special_tokens=False)
            self._keep([e.ids for e in found])
        return np.arange(begin, self.n)

    def _keep(self, lists: list[list[int]]) -> None:
        """Number lists of ids on from the last one."""
        ends = self.ends[self.n] + np.cumsum([len(x) for x in lists])
        while ends[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while self.n + len(lists) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[self.ends[self.n] : ends[-1]] = np.fromiter((i for x in lists for i in x), np.int32, int(ends[-1] - self.ends[self.n]))
        self.ends[self.n + 1 : self.n + 1 + len(lists)] = ends
        self.n += len(lists)

    def _numbers(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The number of each piece, of which unknown ones are encoded first."""
        place = np.arange(len(data), dtype=np.int32) - np.repeat(starts.astype(np.int32), lengths)
        np.minimum(place, HASHED_BYTES - 1, out=place)
        hashes = np.add.reduceat(_RANDOM[(place << 8) | data], starts)
        hashes[hashes == 0] = 1
        numbers = self.store.find(hashes)
        piece = lambda i: data[starts[i] : starts[i] + lengths[i]].tobytes().decode("utf-8", "replace")
        long = np.flatnonzero(lengths > HASHED_BYTES)
        numbers[long] = 0
        new, first = np.unique(hashes[numbers < 0], return_index=True)
        if len(new):
            where = np.flatnonzero(numbers < 0)
            self.store.add(new, self._learn([piece(i) for i in where[first].tolist()]))
            numbers[where] = self.store.find(hashes[where])
        if len(long):
            numbers[long] = self._learn([piece(i) for i in long.tolist()])
        return numbers

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, each text closed by ``END``, and the number of ids per text."""
        if 2 * self.n > 1 << self.store_bits:
            self._clear()
        texts = pc.fill_null(texts.cast(pa.string()), "")
        bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        if bounds[0] == bounds[-1]:
            return np.full(len(texts), END, np.int32), np.ones(len(texts), np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        starts = _piece_starts(data, bounds)
        lengths = np.diff(starts, append=len(data))
        numbers = self._numbers(data, starts, lengths)
        sizes = self.ends[numbers + 1] - self.ends[numbers]
        held = np.searchsorted(starts, bounds)  # pieces before each text
        before = np.concatenate([[0], np.cumsum(sizes)])
        text_of = np.repeat(np.arange(len(texts)), np.diff(held))
        total = int(before[-1])
        out = np.full(total + len(texts), END, np.int32)
        step = np.arange(total)
        out[step + np.repeat(text_of, sizes)] = self.ids[step + np.repeat(self.ends[numbers] - before[:-1], sizes)]
        return out, np.diff(before[held]) + 1


def _piece_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    kind = _KIND[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = _CUT[(kind[:-1] << 2) | kind[1:]]
    # White space of two or three bytes is no visible character: no cut behind it.
    at = np.flatnonzero(cut & np.concatenate([[False], data[:-1] >= 0x80]))
    one, two, three = data[at - 1], data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    wide = (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    wide |= (three >= 0xE1) & (three <= 0xE3) & ((two == 0x9A) | (two == 0x80) | (two == 0x81))
    cut[at[wide]] = False
    cut[bounds[:-1][np.diff(bounds) > 0]] = True
    return np.flatnonzero(cut)


_ENCODERS: dict[str, Encoder] = {}


def worker_encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def forget_encoders() -> None:
    """Free this worker's encoders; Spark uses workers again for what follows."""
    _ENCODERS.clear()


def slices(batch: pa.RecordBatch, column: str, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``size`` bytes of text, or one longer row."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes + 64) // size  # many short rows count too
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def ids_array(ids: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32, copy=False)))


def crc32s(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of each run of ids as little-endian unsigned 32-bit integers."""
    data = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
    return np.fromiter(
        (zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)),
        np.int64,
        len(starts),
    )


def list_values(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of a list column, with where each list starts and how long it is."""
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    return values, ends[:-1].astype(np.int64), np.diff(ends).astype(np.int64)
