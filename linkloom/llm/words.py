"""Arrow text columns as flat numpy arrays of words: one pass over bytes, no loop over words."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at a time. A longer text is a slice by itself.
SLICE_BYTES = 4 << 20

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
NOT_SPACE = np.array([b not in SPACES for b in range(256)])
NOT_NEWLINE = np.array([b != 0x0A for b in range(256)])
#: ASCII letters and digits, and every byte of a character beyond ASCII.
ALNUM = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


class Words(NamedTuple):
    """Words of several texts. ``start`` and ``end`` are byte positions in ``data``."""

    data: np.ndarray
    offsets: np.ndarray
    inside: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.offsets) - 1

    def first(self) -> np.ndarray:
        """Index of the first word of each text, and the number of words at the end."""
        return np.searchsorted(self.start, self.offsets)

    def array(self) -> pa.StringArray:
        lengths = np.concatenate(([0], np.cumsum(self.end - self.start))).astype(np.int32)
        data = pa.py_buffer(np.ascontiguousarray(self.data[self.inside]))
        return pa.StringArray.from_buffers(len(self.start), pa.py_buffer(lengths), data)

    def per_doc(self, mask: np.ndarray) -> np.ndarray:
        """Number of marked bytes in each text."""
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def memory_trim() -> Callable[[int], int]:
    """What gives the allocator's free memory back to the system, where it can."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def sliced(
    batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in pieces of at most ``most`` bytes of text, or one row.

    From here on the worker's Arrow buffers come from the system's allocator, and what
    it holds free goes back after every batch; else each worker would keep the memory
    of its largest slice, idle ones too.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    trim = memory_trim()
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        reach, at = np.cumsum(sizes, dtype=np.int64), 0
        while at < batch.num_rows:
            before = reach[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(reach, before + most, "right")))
            yield batch.slice(at, to - at)
            at = to
        trim(0)


def runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[object, list[pa.RecordBatch]]]:
    """Rows of equal ``key`` as a list of slices; they must stand together."""
    now, held = None, []
    for batch in batches:
        column, at = batch.column(key), 0
        for end in pc.run_end_encode(column).run_ends.to_pylist() if batch.num_rows else ():
            value = column[at].as_py()
            if held and value != now:
                yield now, held
                held = []
            now = value
            held.append(batch.slice(at, end - at))
            at = end
    if held:
        yield now, held


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offset of each text; NULL is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    raw = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = raw[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def split_words(column: pa.Array, keep: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    """Maximal runs of the bytes in ``keep``, never across two texts."""
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    inside = keep[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1])) if len(data) else inside
    after = np.concatenate((inside[1:], [False])) if len(data) else inside
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    return Words(data, offsets, inside, start, end, doc)


def codes(array: pa.Array) -> np.ndarray:
    """Equal strings get equal numbers; exact, within one array."""
    return array.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def spaced(words: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words joined by single spaces, with the start and end of each."""
    size = words.end - words.start
    start = np.concatenate(([0], np.cumsum(size + 1)))[:-1]
    out = np.full(int(size.sum() + len(size)), 0x20, dtype=np.uint8)
    kept = words.data[words.inside]
    out[np.arange(len(kept)) + np.repeat(np.arange(len(size)), size)] = kept
    return out.tobytes(), start, start + size


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same in every task."""
    size = words.end - words.start
    kept = words.data[words.inside].astype(np.uint64) + np.uint64(1)
    first = np.concatenate(([0], np.cumsum(size)))[:-1]
    place = np.arange(len(kept)) - np.repeat(first, size)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(256, 0x9E3779B97F4A7C15, dtype=np.uint64))
        terms = kept * powers[place & 255] ^ (place >> 8).astype(np.uint64)
        terms *= np.uint64(0xC2B2AE3D27D4EB4F)
        terms ^= terms >> np.uint64(29)
        if not len(first):
            return np.zeros(0, dtype=np.uint64)
        out = np.add.reduceat(terms, first) + size.astype(np.uint64)
        return mixed(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (the finisher of a well-known mixer)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))
