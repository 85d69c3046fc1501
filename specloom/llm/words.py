"""Vectorised work on batches of texts: words, their hashes, shingles.

A batch of UTF-8 texts is one byte array; a word is a run of bytes of a given class.
All functions take and return numpy arrays, so no Python step runs per word. Texts are
worked on in slices of about `SLICE` bytes, which bounds the memory of a Python worker;
a longer text is a slice of its own. Null texts count as empty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

#: Words between ASCII blanks: space, tab, line feed, vertical tab, form feed, carriage return.
BLANK_SEPARATED = np.ones(256, bool)
BLANK_SEPARATED[[0x20, *range(0x09, 0x0E)]] = False

#: Words of ASCII letters and digits and of everything beyond ASCII (texts are lowered first).
LETTERS_DIGITS = np.zeros(256, bool)
LETTERS_DIGITS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, SLICE + 4096)
        _powers = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _BASE, np.uint64)], dtype=np.uint64)
        _inverse = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, pow(_BASE, -1, 1 << 64), np.uint64)], dtype=np.uint64)
    return _powers, _inverse


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def hash_bytes(text: bytes) -> int:
    """The hash that `Bytes.hashes` gives to one run of bytes."""
    total = 0
    for i, b in enumerate(text):
        total = (total + (b + 1) * pow(_BASE, i, 1 << 64)) & _MASK
    return int(mix(np.array([total + len(text)], np.uint64))[0])


@dataclass
class Bytes:
    """Texts of a slice: `data` joined, text i at offsets[i]:offsets[i+1]."""

    data: np.ndarray
    offsets: np.ndarray
    _prefix: np.ndarray | None = None

    @property
    def count(self) -> int:
        return len(self.offsets) - 1

    def lowered(self) -> Bytes:
        return Bytes(_LOWER[self.data], self.offsets)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the byte runs start:end; equal runs hash equally in any batch."""
        powers, inverse = _power_tables(len(self.data) + 1)
        if self._prefix is None:
            self._prefix = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers[: len(self.data)], out=self._prefix[1:])
        return mix((self._prefix[end] - self._prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


@dataclass
class Words:
    """Words in text order: byte runs start:end; text i has the words first[i]:first[i+1]."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def per_text(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.per_text)


def find_words(texts: Bytes, kind: np.ndarray) -> Words:
    """Maximal runs of bytes of a class; runs never cross texts."""
    n = len(texts.data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = kind[texts.data]
    edge = np.zeros(n + 1, bool)
    edge[texts.offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return Words(start, end, np.searchsorted(start, texts.offsets))


def as_bytes(column: pa.Array | pa.ChunkedArray) -> Bytes:
    """A text column as bytes; nulls become empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return Bytes(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    return Bytes(data, offsets - offsets[0])


def tidy() -> None:
    """Give freed memory back: a worker that waits for its next task holds little."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not that C library
        pass


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE) -> Iterator[tuple[pa.RecordBatch, Bytes]]:
    """Cut a batch into runs of rows with about `limit` bytes of text each."""
    texts = as_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        upto = int(np.searchsorted(texts.offsets, texts.offsets[at] + limit, "right")) - 1
        upto = min(max(upto, at + 1), batch.num_rows)
        cut = texts.offsets[at : upto + 1]
        yield batch.slice(at, upto - at), Bytes(texts.data[cut[0] : cut[-1]], cut - cut[0])
        at = upto
    tidy()


def shingles(hashes: np.ndarray, first: np.ndarray, width: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of `width` consecutive words within each text, and where each text's runs begin.

    With `short`, a text of fewer words, but not none, has its whole sequence as one run.
    """
    per = np.diff(first)
    runs = np.maximum(per - width + 1, 0)
    few = (per > 0) & (per < width)
    if short:
        runs = np.where(few, 1, runs)
    begin = np.r_[0, np.cumsum(runs)]
    text = np.repeat(np.arange(len(per)), runs)
    at = first[text] + np.arange(begin[-1]) - begin[text]
    length = np.minimum(per[text], width)
    padded = np.r_[hashes, np.zeros(width, np.uint64)]
    total = length.astype(np.uint64)
    factor = np.uint64(1)
    step = np.uint64(0xC2B2AE3D27D4EB4F)
    with np.errstate(over="ignore"):
        for j in range(width):
            word = padded[at + j]
            if short and few.any():
                word = np.where(j < length, word, np.uint64(0))
            total = total + word * factor
            factor = factor * step
    return mix(total), begin


def distinct_per_text(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values in order, and where each text's values begin."""
    text = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    values, text = values[keep], text[keep]
    return values, np.searchsorted(text, np.arange(len(begin)))


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark's long."""
    return values.view(np.int64)


def ragged(values: np.ndarray, begin: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from joined values and each row's beginning."""
    return pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(values, kind))


def code_points(texts: Bytes) -> np.ndarray:
    """For each byte position, how many code points begin before it (counted over the slice)."""
    return np.r_[0, np.cumsum((texts.data & 0xC0) != 0x80)]
