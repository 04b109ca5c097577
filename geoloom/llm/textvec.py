"""Whole Arrow batches of texts as numpy vectors: words, their hashes, shingles.

Words are runs of bytes other than 0x20 and 0x09-0x0D, as in the pattern [^\\x20\\x09-\\x0D]+ on UTF-8. Hashes are
64-bit and depend on the bytes alone, so every task and every run agrees on them.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from contextlib import suppress
from dataclasses import dataclass
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U = np.uint64


def give_back() -> None:
    """Return to the system what memory this process no longer needs."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # another C library than glibc keeps its own counsel
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run):
    """run, a function from Arrow batches to others, that gives back at its end what memory its process no longer needs.

    Python workers live on after a task, beside the executor's own memory.
    """

    @wraps(run)
    def tidied(*args, **kwargs):
        try:
            yield from run(*args, **kwargs)
        finally:
            give_back()

    return tidied


GOLDEN = U(0x9E3779B97F4A7C15)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit over all output bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
BASE = U(0x5851F42D4C957F2D)
BASE_INVERSE = U(pow(int(BASE), -1, 1 << 64))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: np.uint64) -> np.ndarray:
        steps = np.full(size, base)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    return run(BASE), run(BASE_INVERSE)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse to the powers 0 .. size-1 at least."""
    return _powers(max(SLICE_BYTES, 1 << max(0, size - 1).bit_length()))


@dataclass
class Slice:
    """Rows first .. first+rows-1 of a batch: their bytes and, for each row, where they begin (rows+1 numbers)."""

    first: int
    rows: int
    data: np.ndarray
    begin: np.ndarray


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of a string column a few at a time: no more than limit bytes, or one text. Null counts as empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if not len(column):
        return
    _, where, values = column.buffers()
    begin = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    if column.null_count and np.diff(begin)[column.is_null().to_numpy(zero_copy_only=False)].any():  # mostly nulls hold no bytes
        yield from slices(column.fill_null(""), limit)
        return
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.empty(0, np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(begin, begin[at] + limit, "right")) - 1
        to = min(max(to, at + 1), len(column))
        yield Slice(at, to - at, data[begin[at] : begin[to]], begin[at : to + 1] - begin[at])
        at = to


@dataclass
class Words:
    """start and end of each word in a slice's bytes, and for each row the number of its first word (rows+1)."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def words(part: Slice) -> Words:
    n = len(part.data)
    if not n:
        none = np.empty(0, np.int64)
        return Words(none, none, np.zeros(part.rows + 1, np.int64))
    space = SPACE[part.data]
    edge = np.zeros(n + 1, bool)
    edge[part.begin] = True
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = space[:-1]
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = space[1:]
    start = np.flatnonzero(~space & (before | edge[:-1]))
    end = np.flatnonzero(~space & (after | edge[1:])) + 1
    return Words(start, end, np.searchsorted(start, part.begin))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray = BYTE) -> np.ndarray:
    """A 64-bit hash of each span data[start:end]; equal bytes, equal hash. Empty spans hash to one value."""
    if not len(start):
        return np.empty(0, np.uint64)
    if not len(data):
        return mix64(np.zeros(len(start), np.uint64))
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * up[: len(data)], out=sums[1:], dtype=np.uint64)
    return mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * GOLDEN)


STEP = mix64(np.arange(1, 65, dtype=np.uint64) * U(0xD1342543DE82EF95)) | U(1)


def windows(hashes: np.ndarray, first: np.ndarray, size: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of size words in each row, in order, and each row's first run (rows+1).

    With short, a row of fewer words (but one at least) gives one run of them all.
    """
    count = np.diff(first)
    runs = np.maximum(count - size + 1, 0)
    if short:
        runs[(count > 0) & (count < size)] = 1
    begin = np.zeros(len(first), np.int64)
    np.cumsum(runs, out=begin[1:])
    where = np.arange(begin[-1]) - np.repeat(begin[:-1] - first[:-1], runs)
    length = np.repeat(np.minimum(count, size), runs)
    out = length.astype(np.uint64) * GOLDEN
    for j in range(size):
        live = length > j
        if live.all():
            out += hashes[where + j] * STEP[j]
        elif live.any():
            out[live] += hashes[where[live] + j] * STEP[j]
    return mix64(out), begin
