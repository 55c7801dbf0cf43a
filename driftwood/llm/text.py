"""Vectorised helpers over Arrow string columns: byte buffers, word bounds, rolling hashes.

Everything here works on one slice of a record batch at a time, so a task's
memory is bounded by ``SLICE_BYTES`` of text (or by its longest document).
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: text bytes handled at once inside a task
SLICE_BYTES = 1 << 20

#: byte classes: the ASCII blanks 0x20 and 0x09-0x0D
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

U = np.uint64
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)


def give_back() -> None:
    """Memory that is free inside this process goes back to the system. A Python worker outlives its task, and what it keeps
    counts against its executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only some C libraries have it
        pass


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, a function of batches, that gives its memory back when its task ends."""

    @wraps(run)
    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidy


def byte_table(seed: int) -> np.ndarray:
    """A 64-bit value for each byte."""
    return np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the result."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Powers:
    """Powers of the hash multiplier and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", MULTIPLIER), ("down", INVERSE)):
                a = np.full(size, base, np.uint64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values[i] * multiplier**i; ``span`` turns them into hashes of stretches."""
    up, _ = POWERS(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def span(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the stretches [start, end), the same wherever a stretch stands."""
    _, down = POWERS(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


def rolling(prefix: np.ndarray, width: int) -> np.ndarray:
    """Hash of every stretch of ``width`` values."""
    n = len(prefix) - width
    if n <= 0:
        return np.empty(0, np.uint64)
    _, down = POWERS(len(prefix))
    return mix((prefix[width:] - prefix[:-width]) * down[:n])


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each piece holds at most ``limit`` bytes of text or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, nulls as empty, and the rows' offsets."""
    a = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(a)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + n + 1]
    data = a.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.empty(0, np.uint8)
    return buf, offs - offs[0]


def words(buf: np.ndarray, offs: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each row the index of its first word (one entry more than rows)."""
    if not len(buf):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offs), np.int64)
    full = ~blank[buf]
    first = np.empty(len(buf), bool)
    first[0], first[1:] = True, ~full[:-1]
    first[offs[:-1][offs[:-1] < len(buf)]] = True
    last = np.empty(len(buf), bool)
    last[-1], last[:-1] = True, ~full[1:]
    last[offs[1:][offs[1:] > 0] - 1] = True
    start, end = np.flatnonzero(full & first), np.flatnonzero(full & last) + 1
    return start, end, np.searchsorted(start, offs)


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... (length[0] values), then the same for each further entry."""
    total = int(length.sum())
    if not total:
        return np.empty(0, np.int64)
    skip = np.repeat(np.cumsum(length) - length, length)
    return np.arange(total) - skip + np.repeat(start, length)


def runs(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the stretches of True."""
    edge = np.diff(np.concatenate([[0], flag.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
