"""Words and word windows of many texts at once, hashed with numpy.

A word is a run of bytes other than the space and 0x09-0x0D, so words of UTF-8
text are the matches of ``[^\\x20\\x09-\\x0D]+``. A hash is a polynomial over
random byte values modulo 2**64 with a final mix; equal words have equal hashes
in every process.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np

# Python code of the operators runs in batches of about this many text bytes,
# so that the arrays of a task stay small. A longer text is a batch of its own.
BATCH_BYTES = 1 << 20

BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(
    1, 1 << 63, size=256, dtype=np.uint64
) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below ``size``."""
    if "up" not in _powers or len(_powers["up"]) < size:
        length = max(size, BATCH_BYTES + 1)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(length, base & MASK, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:size], _powers["down"][:size]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for every range."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    lengths = (ends - starts).astype(np.uint64)
    raw = (sums[ends] - sums[starts]) * down[starts]
    return mixed(raw + lengths * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes."""
    n = max(0, len(hashes) - size + 1)
    starts = np.arange(n)
    return range_hashes(hashes, starts, starts + size)


@dataclass
class Words:
    """The words of a batch of texts: text ``i`` has words ``first[i]:first[i + 1]``."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def texts(self, i: int) -> list[bytes]:
        part = slice(self.first[i], self.first[i + 1])
        return [self.data[a:b] for a, b in zip(self.starts[part], self.ends[part])]

    def at(self, places: np.ndarray) -> list[bytes]:
        return [self.data[a:b] for a, b in zip(self.starts[places].tolist(), self.ends[places].tolist())]


def words_of(texts: list[bytes]) -> Words:
    """Find and hash the words of ``texts``."""
    data = b" ".join(texts) + b" "
    buffer = np.frombuffer(data, dtype=np.uint8)
    space = _IS_SPACE[buffer]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    hashes = range_hashes(_VALUES[buffer], starts, ends)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    offsets = np.concatenate(([0], np.cumsum(lengths + 1)))
    first = np.searchsorted(starts, offsets)
    return Words(data, starts, ends, hashes, first)


@contextmanager
def no_cycles() -> Iterator[None]:
    """Pause the search for reference cycles while many small tuples are made, which have none."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def batches(rows: list, size_of, limit: int = BATCH_BYTES) -> Iterator[list]:
    """Split ``rows`` into lists of at most ``limit`` bytes, one row at least."""
    part, held = [], 0
    for row in rows:
        size = size_of(row)
        if part and held + size > limit:
            yield part
            part, held = [], 0
        part.append(row)
        held += size
    if part:
        yield part


def text_bytes(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; a null is an empty text."""
    return [(v or "").encode() for v in column.to_pylist()]
