"""Words of whole texts as 64-bit hashes, for use inside Arrow tasks.

A word is a run of bytes outside space and 0x09-0x0D. Texts are read from Arrow's own UTF-8 buffers a few
megabytes at a time, so that no task holds more than a block of texts and a few arrays of its size; one text
longer than a block is a block of its own. Null texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
HASH_BYTES = 1 << 17
# The multipliers of a published 64-bit finaliser (fixed values).
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(MIX_1)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX_2)
    x ^= x >> np.uint64(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit numbers, the same everywhere."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


class Words(NamedTuple):
    first: int  # the first row of the block in its batch
    rows: int
    data: np.ndarray  # the block's bytes
    starts: np.ndarray  # of each word, in bytes
    ends: np.ndarray
    bounds: np.ndarray  # row i has the words bounds[i] to bounds[i + 1]

    @property
    def row(self) -> np.ndarray:
        """The row of each word, counted in the block."""
        return np.repeat(np.arange(self.rows), np.diff(self.bounds))


def text_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, end row, bytes and row bounds in bytes of blocks of about `limit` bytes; whole texts only."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def byte_class(values) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


WHITE = (32, *range(9, 14))
# All of ASCII but letters and digits.
SIGNS = tuple(b for b in range(128) if not chr(b).isalnum())


def blocks(texts: pa.Array, lower: bool = False, limit: int = BLOCK_BYTES, apart: tuple[int, ...] = WHITE) -> Iterator[Words]:
    """The words of each block, which the bytes `apart` part; with `lower`, A-Z are lower-cased first."""
    space, small = byte_class(apart), lower_table()
    for lo, hi, data, at in text_blocks(texts, limit):
        if lower:
            data = small[data]
        inside = np.zeros(len(data) + 2, bool)
        np.logical_not(space[data], out=inside[1:-1])
        new = inside[1:-1] & ~inside[:-2]
        old = inside[1:-1] & ~inside[2:]
        edge = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]
        new[edge] = inside[1:-1][edge]  # a text ends where the next one starts
        old[edge - 1] = inside[1:-1][edge - 1]
        starts, ends = np.flatnonzero(new), np.flatnonzero(old) + 1
        yield Words(lo, hi - lo, data, starts, ends, np.searchsorted(starts, at))


class Hasher:
    """Hashes byte runs: a sum of random byte values times powers of a base, shifted to the run's start and mixed."""

    def __init__(self, seed: int = 1):
        self.values = constants(256, seed)
        self.seed = np.uint64(seed)
        self.powers = self._powers(HASH_BYTES)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        base = int(constants(1, int(self.seed) + 77)[0])
        steps = np.full((2, n), base, np.uint64)
        steps[1] = pow(base, -1, 1 << 64)
        steps[:, 0] = 1
        return np.cumprod(steps[0]), np.cumprod(steps[1])

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            lo = starts[i]
            j = max(i + 1, int(np.searchsorted(ends, lo + HASH_BYTES - 1, "right")))
            n = int(ends[j - 1] - lo)
            up, down = self.powers if n < HASH_BYTES else self._powers(n + 1)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(self.values[data[lo : lo + n]] * up[:n], out=sums[1:])
            a, b = starts[i:j] - lo, ends[i:j] - lo
            out[i:j] = (sums[b] - sums[a]) * down[a]
            i = j
        return mix(out + (ends - starts).astype(np.uint64) * np.uint64(MIX_2))


def runs(hashes: np.ndarray, bounds: np.ndarray, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words, as if rows were joined, and whether each run stays in one row."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    total = np.zeros(n, np.uint64)
    for j, c in enumerate(constants(k, seed)):
        total += hashes[j : j + n] * c
    whole = np.ones(n, bool)
    for cut in range(1, k):  # a row's start at p spoils the runs p - k + 1 to p - 1
        at = bounds[1:-1] - cut
        whole[at[(at >= 0) & (at < n)]] = False
    return mix(total), whole
