"""Words of whole texts as numpy arrays, for functions that run inside tasks.

A word is a run of bytes other than 0x20 and 0x09-0x0D. Texts are handled in slices of a few megabytes,
so memory does not depend on the size of an Arrow batch; only a single longer text makes a slice grow.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest

SLICE_BYTES = 1 << 19
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
WORD_BASE = np.uint64(0xD6E8FEB86659FD93)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n."""
    have = _powers.get(int(base))
    if have is None or len(have[0]) < n:
        inverse = pow(int(base), -1, 1 << 64)
        both = []
        for b in (int(base), inverse):
            row = np.full(max(n, 1 << 16), b, np.uint64)
            row[0] = 1
            both.append(np.multiply.accumulate(row))
        have = _powers[int(base)] = (both[0], both[1])
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    z = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """A hash of values[start:end] for each range, from one pass of prefix sums. Patterns of a thousand
    values and more can share one, so it is for short ranges and where that does no harm."""
    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[1:], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


#: Words up to this many bytes are hashed eight bytes at a time, all side by side; longer ones one by one.
SIDE_BY_SIDE = 256
MASKS = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)
FOLD = np.uint64(0xBF58476D1CE4E5B9)


def fold(state: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The state after one more value. The shift keeps equal patterns of values from cancelling out, as they do
    in polynomials modulo 2^64."""
    out = (state ^ value) * FOLD
    out ^= out >> np.uint64(32)
    return out


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of data[start:end] for each range. Ranges of equal length up to eight bytes never share one."""
    sizes = ends - starts
    out = mix(sizes.astype(np.uint64))
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    short = sizes <= SIDE_BY_SIDE
    rows = slice(None) if short.all() else np.flatnonzero(short)
    at, left = starts[rows], sizes[rows]
    while len(at):
        out[rows] = fold(out[rows], eights[at] & MASKS[np.minimum(left, 8)])
        more = np.flatnonzero(left > 8)
        rows = more if isinstance(rows, slice) else rows[more]
        at, left = at[more] + 8, left[more] - 8
    for i in np.flatnonzero(~short):
        out[i] = xxh3_64_intdigest(data[starts[i] : ends[i]])
    return mix(out, 1)


@dataclass
class Words:
    """The words of some texts: byte ranges in `data`, and the first word of each text in `first`
    (one entry more than texts)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self, lower: bool = False) -> np.ndarray:
        data = LOWER[self.data] if lower else self.data
        return byte_hashes(data, self.starts, self.ends)

    def window_starts(self, k: int) -> np.ndarray:
        """Index of every word that starts k words of one text."""
        counts = np.maximum(np.diff(self.first) - k + 1, 0)
        return spread(self.first[:-1], counts)


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, counts)


def window_hashes(word_hashes: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k words from each start on."""
    n = len(word_hashes) - k + 1
    if 2 * len(starts) > n > 0:  # cheaper for every place than looked up for most
        out = mix(word_hashes[:n], k)
        for i in range(1, k):
            out = fold(out, word_hashes[i : i + n])
        return mix(out[starts], 1)
    out = mix(word_hashes[starts], k)
    for i in range(1, k):
        out = fold(out, word_hashes[starts + i])
    return mix(out, 1)


def words_of(texts: pa.Array) -> Words:
    """The words of an Arrow string array; a null text has none."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(texts) == 0 or offsets[-1] == offsets[0]:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint8), none, none, np.zeros(len(texts) + 1, np.int64))
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = ~SPACE[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    starts[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    at = np.flatnonzero(starts)
    return Words(data, at, np.flatnonzero(ends) + 1, np.searchsorted(at, offsets))


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about `size` bytes."""
    if not len(batch):
        return
    texts = batch.column(column).cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    begin = 0
    while begin < len(batch):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + size, "right")) - 1)
        end = min(end, begin + 20_000)
        yield batch.slice(begin, end - begin)
        begin = end
