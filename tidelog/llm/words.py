"""Words of whole columns of text at once: where they are and 64-bit fingerprints of them and of runs of them.

A word is a longest run of bytes other than blank and 0x09-0x0D; since all of those are ASCII,
UTF-8 can be cut byte by byte. Fingerprints depend on the bytes alone, so they agree between tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTES = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_LOWERED = _BYTES.copy()
_LOWERED[ord("A") : ord("Z") + 1] = _BYTES[ord("a") : ord("z") + 1]
#: odd factors, one for each place in a run of words
FACTORS = _RANDOM.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that changes all bits; another one for each seed."""
    x = values ^ np.uint64((seed * 0xD6E8FEB86659FD93 + 0x2545F4914F6CDD1D) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, as far as they were needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, PIECE_BYTES + 1)

            def powers(base: int) -> np.ndarray:
                factors = np.full(size, base, dtype=np.uint64)
                factors[0] = 1
                return np.multiply.accumulate(factors)

            self.up, self.down = powers(_BASE), powers(_BASE_INVERSE)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


@dataclass
class Words:
    """The words of a run of texts, in order."""

    data: np.ndarray  # bytes of all texts
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # the byte after it
    text: np.ndarray  # number of the text it is in
    first: np.ndarray  # for each text, the number of its first word; one more at the end
    mark: np.ndarray  # fingerprints

    def runs(self, n: int, factors: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint of the n words from each word on, whether all n are in one text)."""
        count = len(self.mark) - n + 1
        if count <= 0:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
        factors = FACTORS if factors is None else factors
        total = np.zeros(count, dtype=np.uint64)
        for j in range(n):
            total += self.mark[j : j + count] * factors[j]
        return mixed(total), self.text[:count] == self.text[n - 1 :]

    def strings(self, low: int, high: int) -> list[bytes]:
        """The words numbered from low to high - 1."""
        return self.data[self.start[low] : self.end[high - 1]].tobytes().split() if high > low else []


def words_of(texts: pa.Array, lower: bool = False, breaks: np.ndarray = _SPACE) -> Words:
    """Words of a string array; a null is an empty text. `lower` takes A-Z as a-z.

    `breaks` says for each byte whether it parts words.
    """
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    whole = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, dtype=np.uint8)
    data = whole[offsets[0] : offsets[-1]] if len(offsets) else whole[:0]
    offsets = offsets - offsets[0] if len(offsets) else np.zeros(1, dtype=np.int64)
    n = len(data)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return Words(data, none, none, none, np.zeros(len(texts) + 1, dtype=np.int64), none.astype(np.uint64))
    space = breaks[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    begins = ~space
    begins[1:] &= space[:-1] | cut[1:n]
    ends = ~space
    ends[:-1] &= space[1:] | cut[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _POWERS.upto(n)
    values = (_LOWERED if lower else _BYTES)[data] * up
    sums = np.cumsum(values)
    mark = sums[end - 1] - sums[start] + values[start]
    mark = mixed(mark * down[start])
    first = np.searchsorted(start, offsets)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(data, start, end, text, first, mark)


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `limit` bytes; a longer text is a range of its own."""
    if len(texts) == 0:
        return
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0), dtype=np.int64)
    low = total = 0
    for at, size in enumerate(sizes):
        if at > low and total + size > limit:
            yield low, at
            low, total = at, 0
        total += size
    yield low, len(texts)
