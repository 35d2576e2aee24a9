"""Words and their hashes, for many texts at once.

A word is a run of bytes that a rule maps to something other than zero.  All
words of a block of texts are found and hashed by a few numpy calls; a text is
never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

# Blocks are about this many bytes, so that their arrays stay in cache; a longer
# text is a block of its own.
BLOCK_BYTES = 1 << 18

# Odd, hence invertible modulo 2**64.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def _rule(separates, lower: bool) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[ord("A") : ord("Z") + 1] += 32
    table[[b for b in range(128) if separates(chr(b))]] = 0
    table[0] = 0
    return table


# Letters and digits of ASCII and everything beyond it, lower-cased in ASCII:
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z became a-z.
ALNUM = _rule(lambda c: not c.isalnum(), lower=True)
# Everything but the white space of ASCII: [^\x20\x09-\x0D]+.  A NUL is no
# separator there but hashes like one, so it stands as 0x0B, which is one.
SPACED = _rule(lambda c: c in " \t\n\x0b\x0c\r", lower=False)
SPACED[0] = 0x0B


class _Powers:
    """Powers of a base and of its inverse modulo 2**64."""

    KEPT = 4 * BLOCK_BYTES  # for longer texts they are made anew

    def __init__(self, base: int):
        self.bases = base, pow(base, -1, 1 << 64)
        self.tables: list[np.ndarray] = []

    def __call__(self, n: int) -> list[np.ndarray]:
        if n > self.KEPT:
            return [self._powers(base, n) for base in self.bases]
        if not self.tables:
            self.tables = [self._powers(base, self.KEPT) for base in self.bases]
        return [table[:n] for table in self.tables]

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        return np.cumprod(steps)


_BYTE_POWERS = _Powers(BYTE_BASE)
_WORD_POWERS = tuple(map(_Powers, WORD_BASES))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all others."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(values: np.ndarray, first: np.ndarray, end: np.ndarray, which: int = 0):
    """A hash of ``values[first:end]`` for every pair; equal runs have equal hashes."""
    forward, backward = _WORD_POWERS[which](len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * forward[:-1], out=sums[1:])
    return mix((sums[end] - sums[first]) * backward[first] + (end - first).astype(np.uint64))


@dataclass
class Words:
    """The words of a block of texts."""

    raw: np.ndarray  # bytes of all texts, each between line feeds
    kept: np.ndarray  # the same bytes under the rule; zero between words
    start: np.ndarray  # of each word, in raw
    end: np.ndarray
    hash: np.ndarray  # uint64
    text: np.ndarray  # where each text begins in raw; one more for the end
    first: np.ndarray  # the number of each text's first word; one more for the end
    sums: np.ndarray  # of the hash terms of all bytes before

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def of(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of n words within a text, and where they begin."""
        begin = np.arange(max(0, len(self.hash) - n + 1))
        of = self.of
        begin = begin[of[: len(begin)] == of[n - 1 :]] if len(begin) else begin
        return span_hashes(self.hash, begin, begin + n), begin


    def beginnings(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the first ``size`` bytes of the words that have them, and which these are."""
        long = np.flatnonzero(self.end - self.start >= size)
        start = self.start[long]
        backward = _BYTE_POWERS(len(self.raw) + 1)[1]
        return mix((self.sums[start + size] - self.sums[start]) * backward[start]), long


def words(texts: list[bytes], rule: np.ndarray = ALNUM) -> Words:
    raw = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    text = np.ones(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1, out=text[1:])
    text[1:] += 1
    kept = rule[raw]
    inside = kept != 0
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    forward, backward = _BYTE_POWERS(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(kept * forward[:-1], out=sums[1:])
    hashed = mix((sums[end] - sums[start]) * backward[start])
    return Words(raw, kept, start, end, hashed, text, np.searchsorted(start, text), sums)


def blocks(texts: list[bytes], size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of about ``size`` bytes each."""
    low = held = 0
    for i, text in enumerate(texts):
        if i > low and held + len(text) > size:
            yield low, i
            low, held = i, 0
        held += len(text)
    if low < len(texts):
        yield low, len(texts)


def bytes_of(column) -> list[bytes]:
    """An Arrow column of strings as bytes; null is empty."""
    import pyarrow as pa

    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [value or b"" for value in column.cast(kind).to_pylist()]
