"""Words and word shingles of whole texts as numbers, without a Python loop over words.

A text is a run of bytes.  The hash of any stretch of bytes follows from two
running sums, so all words of a batch, and any prefix of them, are hashed at
once.  Words are cut at the bytes a caller names; with ``fold``, A-Z count as a-z.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
STEP = np.uint64(0xD6E8FEB86659FD93)
#: Space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = bytes([32, *range(9, 14)])
#: Every ASCII byte that is neither a letter nor a digit.
NOT_ALPHANUMERIC = bytes(b for b in range(128) if not chr(b).isalnum())


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finish of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _byte_values(fold: bool) -> np.ndarray:
    values = np.arange(256, dtype=np.uint64)
    if fold:
        values[65:91] += np.uint64(32)
    return mix((values + np.uint64(1)) * np.uint64(BASE))


FOLDED, EXACT = _byte_values(True), _byte_values(False)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, size: int) -> np.ndarray:
    """base**i modulo 2**64 for i < size; kept, and grown on demand."""
    known = _powers.get(base)
    if known is None or len(known) < size:
        steps = np.full(max(size, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps)
    return known[:size]


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts behind each other and the offsets between them; null is empty."""
    filled = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(filled) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """All words of a batch of texts: where they lie, and their hashes.

    ``bounds[i]:bounds[i + 1]`` are the words of text i; ``starts`` and ``ends``
    are byte places in ``data``.
    """

    def __init__(self, texts: pa.Array, cut: bytes = BLANKS, fold: bool = True):
        self.data, self.offsets = raw_bytes(texts)
        self._values = FOLDED if fold else EXACT
        cuts = np.zeros(256, dtype=bool)
        cuts[np.frombuffer(cut, np.uint8)] = True
        gap = cuts[self.data]
        full = self.offsets[:-1] < self.offsets[1:]
        before, after = np.empty_like(gap), np.empty_like(gap)
        before[1:], after[:-1] = gap[:-1], gap[1:]
        before[self.offsets[:-1][full]] = True
        after[self.offsets[1:][full] - 1] = True
        self.starts = np.flatnonzero(~gap & before)
        self.ends = np.flatnonzero(~gap & after) + 1
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.gap = gap
        self._sums = None

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def stretch(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the given stretches of bytes."""
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum(self._values[self.data] * _power(BASE, len(self.data)), out=self._sums[1:])
        sums = self._sums[ends] - self._sums[starts]
        return mix(sums * _power(INVERSE, len(self.data) + 1)[starts] + (ends - starts).astype(np.uint64))

    def of(self, i: int) -> list[bytes]:
        """The words of text i, folded or not as its hashes are."""
        low = self._values is FOLDED
        raw = self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()
        raw, base = raw.lower() if low else raw, self.offsets[i]
        here = slice(self.bounds[i], self.bounds[i + 1])
        return [raw[s:e] for s, e in zip((self.starts[here] - base).tolist(), (self.ends[here] - base).tolist(), strict=True)]

    def per_text(self, marks: np.ndarray) -> np.ndarray:
        """Number of marked bytes of each text."""
        sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return np.diff(sums[self.offsets])

    def hashes(self) -> np.ndarray:
        return self.stretch(self.starts, self.ends)

    def prefixes(self, length: int) -> np.ndarray:
        """Hashes of the first bytes of each word, of the whole word where it is shorter."""
        return self.stretch(self.starts, np.minimum(self.starts + length, self.ends))

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``width`` words, and their bounds by text."""
        hashes = self.hashes()
        counts = np.maximum(np.diff(self.bounds) - width + 1, 0)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        at = np.arange(bounds[-1]) + np.repeat(self.bounds[:-1] - bounds[:-1], counts)
        run = np.zeros(len(at), dtype=np.uint64)
        for i in range(width):
            run = run * STEP + hashes[at + i]
        return mix(run), bounds

    def whole(self, i: int) -> np.ndarray:
        """One hash of all words of text i, for texts with fewer words than a shingle."""
        run = np.uint64(0)
        with np.errstate(over="ignore"):
            for h in self.stretch(self.starts[self.bounds[i] : self.bounds[i + 1]], self.ends[self.bounds[i] : self.bounds[i + 1]]):
                run = run * STEP + h
        return mix(np.array([run], dtype=np.uint64) + np.uint64(1))

    def shingle_sets(self, width: int) -> Iterator[np.ndarray]:
        """For each text its distinct shingles in rising order; a shorter text has its whole sequence as one."""
        runs, bounds = self.shingles(width)
        for i in range(len(self)):
            if bounds[i] < bounds[i + 1]:
                yield np.unique(runs[bounds[i] : bounds[i + 1]])
            elif self.bounds[i] < self.bounds[i + 1]:
                yield self.whole(i)
            else:
                yield np.zeros(0, np.uint64)
