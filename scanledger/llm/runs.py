"""Periodic runs of words: stretches that say the same few words again and again.

A run is a stretch of consecutive words whose smallest period is q, at least
``max(LEAST, COPIES * q)`` words long, that no neighbouring word extends with
that period.  Every word of a run stands in it at least ``COPIES`` times, with
q words between two of its places.  So a word with fewer places in a segment of
a text is in no run there and splits the segment; the parts are counted again
until nothing splits any more.  What survives is searched lag by lag.

A stretch in which words q apart are equal is, for a run, at least 2 q places
long and so holds two neighbouring multiples of q: each lag looks at every q-th
word alone, m log m words for a segment of m, and widens what it finds.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from scanledger.llm.common import narrow, text_slices

#: A run has at least so many words and so many periods.
LEAST, COPIES = 24, 3
#: Words that are searched for in one go; a longer text is searched alone.
STEP = 1 << 16


class Run(NamedTuple):
    """A run's first word, its number of words and its smallest period."""

    start: int
    length: int
    period: int


def _split_once(ids: np.ndarray, places: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Drop words that are too rare in their segment and number the parts anew.

    Returns the words left, their places and segments, and which words are in a
    segment that was split, so must be counted again.
    """
    key = segment * (int(ids.max()) + 1) + ids
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    frequent = counts[inverse] >= COPIES
    touched = np.zeros(int(segment.max()) + 1, dtype=bool)
    touched[segment[~frequent]] = True
    again = touched[segment]
    left, places, again, old = ids[frequent], places[frequent], again[frequent], segment[frequent]
    breaks = np.ones(len(left), dtype=bool)
    breaks[1:] = (np.diff(places) != 1) | (np.diff(old) != 0)
    part = np.cumsum(breaks) - 1
    long_enough = np.bincount(part, minlength=1)[part] >= LEAST if len(part) else np.zeros(0, dtype=bool)
    return left[long_enough], places[long_enough], np.where(again, part, -1 - part)[long_enough]


def surviving_segments(ids: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of places in which every word stands ``COPIES`` times and more; ``bounds`` are the texts.

    A round counts only the parts of segments that the last one split.
    """
    lengths = np.diff(bounds)
    segment = np.repeat(np.arange(len(lengths)), lengths)
    keep = lengths[segment] >= LEAST if len(segment) else np.zeros(0, dtype=bool)
    places = np.flatnonzero(keep)
    ids_now, segment = ids[keep].astype(np.int64), segment[keep]
    done: list[tuple[int, int]] = []
    while len(places):
        ids_now, places, marked = _split_once(ids_now, places, segment)
        stable = marked < 0
        if stable.any():
            at = places[stable]
            first = np.flatnonzero(np.concatenate([[True], np.diff(marked[stable]) != 0]))
            last = np.append(first[1:], len(at)) - 1
            done += zip(at[first].tolist(), (at[last] + 1).tolist(), strict=True)
        ids_now, places, segment = ids_now[~stable], places[~stable], marked[~stable]
        if len(segment):
            segment = np.cumsum(np.concatenate([[0], (np.diff(segment) != 0).astype(np.int64)]))
    return sorted(done)


def _same_ahead(w: np.ndarray, i: int, q: int) -> int:
    """The first place from ``i`` on at which the word q further is another, or is none."""
    size, end = 64, len(w) - q
    while i < end:
        stop = min(end, i + size)
        other = w[i:stop] != w[i + q : stop + q]
        at = int(other.argmax())
        if other[at]:
            return i + at
        i, size = stop, size * 2
    return end


def _same_behind(w: np.ndarray, i: int, q: int) -> int:
    """The first place of the equal stretch that holds ``i``."""
    size = 64
    while i > 0:
        start = max(0, i - size)
        other = w[start:i] != w[start + q : i + q]
        if other.any():
            return i - int(other[::-1].argmax())
        i, size = start, size * 2
    return 0


def _inside(starts: list[int], ends: list[int], start: int, end: int) -> bool:
    """Whether one of the runs of a period holds the stretch; they overlap by less than a period, so the last one counts."""
    at = bisect_right(starts, start) - 1
    return at >= 0 and ends[at] >= end


def lag_scan(w: np.ndarray) -> list[Run]:
    """All runs of one segment, by start and period."""
    found: list[Run] = []
    starts: dict[int, list[int]] = {}
    ends: dict[int, list[int]] = {}
    for q in range(1, len(w) // COPIES + 1):
        grid = w[::q]
        same = grid[1:] == grid[:-1]
        both = same[1:] & same[:-1]
        if not both.any():
            continue
        # Runs of a divisor of q go on for multiples of it: those are not smallest periods.
        divisors = [d for d in starts if q % d == 0]
        reached = 0
        for i in (np.flatnonzero(both) * q).tolist():
            if i < reached or any(_inside(starts[d], ends[d], i, i + q) for d in divisors):
                continue
            reached = _same_ahead(w, i, q)
            if reached - i < q:
                continue
            start = _same_behind(w, i, q)
            run = Run(start, reached - start + q, q)
            if run.length >= max(LEAST, COPIES * q):
                found.append(run)
                starts.setdefault(q, []).append(start)
                ends.setdefault(q, []).append(start + run.length)
    return sorted(found, key=lambda r: (r.start, r.period))


def word_ids(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words."""
    return pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)


def find_runs(texts: list[list[bytes]]) -> list[list[Run]]:
    """The runs of each text, given as words."""
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    out: list[list[Run]] = [[] for _ in texts]
    if not bounds[-1]:
        return out
    ids = word_ids([w for t in texts for w in t])
    for start, stop in surviving_segments(ids, bounds):
        text = int(np.searchsorted(bounds, start, side="right")) - 1
        first = start - int(bounds[text])
        out[text] += [Run(first + r.start, r.length, r.period) for r in lag_scan(ids[start:stop])]
    return out


def strongest(runs: list[Run]) -> Run | None:
    """The run with the most periods; ties go to the smallest start, then period."""
    best = None
    for r in runs:
        if best is None or r.length * best.period > best.length * r.period:
            best = r
    return best


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without the repeats: of each run its first period stays, unless another run drops it."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for r in runs:
        change[r.start + r.period] += 1
        change[r.start + r.length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def with_planted_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """Known runs for checks: every tenth document, by crc32 of its id, says the end of its text again and again."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


RUNS = (
    "doc_id long, runs array<struct<start: long, length: long, period: long>>, best struct<start: long, length: long, period: long>,"
    " runs_sha256 string, collapsed_sha256 string, collapsed string"
)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: bool = False, keep_collapsed: bool = True) -> DataFrame:
    """The runs of every whole text, its strongest run, and the text without the repeats.

    Words are what ASCII white space leaves; a null or empty text has none.
    One row for each row of ``docs``, repeated rows and null ids included;
    ``best`` is null where there is no run.  ``runs_sha256`` is that of a line
    ``start,length,period`` for each run.  ``planted`` first repeats the end of
    every tenth text (none with a null id).  Other columns are not looked at.
    """
    fields = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", STEP * 8):
            ids = batch.column("doc_id").to_pylist()
            words = [(t or "").encode().split() for t in batch.column("text").to_pylist()]
            if planted:
                words = [with_planted_tail(w, i) for w, i in zip(words, ids, strict=True)]
            found = find_runs(words)
            short = [b" ".join(collapse(w, r)) for w, r in zip(words, found, strict=True)]
            listed = ["".join(f"{r.start},{r.length},{r.period}\n" for r in rs) for rs in found]
            best = [strongest(rs) for rs in found]
            columns = {
                "doc_id": batch.column("doc_id").cast(pa.int64()),
                "runs": pa.array([[r._asdict() for r in rs] for rs in found], pa.list_(fields)),
                "best": pa.array([b and b._asdict() for b in best], fields),
                "runs_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in listed]),
                "collapsed_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in short]),
                "collapsed": pa.array([x.decode() if keep_collapsed else None for x in short], pa.string()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return narrow(docs, doc_id=id_col, text=text_col).mapInArrow(run, RUNS)
