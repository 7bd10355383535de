"""Alignment of two tokenizers, and how often their tokens are linked, counted by external merges.

Byte offsets where tokens of both tokenizers end cut a text into groups; the
two tokens that end a group together are linked.  How often a pair of ids is
linked in the whole corpus is counted outside of memory:

* Texts are taken in slices.  The pair-document records of a slice are sorted
  by the radix digit of their B id, B id, A id and document, and each digit's
  records are a zstd run.  Runs stay beside the documents they came from.
* The pairs of the runs with their counts, one entry a pair and slice, are dealt
  by digit and merged ``FAN_IN`` at a time with a heap, round after round, until
  each digit has one run.  As it is ordered by B id first, the highest count of
  a B id is known as soon as its last pair has gone by.
* Each slice's runs then go along the merged totals and give every document its
  contributions back.

Of two tokens that end together the shorter one ends the longer one, so the
pairs are bounded by the two vocabularies (324,300 for the given ones), however
large the corpus is: that bounds a run's pairs, a merge and the totals that are sent.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import uuid
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanledger.llm.bpe import byte_letters
from scanledger.llm.common import narrow, shared_dir, text_slices

#: Fixed by the vocabulary: how a text is cut before merging.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Runs that are merged at once.
FAN_IN = 64
#: Radix digits: B ids are dealt to so many kinds of runs.
DIGITS = 16
#: Bytes of text of a slice; a longer text is a slice of its own.
SLICE = 1 << 20
#: Numbers that a run is read by.
PIECE = 1 << 14
#: Bytes of a row group of the slices, so that a reader holds few of them.
ROW_GROUP = 16 << 20


class Aligned(NamedTuple):
    """Tokens of one text: ids of both tokenizers and the places in them that end together."""

    a: np.ndarray
    b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray


NOTHING = Aligned(*(np.zeros(0, np.int64) for _ in range(4)))


class TwoTokenizers:
    """The byte-level vocabulary A and the piece vocabulary B."""

    def __init__(self, path_a: str, path_b: str):
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, special = spec["model"]["vocab"], {t["content"] for t in spec["added_tokens"]}
        value = {letter: byte for byte, letter in enumerate(byte_letters())}
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = token.encode() if token in special else bytes(value[c] for c in token)
        merged_ids = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        cut = spec["pre_tokenizer"]
        if spec["normalizer"] or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or merged_ids != sorted(merged_ids):
            raise ValueError("only byte-level vocabularies in order of their merges, without a normalizer, are supported")
        # With ids in order of the merges a token's id is the rank it is merged by.
        ranks = {self.bytes_a[i]: i for token, i in vocab.items() if token not in special}
        self.a = tiktoken.Encoding(path_a, pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.length_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        # Inside a group, at the end of its A tokens, inside, at the end of its B tokens.
        digits = [str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.marked = [x + mark for mark in ",|,;" for x in digits]
        self.n_digits = len(digits)

    def align(self, texts: Iterable[str | None]) -> list[Aligned]:
        """Tokens of each text and where they end together; nothing where the tokens do not say the text again."""
        texts = [t or "" for t in texts]
        out = []
        for text, pieces in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            a, whole = self.a.encode_ordinary(" " + text), b" " + text.encode()
            if not text or b"".join(map(self.bytes_a.__getitem__, a)) != whole or b"".join(map(self.bytes_b.__getitem__, pieces)) != whole:
                out.append(NOTHING)
                continue
            a, b = np.array(a, dtype=np.int64), np.array(pieces, dtype=np.int64)
            stop_a, stop_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
            ends = np.zeros((2, len(whole) + 1), dtype=bool)
            ends[0, stop_a] = ends[1, stop_b] = True
            out.append(Aligned(a, b, np.flatnonzero(ends[1, stop_a]), np.flatnonzero(ends[0, stop_b])))
        return out

    def listed(self, text: Aligned) -> str:
        """The groups as ``a1,a2|b1;a3|b2,b3``."""
        if not len(text.a):
            return ""
        last_a, last_b = np.zeros(len(text.a), bool), np.zeros(len(text.b), bool)
        last_a[text.ends_a] = last_b[text.ends_b] = True
        groups_before_a, groups_before_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        size_a, size_b = np.append(0, text.ends_a + 1), np.append(0, text.ends_b + 1)
        codes = np.empty(len(text.a) + len(text.b), dtype=np.int64)
        codes[np.arange(len(text.a)) + size_b[groups_before_a]] = text.a + last_a * self.n_digits
        codes[np.arange(len(text.b)) + size_a[groups_before_b + 1]] = text.b + (2 + last_b) * self.n_digits
        return "".join(map(self.marked.__getitem__, codes.tolist()))[:-1]


_known: dict[tuple[str, str], TwoTokenizers] = {}


def tokenizers(path_a: str, path_b: str) -> TwoTokenizers:
    """The two tokenizers, loaded once in each Python worker."""
    if (path_a, path_b) not in _known:
        _known[path_a, path_b] = TwoTokenizers(path_a, path_b)
    return _known[path_a, path_b]


def pack(numbers: np.ndarray) -> bytes:
    """Numbers as a zstd frame, eight bytes each."""
    return zstandard.ZstdCompressor(level=1).compress(numbers.astype("<i8").tobytes())


def unpack(frame: bytes) -> np.ndarray:
    """The numbers of a frame."""
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(frame, max_output_size=1 << 31), "<i8")


def pieces_of(frame: bytes) -> Iterator[np.ndarray]:
    """The numbers of a frame, a few at a time."""
    with zstandard.ZstdDecompressor().stream_reader(frame) as reader:
        while part := reader.read(PIECE * 8):
            yield np.frombuffer(part, "<i8")


class Run(NamedTuple):
    """Sorted pairs and their counts, and for a slice the records behind them."""

    digit: int
    pairs: bytes
    counts: bytes
    sizes: bytes
    documents: bytes
    links: bytes


def sorted_runs(a: np.ndarray, b: np.ndarray, document: np.ndarray, n_a: int) -> Iterator[Run]:
    """The records of a slice as one run for each digit.

    A pair is ``b * n_a + a``.  ``pairs`` holds steps between pairs, ``sizes``
    how many documents hold each, ``documents`` and ``links`` these and their
    links.
    """
    n_docs, digit = int(document.max()) + 1, b % DIGITS
    for d in np.unique(digit).tolist():
        at = digit == d
        records, links = np.unique((b[at] * n_a + a[at]) * n_docs + document[at], return_counts=True)
        pair = records // n_docs
        first = np.flatnonzero(np.concatenate([[True], np.diff(pair) != 0]))
        counts, sizes = np.add.reduceat(links, first), np.diff(np.append(first, len(pair)))
        yield Run(d, pack(np.diff(pair[first], prepend=0)), pack(counts), pack(sizes), pack(records % n_docs), pack(links))


def entries(pairs: bytes, counts: bytes) -> Iterator[tuple[int, int]]:
    """Pairs and counts of a run in order."""
    before = 0
    for steps, number in zip(pieces_of(pairs), pieces_of(counts), strict=True):
        keys = np.cumsum(steps) + before
        before = int(keys[-1])
        yield from zip(keys.tolist(), number.tolist(), strict=True)


def merged(runs: Iterable[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of some runs in order, each with the sum of its counts."""
    pairs, counts = [], []
    for pair, same in groupby(heapq.merge(*(entries(p, c) for p, c in runs), key=itemgetter(0)), key=itemgetter(0)):
        pairs.append(pair)
        counts.append(sum(n for _, n in same))
    return np.array(pairs, dtype=np.int64), np.array(counts, dtype=np.int64)


def highest(pairs: np.ndarray, counts: np.ndarray, n_a: int) -> np.ndarray:
    """Which pairs have the highest count of their B id; pairs lie in order of it."""
    if not len(pairs):
        return np.zeros(0, dtype=np.int64)
    b = pairs // n_a
    first = np.flatnonzero(np.concatenate([[True], np.diff(b) != 0]))
    best = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(b))))
    return (counts == best).astype(np.int64)


RUN_FIELDS = "digit: int, pairs: binary, counts: binary, sizes: binary, documents: binary, links: binary"
DOC_FIELDS = "doc_id: long, n_a: long, n_b: long, n_groups: long, n_links: long, groups_sha256: string, groups: string"
SLICES = f"slice string, docs array<struct<{DOC_FIELDS}>>, runs array<struct<{RUN_FIELDS}>>"
MERGED = "digit int, slice string, pairs binary, counts binary"
RUN_TYPE = pa.struct([("digit", pa.int32()), *((n, pa.binary()) for n in Run._fields[1:])])
DOC_TYPE = pa.struct([*((n, pa.int64()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()), ("groups", pa.string())])
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"


def _slices(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str, keep_groups: bool) -> Iterator[pa.RecordBatch]:
    both = tokenizers(path_a, path_b)
    for number, batch in enumerate(text_slices(batches, "text", SLICE)):
        texts = both.align(batch.column("text").to_pylist())
        listed = [both.listed(t) for t in texts]
        docs = [
            {
                "doc_id": i,
                "n_a": len(t.a),
                "n_b": len(t.b),
                "n_groups": len(t.ends_a),
                "n_links": len(t.ends_a),
                "groups_sha256": hashlib.sha256(g.encode()).hexdigest() if g else "",
                "groups": g if keep_groups else None,
            }
            for i, t, g in zip(batch.column("doc_id").to_pylist(), texts, listed, strict=True)
        ]
        document = np.repeat(np.arange(len(texts)), [len(t.ends_a) for t in texts])
        a, b = (np.concatenate([getattr(t, n)[getattr(t, f"ends_{n}")] for t in texts]) for n in "ab")
        runs = [r._asdict() for r in sorted_runs(a, b, document, len(both.bytes_a))] if len(a) else []
        name = f"{TaskContext.get().partitionId()}-{number}"
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([docs], pa.list_(DOC_TYPE)), pa.array([runs], pa.list_(RUN_TYPE))], ["slice", "docs", "runs"])


def _merge_group(group: pa.Table) -> pa.Table:
    pairs, counts = merged(zip(group.column("pairs").to_pylist(), group.column("counts").to_pylist(), strict=True))
    columns = {
        "digit": group.column("digit").slice(0, 1).combine_chunks(),
        "slice": group.column("slice").slice(0, 1).combine_chunks(),
        "pairs": pa.array([pack(np.diff(pairs, prepend=0))], pa.binary()),
        "counts": pa.array([pack(counts)], pa.binary()),
    }
    return pa.table(columns)


def count_pairs(slices: DataFrame) -> DataFrame:
    """How often each pair is linked in all slices: one merged run for each digit.

    Every round merges some ``FAN_IN`` runs of a digit, so no task holds more
    than those, and a digit with most of the links is dealt like any other.
    """
    runs = slices.select("slice", F.inline("runs")).select("digit", "slice", "pairs", "counts")
    left = slices.count()
    while True:
        left = -(-left // FAN_IN)
        dealt = runs.withColumn("part", F.pmod(F.xxhash64("slice"), F.lit(max(left, 1))))
        runs = _stored(dealt.groupBy("digit", "part").applyInArrow(_merge_group, MERGED), "pair-runs")
        if left <= 1:
            return runs


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table of large rows to the shared folder, in small row groups, and read it back."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Totals(NamedTuple):
    """Pairs in order, how often each is linked, and whether that is the highest count of its B id."""

    pairs: np.ndarray
    counts: np.ndarray
    best: np.ndarray


def totals(counted: DataFrame, n_a: int) -> dict[int, Totals]:
    """The counts of all pairs by digit; as many as the vocabularies allow, not as the corpus has links."""
    out = {}
    for row in counted.collect():
        pairs, counts = np.cumsum(unpack(row.pairs)), unpack(row.counts)
        out[row.digit] = Totals(pairs, counts, highest(pairs, counts, n_a))
    return out


def contributions(n_docs: int, runs: Iterable[dict], known: dict[int, Totals]) -> tuple[np.ndarray, np.ndarray]:
    """For each document of a slice: links that have the highest count of their B id, and the sum of all links' counts."""
    best, summed = np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
    for run in runs:
        total = known[run["digit"]]
        at = np.searchsorted(total.pairs, np.cumsum(unpack(run["pairs"])))
        at = np.repeat(at, unpack(run["sizes"]))
        document, links = unpack(run["documents"]), unpack(run["links"])
        np.add.at(best, document, links * total.best[at])
        np.add.at(summed, document, links * total.counts[at])
    return best, summed


def align_texts(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", keep_groups: bool = True) -> DataFrame:
    """Groups and links of every whole text, and how common its links are in all texts.

    A is a byte-level ``tokenizers`` file that reads a space and the text, B a
    ``sentencepiece`` model that adds the space itself; special tokens in texts
    are plain text.  One row for each row of ``docs``, repeated rows and null
    ids included; ``groups`` lists ids as ``a1,a2|b1;a3|b2,b3``.  A null or empty
    text, or one that either tokenizer does not give back byte for byte, has no
    tokens: its numbers are 0, its ``groups`` and their digest empty.
    ``n_best`` counts links whose count is the highest of their B id, ties
    included; ``count_sum`` adds the counts of all links.  Other columns are not
    looked at.
    """
    texts = narrow(docs, doc_id=id_col, text=text_col)
    slices = _stored(texts.mapInArrow(partial(_slices, path_a=path_a, path_b=path_b, keep_groups=keep_groups), SLICES), "pair-slices")
    known = totals(count_pairs(slices), len(tokenizers(path_a, path_b).bytes_a))
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, runs in zip(batch.column("docs"), batch.column("runs"), strict=True):
                rows = pa.RecordBatch.from_struct_array(part.values)
                best, summed = contributions(len(rows), runs.as_py(), sent.value)
                columns = dict(zip(rows.schema.names, rows.columns, strict=True))
                named = columns | {"n_best": pa.array(best), "count_sum": pa.array(summed)}
                yield pa.RecordBatch.from_pydict({c.split()[0]: named[c.split()[0]] for c in ALIGNED.split(", ")})

    return slices.mapInArrow(run, ALIGNED)
