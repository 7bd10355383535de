"""Byte-pair encoding and decoding with a segment tree over pair ranks.

Each leaf of a tree holds the rank and place of one adjacent pair of symbols,
so the root holds the leftmost pair of the lowest rank.  Merging it changes
three leaves, whose paths to the root are recomputed.  The trees of many short
pieces stand side by side in one array and are worked on together.

The vocabulary is a ``tokenizers`` file of a byte-level model without a
normalizer.  Its special tokens count in a text, as they do in that library.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from scanledger.llm.common import PIECE_BYTES, give_back, narrow, released, text_slices

#: Characters that end a chunk: the Unicode white space.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed by the vocabulary: how a text is cut before merging.
PIECES = rf"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"""
#: No piece crosses from other characters to white space, so these chunks are cut alone.
CHUNKS = rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+"
#: So few rows are merged one by one.
FEW = 8
NO_PAIR = np.iinfo(np.int64).max
PLACE_BITS = 36


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class PairTrees:
    """Merges symbols of many pieces of at most ``size`` symbols by pair rank."""

    def __init__(self, firsts: np.ndarray, seconds: np.ndarray, results: np.ndarray, n_ids: int):
        pairs = firsts.astype(np.int64) * n_ids + seconds
        order = np.argsort(pairs, kind="stable")
        self.n_ids, self.pairs, self.ranks, self.results = n_ids, pairs[order], order, results
        self.rank_of = dict(zip(self.pairs.tolist(), order.tolist(), strict=True))
        self.result_of = results.tolist()

    def leaf(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Rank and place of a pair as one number; right is -1 where there is none."""
        wanted = left.astype(np.int64) * self.n_ids + right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        found = (self.pairs[at] == wanted) & (right >= 0) & (left >= 0)
        return np.where(found, (self.ranks[at] << PLACE_BITS) | place, NO_PAIR)

    def merge(self, symbols: np.ndarray) -> np.ndarray:
        """Merge rows of symbols (-1 behind the end); merged places become -1."""
        count, size = symbols.shape
        if size < 2 or not len(self.pairs):
            return symbols
        if count <= FEW:
            # Few trees are walked one by one; side by side a step costs the same for one as for many.
            return np.array([self.walk(row) for row in symbols.tolist()], dtype=np.int32)
        # A column behind the end takes the links and leaves of places that do not exist.
        sym = np.full((count, size + 1), -1, dtype=np.int32)
        sym[:, :size] = symbols
        after = np.tile(np.arange(1, size + 2, dtype=np.int32), (count, 1))
        after[:, size - 1 :] = size
        before = np.tile(np.arange(-1, size, dtype=np.int32), (count, 1))
        tree = np.full((count, 2 * size), NO_PAIR, dtype=np.int64)
        tree[:, size : 2 * size - 1] = self.leaf(sym[:, : size - 1], sym[:, 1:size], np.arange(size - 1))
        node = size
        while node > 1:
            node //= 2
            np.minimum(tree[:, 2 * node : 4 * node : 2], tree[:, 2 * node + 1 : 4 * node : 2], out=tree[:, node : 2 * node])
        rows = np.arange(count)
        while True:
            best = tree[rows, 1]
            open_ = best < NO_PAIR
            if not open_.any():
                return sym[:, :size]
            rows, best = rows[open_], best[open_]
            place = best & ((1 << PLACE_BITS) - 1)
            second = after[rows, place]
            third = after[rows, second]
            first = before[rows, place]
            sym[rows, place] = self.results[best >> PLACE_BITS]
            sym[rows, second] = -1
            after[rows, place] = third
            before[rows, third] = place
            merged, none = sym[rows, place], first < 0
            left = np.where(none, -1, sym[rows, np.maximum(first, 0)])
            changed = np.stack([place, second, np.where(none, place, first)])
            own = self.leaf(merged, sym[rows, third], place)
            leaves = np.stack([own, np.full(len(rows), NO_PAIR), np.where(none, own, self.leaf(left, merged, first))])
            node = changed + size
            tree[rows, node] = leaves
            while node[0, 0] > 1:
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])


    def walk(self, sym: list[int]) -> list[int]:
        """``merge`` for one row, on a tree of its own."""
        size, ranks, results = len(sym), self.rank_of, self.result_of
        after, before = [*range(1, size), -1], list(range(-1, size - 1))
        none = int(NO_PAIR)

        def leaf(left: int, right: int) -> int:
            """Rank and place of the pair of the symbols in two places."""
            if left < 0 or right < 0 or sym[right] < 0:
                return none
            rank = ranks.get(sym[left] * self.n_ids + sym[right])
            return none if rank is None else rank << PLACE_BITS | left

        tree = [none] * size + [leaf(i, after[i]) if sym[i] >= 0 else none for i in range(size)]
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(place: int, value: int) -> None:
            """Change a leaf, and the nodes above it as far as they change."""
            node = place + size
            while tree[node] != value:
                tree[node] = value
                if node == 1:
                    return
                other = tree[node ^ 1]
                node >>= 1
                if other < value:
                    value = other

        while tree[1] != none:
            best = tree[1]
            place = best & ((1 << PLACE_BITS) - 1)
            second, first = after[place], before[place]
            third = after[second]
            sym[place], sym[second] = results[best >> PLACE_BITS], -1
            after[place] = third
            if third >= 0:
                before[third] = place
            put(second, none)
            put(place, leaf(place, third))
            if first >= 0:
                put(first, leaf(first, place))
        return sym


class Memory:
    """What was worked out before, by key: at least the last ``keep`` keys, at most twice as many."""

    def __init__(self, keep: int):
        self.keep = keep
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, keys: set[str], learn: Callable[[list[str]], dict[str, bytes]]) -> dict[str, bytes]:
        """A table that holds all of the keys; unknown ones are learnt together."""
        if len(self.new) > self.keep:
            self.old, self.new = self.new, {}
        missing = keys - self.new.keys()
        known = missing & self.old.keys()
        self.new.update((k, self.old[k]) for k in known)
        unknown = list(missing - known)
        if unknown:
            self.new.update(learn(unknown))
        return self.new


class BytePairs:
    """Encoder and decoder of one vocabulary file.

    Chunks that were encoded before are looked up, and pieces that other chunks
    held; of both the last ``keep`` and more are remembered.
    """

    def __init__(self, path: str, keep: int = 100_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec["pre_tokenizer"]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or spec["normalizer"] or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"]:
            raise ValueError("only byte-level vocabularies without a normalizer are supported")
        special = spec["added_tokens"]
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in special):
            raise ValueError("only plain special tokens are supported")
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in special}
        n_ids = max([*vocab.values(), *self.special.values()]) + 1
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ids = lambda words: np.array([vocab[w] for w in words], dtype=np.int64)
        self.trees = PairTrees(ids(a for a, _ in merges), ids(b for _, b in merges), ids(a + b for a, b in merges), n_ids)
        letters = byte_letters()
        self.byte_ids = np.array([vocab.get(x, -1) for x in letters], dtype=np.int32)
        byte_of = {x: bytes([b]) for b, x in enumerate(letters)}
        self.token_bytes = [b""] * n_ids
        for token, i in [*vocab.items(), *self.special.items()]:
            known = all(c in byte_of for c in token)
            self.token_bytes[i] = b"".join(byte_of[c] for c in token) if known else token.encode()
        self.pieces, self.chunks = regex.compile(PIECES), re.compile(CHUNKS)
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if special else None
        self.keep = keep
        self.forget()

    def forget(self) -> None:
        """Drop what was learnt: a task learns most of its chunks early, and its worker goes on to other stages."""
        self.known, self.merged = Memory(self.keep), Memory(self.keep)

    def merge_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of each piece as little-endian 32-bit numbers; sizes of like trees go together."""
        raw = [p.encode() for p in pieces]
        lengths = np.array([len(r) for r in raw], dtype=np.int64)
        sizes = 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64)
        out: dict[str, bytes] = {}
        for size in np.unique(sizes).tolist():
            members = np.flatnonzero(sizes == size)
            for group in np.array_split(members, max(1, len(members) * size // (1 << 20))):
                rows = np.full((len(group), size), -1, dtype=np.int32)
                inside = np.arange(size) < lengths[group][:, None]
                rows[inside] = self.byte_ids[np.frombuffer(b"".join(raw[i] for i in group), np.uint8)]
                merged = self.trees.merge(rows)
                kept = merged >= 0
                flat, ends = merged[kept].astype("<u4").tobytes(), np.cumsum(kept.sum(axis=1)) * 4
                start = 0
                for i, end in zip(group.tolist(), ends.tolist(), strict=True):
                    out[pieces[i]] = flat[start:end]
                    start = end
        return out

    def learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks seen for the first time."""
        cut = [self.pieces.findall(c) for c in chunks]
        merged = self.merged.get({p for ps in cut for p in ps}, self.merge_pieces)
        return {c: merged[ps[0]] if len(ps) == 1 else b"".join([merged[p] for p in ps]) for c, ps in zip(chunks, cut, strict=True)}

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        parts = [self.splitter.split(t) if self.splitter else [t] for t in texts]
        cut = [[self.chunks.findall(p) if i % 2 == 0 else p for i, p in enumerate(ps)] for ps in parts]
        seen: set[str] = set()
        for ps in cut:
            for p in ps[::2]:
                seen.update(p)
        get = self.known.get(seen, self.learn).__getitem__
        out = []
        for ps in cut:
            ids = [b"".join(map(get, p)) if i % 2 == 0 else self.special[p].to_bytes(4, "little") for i, p in enumerate(ps)]
            out.append(b"".join(ids))
        return out

    def decode_bytes(self, ids: bytes) -> bytes:
        """The bytes behind ids."""
        return b"".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode(self, ids: bytes) -> str:
        """The text behind ids; bytes that are not UTF-8 become replacement characters."""
        return self.decode_bytes(ids).decode("utf-8", errors="replace")


_coders: dict[str, BytePairs] = {}


def coder(path: str) -> BytePairs:
    """The coder of a file, made once in each Python worker."""
    if path not in _coders:
        _coders[path] = BytePairs(path)
    return _coders[path]


ENCODED = "doc_id long, ids binary, n_tokens long, ids_sha256 string, decoded_sha256 string, decoded string"


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True, keep_decoded: bool = True) -> DataFrame:
    """Encode every whole text, decode the ids again, and return both with their digests.

    One row for each row of ``docs``, repeated rows and null ids included; a
    null text counts as empty and has no ids.  ``ids`` are little-endian
    unsigned 32-bit numbers.  Other columns of ``docs`` are not looked at.
    """

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path)
        for batch in text_slices(batches, "text", PIECE_BYTES):
            ids = bpe.encode(t or "" for t in batch.column("text").to_pylist())
            plain = [bpe.decode(i) for i in ids]
            columns = {
                "doc_id": batch.column("doc_id").cast(pa.int64()),
                "ids": pa.array(ids if keep_ids else [None] * len(ids), pa.binary()),
                "n_tokens": pa.array([len(i) // 4 for i in ids], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
                "decoded_sha256": pa.array([hashlib.sha256(p.encode()).hexdigest() for p in plain]),
                "decoded": pa.array(plain if keep_decoded else [None] * len(ids), pa.string()),
            }
            yield pa.RecordBatch.from_pydict(columns)
            del ids, plain, columns
            give_back()
        bpe.forget()

    return narrow(docs, doc_id=id_col, text=text_col).mapInArrow(run, ENCODED)
