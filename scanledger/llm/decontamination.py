"""Benchmark items inside documents: containment search by sizes of items.

Items are parted by size, doubling from class to class.  Of an item's distinct
word shingles the smallest hashes are its sketch, a bottom-k MinHash, whose
length follows from the largest size of its class: at a containment of ``t`` an
item of n shingles can miss at most (1 - t) n of them, so a document that holds
it hits all but that many of the sketch.  Documents look every shingle up among
the sketches; the items with enough hits are compared shingle by shingle.

A long document costs one lookup for each of its shingles, whatever its length,
and nothing is lost: the needed hits are a bound and not an estimate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from scanledger.llm.common import PIECE_BYTES, narrow, released, staged, text_slices
from scanledger.llm.words import NOT_ALPHANUMERIC, Words

WIDTH = 5
CONTAINMENT = 80
#: Shingles of items that are held by a task at once; more items go in further passes.
BLOCK_SHINGLES = 2_000_000
FILTER_BITS = 22


def lowered(texts: pa.Array) -> Words:
    """Words of the small letters of texts, cut at ASCII characters that are neither letters nor digits."""
    return Words(pc.utf8_lower(texts), NOT_ALPHANUMERIC)


def word_shingles(words: list[bytes], width: int) -> set[tuple[bytes, ...]]:
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


class ItemIndex:
    """Sketches of items by shingle width, and the items' own shingles to verify with."""

    def __init__(self, item_ids: list, texts: list[str], width: int = WIDTH, percent: int = CONTAINMENT):
        self.percent, self.items = percent, []
        sketches: dict[int, list[tuple[np.ndarray, int]]] = {}
        words = lowered(pa.array(texts, pa.string()))
        for i, name in enumerate(item_ids):
            own = words.of(i)
            if not own:
                continue
            w = min(width, len(own))
            one = lowered(pa.array([texts[i]], pa.string()))
            hashes = np.unique(one.shingles(w)[0])
            largest = (1 << len(hashes).bit_length()) - 1
            keep = min(len(hashes), 2 * (largest * (100 - percent) // 100) + 1)
            needed = max(1, keep - len(hashes) * (100 - percent) // 100)
            sketches.setdefault(w, []).append((hashes[:keep], len(self.items)))
            self.items.append((name, w, needed, word_shingles(own, w)))
        self.tables = {}
        for w, parts in sketches.items():
            keys = np.concatenate([k for k, _ in parts])
            owners = np.repeat([n for _, n in parts], [len(k) for k, _ in parts])
            order = np.argsort(keys, kind="stable")
            present = np.zeros(1 << FILTER_BITS, dtype=bool)
            present[keys >> np.uint64(64 - FILTER_BITS)] = True
            self.tables[w] = (keys[order], owners[order], present)

    def hits(self, words: Words) -> Iterator[tuple[int, int]]:
        """Documents and items with the needed number of sketch shingles in common."""
        for w, (keys, owners, present) in self.tables.items():
            hashes, bounds = words.shingles(w)
            maybe = np.flatnonzero(present[hashes >> np.uint64(64 - FILTER_BITS)])
            low, high = np.searchsorted(keys, hashes[maybe], "left"), np.searchsorted(keys, hashes[maybe], "right")
            found = high > low
            maybe, low, high = maybe[found], low[found], high[found]
            doc = np.searchsorted(bounds, maybe, side="right") - 1
            # Each sketch shingle counts once for a document.
            once = np.unique(np.stack([doc, low, high]), axis=1) if len(doc) else np.zeros((3, 0), np.int64)
            doc, low, size = once[0], once[1], once[2] - once[1]
            owner = owners[np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())]
            pairs, counts = np.unique(np.stack([np.repeat(doc, size), owner]), axis=1, return_counts=True)
            for d, item, n in zip(*pairs.tolist(), counts.tolist(), strict=True):
                if n >= self.items[item][2]:
                    yield d, item

    def found(self, texts: pa.Array) -> Iterator[tuple[int, object, int, int]]:
        """Row, item, its shingles, and how many of them the row's text holds, where these are enough."""
        words = lowered(texts)
        sets: dict[tuple[int, int], set] = {}
        for row, item in sorted(self.hits(words)):
            name, w, _, own = self.items[item]
            if (row, w) not in sets:
                sets = {(row, w): word_shingles(words.of(row), w)}
            shared = len(own & sets[row, w])
            if 100 * shared >= self.percent * len(own):
                yield row, name, len(own), shared


def item_blocks(items: DataFrame, item_id: str, item_text: str, block: int) -> Iterator[tuple[list, list[str]]]:
    """The items in blocks of about ``block`` words, each small enough for every task.

    The number of blocks follows from the words of all items.
    """
    rows = narrow(items, item_id=item_id, text=item_text).where("text IS NOT NULL").dropDuplicates()
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (4 * block)))
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        yield [r[0] for r in part], [r[1] for r in part]


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", percent: int = CONTAINMENT, block: int = BLOCK_SHINGLES) -> DataFrame:
    """Rows (doc_id, item_id, n_shingles, n_shared) for documents that hold items.

    An item is held if at least ``percent`` of its distinct five-word shingles
    are in the document; one with fewer words counts as a single shingle.  Null
    and empty texts hold and are nothing.  Repeated document rows give repeated
    results, repeated item rows do not.
    """
    source = narrow(docs, doc_id=id_col, text=text_col)
    kind = items.schema[item_id].dataType
    schema = f"doc_id long, item_id {kind.simpleString()}, n_shingles long, n_shared long"
    out = None
    for names, texts in item_blocks(items, item_id, item_text, block):
        sent = docs.sparkSession.sparkContext.broadcast((names, texts))

        @released
        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(*sent.value, percent=percent)
            for batch in text_slices(batches, "text", PIECE_BYTES):
                found = list(index.found(batch.column("text")))
                ids = batch.column("doc_id").cast(pa.int64()).to_pylist()
                columns = [[ids[f[0]] for f in found], *([f[i] for f in found] for i in (1, 2, 3))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, wire, strict=True)], ["doc_id", "item_id", "n_shingles", "n_shared"])

        wire = [pa.int64(), to_arrow_type(kind), pa.int64(), pa.int64()]
        part = source.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def drop_holders(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", percent: int = CONTAINMENT, block: int = BLOCK_SHINGLES) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns.

    One block of items is looked for after the other, and what is left is
    written down in between, so a task holds the index of one block.
    """
    out, before = docs, False
    for names, texts in item_blocks(items, item_id, item_text, block):
        sent = docs.sparkSession.sparkContext.broadcast((names, texts))

        @released
        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(*sent.value, percent=percent)
            for batch in text_slices(batches, text_col, PIECE_BYTES):
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[f[0] for f in index.found(batch.column(text_col))]] = False
                yield batch.filter(pa.array(keep))

        out = (staged(out, "without-items") if before else out).mapInArrow(run, docs.schema)
        before = True
    return out
