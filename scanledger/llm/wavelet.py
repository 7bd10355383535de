"""Token ids in wavelet matrix files: one compressed file for each shard.

A shard holds the ids of consecutive documents.  Its file keeps, for each bit
of the ids from the highest to the lowest, a plane with that bit of every id,
where each plane's order is the one before, stably parted by its bit.  Rank on
the planes gives an id by place, the number of times an id occurs, and where.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from scanledger.llm.bpe import SPACE, Memory
from scanledger.llm.common import narrow, staged, text_slices
from scanledger.llm.words import BLANKS, raw_bytes

MAGIC = b"WMX2"
HEAD = struct.Struct("<4sQQB")
PLANE = struct.Struct("<QQ")
NO_ID = -(1 << 63)
#: Holds words apart while they are normalized together.
APART = "\x01"
#: A cut that leaves runs of letters, single digits and runs of other signs, and what may come before it.
PLAIN_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN_STEPS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
#: Kinds of bytes; a word with an odd one is not cut by bytes.
BLANK, LETTER, DIGIT, SIGN, ODD = range(5)
#: Bits of a block of a plane, which is compressed by itself, and blocks of a plane that are held unpacked.
BLOCK, HELD = 1 << 16, 64


class Plane:
    """Bits in compressed blocks, with the number of ones before each block."""

    def __init__(self, size: int, ones: np.ndarray, blocks: list[bytes]):
        self.size, self.ones, self.blocks = size, ones, blocks
        self.unpacked: dict[int, np.ndarray] = {}

    @classmethod
    def of(cls, bits: np.ndarray) -> Plane:
        pack = zstandard.ZstdCompressor(level=1).compress
        data = np.packbits(bits, bitorder="little")
        parts = [data[i : i + BLOCK // 8] for i in range(0, len(data), BLOCK // 8)]
        ones = np.concatenate([[0], np.cumsum([int(np.bitwise_count(x).sum()) for x in parts])]).astype(np.int64)
        return cls(len(bits), ones, [pack(x.tobytes()) for x in parts])

    def block(self, i: int) -> np.ndarray:
        """The bytes of a block; a few blocks stay unpacked."""
        found = self.unpacked.get(i)
        if found is None:
            if len(self.unpacked) >= HELD:
                self.unpacked.clear()
            found = self.unpacked[i] = np.frombuffer(zstandard.ZstdDecompressor().decompress(self.blocks[i]), np.uint8)
        return found

    def data(self) -> np.ndarray:
        unpack = zstandard.ZstdDecompressor().decompress
        return np.frombuffer(b"".join(unpack(x) for x in self.blocks), np.uint8)

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.data(), count=self.size, bitorder="little").view(bool)

    def rank(self, place: int) -> int:
        """Ones before a place: those before its block, from the table, and those in it."""
        i, inside = divmod(place, BLOCK)
        if not inside:
            return int(self.ones[i])
        block, byte = self.block(i), inside // 8
        ones = int(self.ones[i]) + int(np.bitwise_count(block[:byte]).sum())
        return ones + (int(block[byte]) & ((1 << inside % 8) - 1)).bit_count() if inside % 8 else ones

    def ranks(self, places: np.ndarray) -> np.ndarray:
        """``rank`` of many places, in one pass over the plane."""
        data = np.append(self.data(), np.uint8(0))
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(data), dtype=np.int64)])
        masks = ((1 << (places % 8)) - 1).astype(np.uint8)
        return before[places // 8] + np.bitwise_count(data[places // 8] & masks)

    def select(self, bit: int, nth: int) -> int:
        """Place of the nth (from 0) bit of that value: its block by the table, then the place in it."""
        edges = np.minimum(np.arange(len(self.ones)) * BLOCK, self.size)
        before = self.ones if bit else edges - self.ones
        i = int(np.searchsorted(before, nth, side="right")) - 1
        inside = np.unpackbits(self.block(i), count=int(edges[i + 1] - edges[i]), bitorder="little")
        return int(edges[i]) + int(np.flatnonzero(inside == bit)[nth - int(before[i])])


class WaveletMatrix:
    """A sequence of ids as bit planes with rank and select."""

    def __init__(self, size: int, planes: list[Plane]):
        self.size, self.planes = size, planes
        self.zeros = [size - int(p.ones[-1]) for p in planes]

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        width = max(int(ids.max()).bit_length(), 1) if len(ids) else 1
        seq = ids.astype(np.uint16 if width <= 16 else np.uint32)
        planes = []
        for level in range(width - 1, -1, -1):
            ones = (seq & seq.dtype.type(1 << level)) != 0
            planes.append(Plane.of(ones))
            seq = np.concatenate([seq[~ones], seq[ones]])
        return cls(len(ids), planes)

    def access(self, place: int) -> int:
        """The id at a place."""
        if not 0 <= place < self.size:
            raise IndexError(place)
        value = 0
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            ones = plane.rank(place)
            bit = plane.rank(place + 1) - ones
            place = zeros + ones if bit else place - ones
            value = value << 1 | bit
        return value

    def _span(self, token: int, start: int, end: int) -> tuple[int, int]:
        """Where a stretch's occurrences of an id lie behind the last plane."""
        if token < 0 or token >> len(self.planes):
            return 0, 0
        for level, zeros in enumerate(self.zeros):
            a, b = self.planes[level].rank(start), self.planes[level].rank(end)
            start, end = (zeros + a, zeros + b) if token >> (len(self.planes) - 1 - level) & 1 else (start - a, end - b)
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often an id occurs in a stretch."""
        first, last = self._span(token, start, self.size if end is None else end)
        return last - first

    def counts(self, token: int, edges: np.ndarray) -> np.ndarray:
        """How often an id occurs between each two neighbouring places."""
        if token < 0 or token >> len(self.planes):
            return np.zeros(max(len(edges) - 1, 0), np.int64)
        places = edges.astype(np.int64)
        for level, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            ones = plane.ranks(places)
            places = zeros + ones if token >> (len(self.planes) - 1 - level) & 1 else places - ones
        return np.diff(places)

    def occurrences(self, token: int, start: int = 0, end: int | None = None) -> Iterator[int]:
        """The places of an id in a stretch, in rising order."""
        first, last = self._span(token, start, self.size if end is None else end)
        for place in range(first, last):
            for level in range(len(self.planes) - 1, -1, -1):
                bit = token >> (len(self.planes) - 1 - level) & 1
                place = self.planes[level].select(bit, place - self.zeros[level] if bit else place)
            yield place

    def ids(self) -> np.ndarray:
        """The whole sequence: the parting of each plane undone, the lowest bit first."""
        seq = np.zeros(self.size, dtype=np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level in range(len(self.planes) - 1, -1, -1):
            ones = self.planes[level].bits()
            back = np.empty_like(seq)
            back[~ones] = seq[: self.zeros[level]]
            back[ones] = seq[self.zeros[level] :] | seq.dtype.type(1 << (len(self.planes) - 1 - level))
            seq = back
        return seq


def write_shard(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """A file's bytes: head, document table, and for each plane a table of its blocks and these."""
    matrix, pack = WaveletMatrix.of(ids), zstandard.ZstdCompressor(level=1).compress
    docs = pack(np.array([NO_ID if d is None else d for d in doc_ids], dtype="<i8").tobytes() + lengths.astype("<u8").tobytes())
    out = [HEAD.pack(MAGIC, len(ids), len(doc_ids), len(matrix.planes)), struct.pack("<Q", len(docs)), docs]
    for plane in matrix.planes:
        ends = np.cumsum([0, *map(len, plane.blocks)])
        table = pack(plane.ones.astype("<i8").tobytes() + ends.astype("<i8").tobytes())
        out += [PLANE.pack(len(table), int(ends[-1])), table, *plane.blocks]
    return b"".join(out)


def read_shard(raw: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Document ids, their numbers of ids, and the matrix of a file, whose blocks are unpacked when they are asked for."""
    magic, size, n_docs, width = HEAD.unpack_from(raw)
    if magic != MAGIC:
        raise ValueError("not a wavelet matrix file")
    view, unpack = memoryview(raw), zstandard.ZstdDecompressor().decompress
    at = HEAD.size + 8 + struct.unpack_from("<Q", raw, HEAD.size)[0]
    docs = np.frombuffer(unpack(view[HEAD.size + 8 : at]), "<i8")
    planes = []
    for _ in range(width):
        table_size, blocks_size = PLANE.unpack_from(raw, at)
        at += PLANE.size
        table = np.frombuffer(unpack(view[at : at + table_size]), "<i8")
        at += table_size
        ones, ends = np.split(table, 2)
        planes.append(Plane(size, ones, [view[at + s : at + e] for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]))
        at += blocks_size
    return [None if d == NO_ID else d for d in docs[:n_docs].tolist()], docs[n_docs:].astype(np.int64), WaveletMatrix(size, planes)


class WordEncoder:
    """Encodes texts with the tokenizers library, each distinct piece once.

    Only for tokenizers that drop white space between words, so that the words
    of a text are encoded apart: :func:`checked` says which do.  Words are
    normalized and cut as the file says; words that hold a special token or the
    sign that holds words apart here go to the library as they are.

    Where the file cuts letters, digits and signs apart, words of ASCII and the
    letters of Latin-1 are cut and lowered as bytes, all words of a batch at once.
    """

    def __init__(self, path: str, keep: int = 400_000):
        # A task has one core: the library's own threads would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = checked(path)
        self.words, self.pieces = Memory(keep), Memory(keep)
        spec = json.loads(self.tokenizer.to_str())
        cut, suffix = spec["pre_tokenizer"], spec["model"].get("end_of_word_suffix")
        steps = cut.get("pretokenizers") or []
        split = steps[0] if len(steps) == 2 and steps[0]["type"] == "Split" and steps[1]["type"] == "ByteLevel" else None
        self.cut = None
        if suffix and split and split["behavior"] == "Removed" and split["invert"] and "Regex" in split["pattern"] and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]:
            self.cut = regex.compile(split["pattern"]["Regex"].replace(r"\s", SPACE))
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocab.items() if suffix and t.endswith(suffix)]] = True
        special = [t["content"] for t in spec["added_tokens"]]
        self.whole = re.compile("|".join(map(re.escape, [APART, *special])))
        self.kinds = None
        if self.cut and split["pattern"]["Regex"] == PLAIN_CUT and (spec["normalizer"] or {}).get("normalizers") == PLAIN_STEPS and not any(t[:1].isalnum() for t in special):
            self.kinds = byte_kinds(special)
        # For parts that are normalized and cut for sure; the library's own cut differs for some letters.
        self.bare = Tokenizer.from_str(self.tokenizer.to_str())
        if self.kinds is not None:
            self.bare.normalizer = None
            self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])

    def parts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Words of all texts, or what they are cut to, behind each other, and their bounds by text."""
        if self.kinds is None:
            cut = pc.ascii_split_whitespace(texts.fill_null(""))
            return cut.flatten(), cut.offsets.to_numpy() - cut.offsets[0].as_py()
        data, offsets = raw_bytes(texts)
        kinds, lowered = self.kinds[data], np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        # The letters of Latin-1 are a byte C3 and one from 80 on.
        lead = np.flatnonzero(data == 0xC3)
        second = data[lead + 1]
        latin = (second != 0x97) & (second != 0xB7)
        lead, second = lead[latin], second[latin]
        kinds[lead] = kinds[lead + 1] = LETTER
        lowered[lead + 1] = np.where(second <= 0x9E, second + np.uint8(32), second)
        starts = np.ones(len(data), dtype=bool)
        starts[1:] = kinds[1:] != kinds[:-1]
        starts |= kinds == DIGIT
        starts[offsets[:-1][offsets[:-1] < len(data)]] = True
        gap = kinds == BLANK
        odd = np.flatnonzero(kinds == ODD)
        if len(odd):
            words = np.ones(len(data), dtype=bool)
            words[1:] = gap[1:] != gap[:-1]
            words[offsets[:-1][offsets[:-1] < len(data)]] = True
            first = np.flatnonzero(words)
            of = np.unique(np.searchsorted(first, odd, side="right") - 1)
            sizes = np.append(first[1:], len(data))[of] - first[of]
            inside = np.repeat(first[of] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            starts[inside] = False
            starts[first[of]] = True
            lowered[inside] = data[inside]
        starts &= ~gap
        ends = np.append(np.flatnonzero(starts[~gap]), len(data) - np.count_nonzero(gap)).astype(np.int32)
        flat = pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(lowered[~gap]))
        return flat, np.searchsorted(np.flatnonzero(starts), offsets)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers; a null text has none.

        Parts of words are told apart and counted by Arrow, so Python sees each
        part of the texts once, and their ids are put together as one array.
        """
        flat, bounds = self.parts(texts)
        coded = flat.dictionary_encode()
        words = coded.dictionary.to_pylist()
        each = list(map(self.words.get(set(words), self.learn).__getitem__, words))
        ids, sizes = np.frombuffer(b"".join(each), "<u4"), np.fromiter(map(len, each), np.int64, len(each)) // 4
        of = coded.indices.to_numpy()
        n = sizes[of]
        ends = np.cumsum(n)
        first = (np.cumsum(sizes) - sizes)[of] - (ends - n)
        ids = ids[np.repeat(first, n) + np.arange(len(first) and ends[-1])]
        edges = np.append(0, ends)[bounds].tolist()
        return [ids[s:e].tobytes() for s, e in zip(edges[:-1], edges[1:], strict=True)]

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words, or parts of them, seen for the first time."""
        if self.kinds is not None:
            whole = [w for w in words if not PLAIN_PART.fullmatch(w)]
            if len(whole) < len(words):
                cut = self.encode_pieces([w for w in words if PLAIN_PART.fullmatch(w)], self.bare)
                return cut | (self.learn(whole) if whole else {})
        plain = [w for w in words if self.cut and not self.whole.search(w)]
        normal = self.tokenizer.normalizer.normalize_str(APART.join(plain)).split(APART) if plain and self.tokenizer.normalizer else plain
        cut = list(map(self.cut.findall, normal)) if plain else []
        known = self.pieces.get({p for ps in cut for p in ps}, self.encode_pieces) if cut else {}
        out = {w: known[ps[0]] if len(ps) == 1 else b"".join([known[p] for p in ps]) for w, ps in zip(plain, cut, strict=True)}
        rest = [w for w in words if w not in out]
        return out | dict(zip(rest, self.encode_words(rest), strict=True))

    def encode_pieces(self, pieces: list[str], tokenizer: Tokenizer | None = None, together: int = 2000) -> dict[str, bytes]:
        """Ids of each piece; many go to the library as one text, in which only the last token of a piece ends a word."""
        groups = [pieces[i : i + together] for i in range(0, len(pieces), together)]
        out: dict[str, bytes] = {}
        for group, found in zip(groups, (tokenizer or self.tokenizer).encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(found.ids, dtype="<u4")
            ends = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            raw = ids.tobytes()
            if len(ends) == len(group):
                out.update(zip(group, [raw[s:e] for s, e in zip([0, *ends[:-1]], ends, strict=True)], strict=True))
            else:
                out.update(zip(group, self.encode_words(group), strict=True))
        return out

    def encode_words(self, words: list[str], together: int = 2000) -> list[bytes]:
        """Ids of each word; many go to the library as one text, whose tokens are told apart by where they start."""
        groups = [words[i : i + together] for i in range(0, len(words), together)]
        out = []
        for group, found in zip(groups, self.tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            starts = np.cumsum([0, *(len(w) + 1 for w in group)])
            owner = np.searchsorted(starts, np.array([s for s, _ in found.offsets], dtype=np.int64), side="right") - 1
            ends = np.cumsum(np.bincount(owner, minlength=len(group))) * 4
            ids = np.array(found.ids, dtype="<u4").tobytes()
            out += [ids[s:e] for s, e in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
        return out


#: Parts that are normalized and cut for sure; others are learnt as words are.
PLAIN_PART = re.compile(r"[a-zß-öø-ÿ]+|[0-9]")


def byte_kinds(special: list[str]) -> np.ndarray:
    """The kind of each byte; those that begin a special token, and apostrophes, are odd."""
    kinds = np.full(256, ODD, dtype=np.uint8)
    kinds[33:127] = SIGN
    kinds[[*range(65, 91), *range(97, 123)]] = LETTER
    kinds[48:58] = DIGIT
    kinds[[ord("'"), *(t.encode()[0] for t in special if t)]] = ODD
    kinds[np.frombuffer(BLANKS, np.uint8)] = BLANK
    return kinds


def checked(path: str) -> Tokenizer:
    """The tokenizer of a file, without truncation and padding, if its words stand apart."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    first = tokenizer.pre_tokenizer.pre_tokenize_str("a b\nc") if tokenizer.pre_tokenizer else []
    if not re.fullmatch(r"[^\s]+", "".join(w for w, _ in first)) or len(first) != 3:
        raise ValueError("only tokenizers that drop white space are supported")
    return tokenizer


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of a file, made once in each Python worker."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


SHARDS = "first_doc long, seq int, n_docs long, n_ids long, file binary"


def write_files(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None, shard_ids: int = 4_000_000) -> DataFrame:
    """Encode every whole text and write shard files in ascending document order.

    Texts are dealt out by ranges of their id, so shards in the order of their
    first document (null first) and of ``seq`` hold the documents in order.  A
    shard is closed at the document that brings it to ``shard_ids``; no document
    is cut.  A null text is empty; ``end_id`` follows each document.  Rows under
    one id are documents of their own, in the order of their texts.

    The files are rows of a table in the shared folder, one file in each, so
    Spark's commit holds and any store it reads will do.
    """
    source = narrow(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    partitions = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = source.repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id", "text")
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, held, size, names = 0, [], 0, []

        def shard() -> pa.RecordBatch:
            lengths = np.array([len(h) // 4 for h in held], dtype=np.int64)
            file = write_shard(names, lengths, np.frombuffer(b"".join(held), "<u4"))
            values = [[names[0]], [seq], [len(names)], [int(lengths.sum())], [file]]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], ["first_doc", "seq", "n_docs", "n_ids", "file"])

        for batch in text_slices(batches, "text"):
            for name, ids in zip(batch.column("doc_id").to_pylist(), encoder(path).encode(batch.column("text")), strict=True):
                names.append(name)
                held.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= shard_ids:
                    yield shard()
                    seq, held, size, names = seq + 1, [], 0, []
        if names:
            yield shard()

    return staged(dealt.mapInArrow(run, SHARDS), "wavelet")


DOCUMENTS = "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long, n_counted long"


def read_files(files: DataFrame, keep_ids: bool = True, counted: int = -1) -> DataFrame:
    """The documents of shard files with their ids, where each starts, and a checksum.

    ``n_counted`` says how often the id ``counted`` occurs in each, by ranks.
    Only the shards' sizes are put in order in one place, a row for each shard.
    """
    order = Window.orderBy(F.col("first_doc").asc_nulls_first(), "seq").rowsBetween(Window.unboundedPreceding, -1)
    begins = files.select("first_doc", "seq", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("begin"))
    located = files.select("first_doc", "seq", "file").join(begins.withColumnsRenamed({"first_doc": "f", "seq": "s"}), F.col("first_doc").eqNullSafe(F.col("f")) & (F.col("seq") == F.col("s")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, file in zip(batch.column("begin").to_pylist(), batch.column("file"), strict=True):
                names, lengths, matrix = read_shard(file.as_py())
                ids, ends = matrix.ids().astype("<u4"), np.cumsum(lengths)
                each = [ids[e - n : e].tobytes() for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(names, pa.int64()),
                        "start": pa.array(begin + ends - lengths, pa.int64()),
                        "n_tokens": pa.array(lengths, pa.int64()),
                        "ids": pa.array(each if keep_ids else [None] * len(each), pa.binary()),
                        "ids_crc32": pa.array([zlib.crc32(x) for x in each], pa.int64()),
                        "n_counted": pa.array(matrix.counts(counted, np.append(0, ends)), pa.int64()),
                    }
                )

    return located.select("begin", "file").mapInArrow(run, DOCUMENTS)


def count_tokens(files: DataFrame, tokens: Iterable[int]) -> DataFrame:
    """token, n: how often each of some ids occurs in all shards; ids that occur nowhere count 0.

    Of each file two blocks of a plane are unpacked for an id.
    """
    wanted = sorted(set(tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file"):
                matrix = read_shard(file.as_py())[2]
                yield pa.RecordBatch.from_pydict({"token": pa.array(wanted, pa.int64()), "n": pa.array([matrix.count(t) for t in wanted], pa.int64())})

    none = files.sparkSession.createDataFrame([(t, 0) for t in wanted], "token long, n long")
    return files.select("file").mapInArrow(run, "token long, n long").unionByName(none).groupBy("token").agg(F.sum("n").alias("n"))


def find_token(files: DataFrame, token: int) -> DataFrame:
    """doc_id, place: every place of an id, counted from the document's first; by select, without undoing the planes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file"):
                names, lengths, matrix = read_shard(file.as_py())
                ends = np.cumsum(lengths)
                places = np.fromiter(matrix.occurrences(token), np.int64)
                owner = np.searchsorted(ends, places, side="right")
                docs = pa.array([names[i] for i in owner.tolist()], pa.int64())
                yield pa.RecordBatch.from_pydict({"doc_id": docs, "place": pa.array(places - (ends - lengths)[owner], pa.int64())})

    return files.select("file").mapInArrow(run, "doc_id long, place long")
