"""Aligned tokens and counted links beside a plain loop over tokens, on awkward rows."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from scanledger.llm import alignment
from scanledger.llm.queries import token_alignment

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOC = "doc_id long, text string, slice string, docs long, n_a long"


def by_hand(rows):
    """The result by a loop over tokens and one dictionary of all links."""
    both, library = alignment.TwoTokenizers(*PATHS), Tokenizer.from_file(PATHS[0])
    library.encode_special_tokens = True
    counts, texts = Counter(), []
    for i, text in rows:
        a, b = library.encode(" " + (text or ""), add_special_tokens=False).ids, both.b.encode(text or "")
        whole = b" " + (text or "").encode()
        groups, links = [], []
        if text and b"".join(both.bytes_a[x] for x in a) == whole == b"".join(both.bytes_b[x] for x in b):
            ends, at = {}, 0
            for k, x in enumerate(a):
                at += len(both.bytes_a[x])
                ends[at] = k
            at = first_a = first_b = 0
            for k, x in enumerate(b):
                at += len(both.bytes_b[x])
                if at in ends:
                    groups.append(",".join(map(str, a[first_a : ends[at] + 1])) + "|" + ",".join(map(str, b[first_b : k + 1])))
                    links.append((a[ends[at]], x))
                    first_a, first_b = ends[at] + 1, k + 1
        else:
            a = b = []
        counts.update(links)
        texts.append((i, len(a), len(b), groups, links))
    top = {}
    for (_, x), n in counts.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for i, n_a, n_b, groups, links in texts:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((i, n_a, n_b, len(groups), len(links), sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links), digest))
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
order = lambda rows: sorted(rows, key=lambda r: [(x is not None, x) for x in r])


@pytest.fixture(scope="module")
def awkward():
    texts = [None, "", " ", "a", "the cat sat on the mat", " leading  blanks\n\nand lines\t", "▁ piece mark", "<|endoftext|> </s> <0x0A> <unk>", "é 漢字 😀 ﬁ", "a" * 5000]
    texts += ["the " * 3000, "x\r\n" * 40, "\x00 null", "zzz", "ending s", "the cat sat on the mat"]
    rows = list(enumerate(texts))
    return [*rows, rows[4], (None, "the cat"), (None, None)]


def test_rows(spark, awkward, monkeypatch):
    df = spark.createDataFrame([(*r, "s", 1, 2) for r in awkward], DOC).repartition(5)
    found = alignment.align_texts(df, *PATHS)
    assert order(tuple(r[c] for c in COLUMNS) for r in found.collect()) == order(by_hand(awkward))
    one = found.where("doc_id = 3").first()
    assert one.groups.count(";") == one.n_groups - 1 and hashlib.sha256(one.groups.encode()).hexdigest() == one.groups_sha256
    assert alignment.align_texts(spark.createDataFrame([], DOC), *PATHS).count() == 0


def test_query_with_many_rounds(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(alignment, "FAN_IN", 2)
    monkeypatch.setattr(alignment, "SLICE", 1 << 16)
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = token_alignment(spark, sf_dir)
    assert order(tuple(r[c] for c in COLUMNS) for r in found.collect()) == order(by_hand(texts))


def test_merge_is_a_sum():
    random = np.random.default_rng(1)
    parts, whole = [], Counter()
    for _ in range(5):
        pairs = np.unique(random.integers(0, 70_000, 40_000))
        counts = random.integers(1, 9, len(pairs))
        whole.update(dict(zip(pairs.tolist(), counts.tolist(), strict=True)))
        parts.append((alignment.pack(np.diff(pairs, prepend=0)), alignment.pack(counts)))
    pairs, counts = alignment.merged(parts)
    assert dict(zip(pairs.tolist(), counts.tolist(), strict=True)) == whole and (np.diff(pairs) > 0).all()
    empty = alignment.merged([])
    assert len(empty[0]) == 0 and len(alignment.highest(*empty, 10)) == 0


def test_highest_keeps_ties():
    pairs, counts = np.array([3, 5, 12, 17, 18]), np.array([2, 2, 1, 7, 3])
    assert alignment.highest(pairs, counts, 10).tolist() == [1, 1, 0, 1, 0]


def test_every_character_is_the_library_s():
    both, library = alignment.TwoTokenizers(*PATHS), Tokenizer.from_file(PATHS[0])
    texts = [f" a{chr(c)}{chr(c)}b {chr(c)}" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(texts), 1 << 14):
        part = texts[start : start + (1 << 14)]
        assert [both.a.encode_ordinary(t) for t in part] == [e.ids for e in library.encode_batch_fast(part, add_special_tokens=False)]
