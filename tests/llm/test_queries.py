"""The registered queries beside their SQL, and the pipeline's stages."""

import hashlib
import re
from itertools import combinations

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from scanledger.llm import credentials
from scanledger.llm.common import staged
from scanledger.llm.queries import all_checks, all_queries
from tools.check_queries import TABLES, compare


@pytest.mark.parametrize("name", sorted(all_checks()))
def test_query(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.001/{table}.parquet'")
    outcome = compare(spark, con, "/root/testdata/sf0.001", name, all_queries()[name], all_checks()[name])
    assert outcome.startswith("ok"), outcome


def test_all_are_registered():
    assert {*all_queries(), "pipeline"} <= set(contract.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in all_queries()) == list(range(1, 14))


def shingles(text, width=5):
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(found[i : i + width]) for i in range(len(found) - width + 1)) if len(found) >= width else frozenset([tuple(found)] if found else [])


def test_pipeline_stages_by_hand(spark, sf_dir):
    """Each stage beside a plain statement of what it leaves, on what the one before left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    left, texts = {}, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
        left[name] = {r.doc_id: r for r in docs.collect()}
        if name != "bpe":
            assert docs.schema.names == spark.read.parquet(f"{sf_dir}/documents.parquet").schema.names

    base = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) >= 20
    assert all(base(r.text) for r in left["quality"].values()) and len(left["quality"]) > len(texts) // 2
    assert all(r.text == texts[i] for i, r in left["quality"].items())

    sets = {i: shingles(r.text) for i, r in left["quality"].items()}
    smallest = {i: i for i in sets}

    def root(i):
        while smallest[i] != i:
            i = smallest[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            smallest[y] = x
    assert set(left["near_copies"]) == {i for i in sets if root(i) == i}

    plain = lambda t: re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (t or "").lower())
    items = [plain(r.text) for r in benchmark]
    items = [{tuple(w[i : i + min(5, len(w))]) for i in range(len(w) - min(5, len(w)) + 1)} for w in items if w]

    def holds(text):
        w = plain(text)
        own = {n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} for n in range(1, 6)}
        return any(100 * len(item & own[len(next(iter(item)))]) >= 80 * len(item) for item in items)

    assert set(left["decontamination"]) == {i for i, r in left["near_copies"].items() if not holds(r.text)}
    assert set(left["secrets"]) == set(left["decontamination"]) == set(left["bpe"])
    for i, r in left["secrets"].items():
        spans = [(s, e) for _, s, e in credentials.linked_spans(left["decontamination"][i].text or "")]
        assert all(left["decontamination"][i].text[s:e] not in r.text for s, e in spans if e - s > 12)
        assert r.text == left["decontamination"][i].text or "[SECRET]" in r.text
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, r in left["bpe"].items():
        ids = np.array(library.encode(left["secrets"][i].text or "", add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert (r.n_tokens, bytes(r.ids), r.ids_sha256) == (len(ids) // 4, ids, hashlib.sha256(ids).hexdigest())


def test_pipeline_of_nothing(spark, sf_dir):
    """Empty tables, and null ids and texts, pass through every stage."""
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    for rows in ([], [(None,) * len(schema), (1, *(None,) * (len(schema) - 1)), (1, *(None,) * (len(schema) - 1))]):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = staged(stage(spark, docs, sf_dir), name)
        assert docs.count() == 0


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = corpus_pipeline.run(spark, sf_dir).collect()
    ids = [r.doc_id for r in out]
    assert 0 < len(ids) == len(set(ids)) < docs.count()
    assert all(len(r.ids) == 4 * r.n_tokens for r in out)
