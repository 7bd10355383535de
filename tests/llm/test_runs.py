"""Periodic runs beside a scan of every lag, on awkward rows."""

import hashlib
import random

import pytest

from scanledger.llm import runs
from scanledger.llm.queries import word_runs

DOC = "doc_id long, text string, runs string, best long"


def every_run(words):
    """Runs by definition: every lag, every stretch, every smaller period."""
    out, n = [], len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(24, 3 * q):
                said = words[start : start + length]
                if not any(all(said[k] == said[k + d] for k in range(length - d)) for d in range(1, q)):
                    out.append((start, length, q))
            i += i == start
    return sorted(out, key=lambda r: (r[0], r[2]))


def repeating(seed, n, size, repeats):
    chance = random.Random(seed)
    words = [b"%d" % chance.randrange(size) for _ in range(n)]
    for _ in range(repeats if n else 0):
        first, period = chance.randrange(n), chance.choice([1, 2, 3, 5, 8, 11, 20])
        for i in range(first + period, min(n, first + chance.randrange(10, 120))):
            words[i] = words[i - period]
    return words


@pytest.mark.parametrize("seed", range(6))
def test_runs_are_those_of_every_lag(seed):
    texts = [repeating(f"{seed}-{i}", n, size, repeats) for i, (n, size, repeats) in enumerate((n, s, r) for n in (0, 23, 24, 80, 200) for s in (1, 2, 5, 60) for r in (0, 2, 4))]
    assert [[tuple(r) for r in found] for found in runs.find_runs(texts)] == [every_run(t) for t in texts]


def test_long_texts():
    one = runs.find_runs([[b"a"] * 200_000])[0]
    assert one == [runs.Run(0, 200_000, 1)]
    planted = [b"%d" % (i % 30_011) for i in range(100_000)]
    assert runs.find_runs([[b"x"] + planted + [b"y"]])[0] == [runs.Run(1, 100_000, 30_011)]
    chance = random.Random(1)
    blocks = [w for _ in range(3000) for w in [b"%d" % chance.randrange(40)] * 24]
    assert len(runs.find_runs([blocks])[0]) > 2800


def test_strongest_and_collapse():
    a, b, c = runs.Run(0, 24, 1), runs.Run(30, 48, 2), runs.Run(90, 30, 1)
    assert runs.strongest([a, b]) == a and runs.strongest([a, b, c]) == c and runs.strongest([]) is None
    words = [b"x"] + [b"a", b"b"] * 12 + [b"y"]
    assert runs.collapse(words, runs.find_runs([words])[0]) == [b"x", b"a", b"b", b"y"]
    assert runs.collapse([], []) == []


def test_rows(spark):
    period = " ".join(["one two\tthree"] * 9)
    texts = [None, "", " \n\t ", "word", period, f"x {period} y", period.upper(), " nbsp  inside ", "é " * 24]
    rows = [(i, t, "s", 1) for i, t in enumerate(texts)]
    rows += [rows[4], (None, period, None, None), (None, None, None, None)]
    found = runs.periodic_runs(spark.createDataFrame(rows, DOC).repartition(3)).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    assert [len(by_id[i].runs) for i in range(9)] == [0, 0, 0, 0, 1, 1, 1, 0, 1]
    assert tuple(by_id[5].best) == (1, 27, 3) and by_id[5].collapsed == "x one two three y"
    assert by_id[0].best is None and by_id[0].runs_sha256 == hashlib.sha256(b"").hexdigest() == by_id[0].collapsed_sha256
    assert by_id[5].runs_sha256 == hashlib.sha256(b"1,27,3\n").hexdigest()
    assert runs.periodic_runs(spark.createDataFrame([], DOC)).count() == 0


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = word_runs(spark, sf_dir).collect()
    assert len(rows) == len(texts) and any(r.n_runs for r in rows)
    for r in rows:
        words = (texts[r.doc_id] or "").encode().split()
        if len(words) > 3000:
            continue
        words = runs.with_planted_tail(words, r.doc_id)
        want = every_run(words)
        best = max(want, key=lambda x: (x[1] * 10**9 // x[2], -x[0], -x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(want), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if want else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in want).encode()).hexdigest()
        kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in want)]
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(kept)).hexdigest()
