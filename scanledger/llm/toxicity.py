"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels exist for whole documents.  Words and word beginnings that toxic
documents hold far more often than others mark the tokens of toxic documents;
these labelled tokens train the field.  Its two states (other, toxic) have a
weight for each feature of a token and for each change of state.  Forward and
backward sums give each token the probability of being toxic; a document's
score is a logistic function of the largest of them and of their sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanledger.llm.common import narrow, text_slices
from scanledger.llm.words import NOT_ALPHANUMERIC, Words

#: Labelled documents, half of them toxic, whose tokens fit the weights of the field.
FIELD_DOCS = 800
#: Bytes of word beginnings that are features beside the whole word.
BEGINNINGS = (4, 5, 6, 7)
#: Labelled documents that train (those with the smallest hash of their id), and features kept.
MOST_DOCS, MOST_FEATURES = 3000, 20_000
#: Evidence (twice the log-likelihood ratio) for a feature that marks tokens, and for one that is kept.
MARKS, KEPT = 25.0, 8.0
STEPS, RATE, RIDGE = 60, 0.2, 1e-3
THRESHOLD, SPAN_THRESHOLD = 0.7, 0.5


def features(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """Words of the small letters of texts, and the hashes of their features, a row for each kind."""
    words = Words(pc.utf8_lower(pc.fill_null(texts, "")), NOT_ALPHANUMERIC)
    kinds = [words.hashes()] + [words.prefixes(n) * np.uint64(2 * n + 1) for n in BEGINNINGS]
    return words, np.stack(kinds)


@dataclass
class Field:
    """A trained field: sorted feature hashes with weights, bias, changes of state, start, and the score's weights."""

    names: np.ndarray
    weights: np.ndarray
    bias: float
    change: np.ndarray
    start: float
    score: np.ndarray

    def index(self, hashes: np.ndarray) -> np.ndarray:
        """Places of features in the table; the place behind its end for unknown ones."""
        if not len(self.names):
            return np.zeros(hashes.shape, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.names, hashes), len(self.names) - 1)
        return np.where(self.names[at] == hashes, at, len(self.names)).astype(np.int32)

    def emissions(self, index: np.ndarray) -> np.ndarray:
        """Log odds of the toxic state by the token alone."""
        return np.append(self.weights, 0.0)[index].sum(axis=0) + self.bias


def ragged_steps(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the texts, the longest first, and how many are longer than each step."""
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths[order[0]]) if len(order) else 0
    return bounds[:-1][order], np.searchsorted(-lengths[order], -np.arange(longest), side="left")


def sums(emission: np.ndarray, bounds: np.ndarray, change: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward ratios of the two states at each token, for all texts at once."""
    odds = np.exp(np.clip(emission, -30, 30))
    (a, b), (c, d) = np.exp(change)
    forward, backward = np.empty_like(odds), np.empty_like(odds)
    begins, active = ragged_steps(bounds)
    ends = begins + -np.sort(-np.diff(bounds))
    for t, n in enumerate(active.tolist()):
        here, last = begins[:n] + t, ends[:n] - 1 - t
        if t:
            r, s = forward[here - 1], odds[last + 1] * backward[last + 1]
            forward[here] = np.clip(odds[here] * (b + r * d) / (a + r * c), 1e-30, 1e30)
            backward[last] = np.clip((c + d * s) / (a + b * s), 1e-30, 1e30)
        else:
            forward[here] = odds[here] * np.exp(start)
            backward[last] = 1.0
    return forward, backward


def marginals(emission: np.ndarray, bounds: np.ndarray, change: np.ndarray, start: float) -> np.ndarray:
    """Probability of the toxic state at each token."""
    forward, backward = sums(emission, bounds, change, start)
    odds = forward * backward
    return odds / (1 + odds)


def document_values(probability: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of each text: one, the log odds of its most toxic token, and the number of likely toxic tokens on a scale that flattens."""
    most = np.zeros(len(bounds) - 1)
    filled = np.flatnonzero(np.diff(bounds) > 0)
    if len(filled):
        most[filled] = np.maximum.reduceat(probability, bounds[filled])
    total = np.diff(np.concatenate([[0], np.cumsum(np.where(probability >= SPAN_THRESHOLD, probability, 0))])[bounds])
    most = np.clip(most, 1e-4, 1 - 1e-4)
    return np.stack([np.ones(len(most)), np.log(most / (1 - most)), np.minimum(total, 3.0)], axis=1)


def evidence(hashes: np.ndarray, owner: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes and signed evidence for toxic documents, from in how many of either kind they are."""
    order = np.lexsort((owner, hashes))
    hashes, owner = hashes[order], owner[order]
    once = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])]) if len(order) else np.zeros(0, bool)
    hashes, owner = hashes[once], owner[once]
    names, first = np.unique(hashes, return_index=True)
    sizes = np.diff(np.append(first, len(hashes)))
    hit = np.add.reduceat(toxic[owner].astype(np.int64), first) if len(first) else sizes
    rate = toxic.mean()
    part = np.clip(hit / np.maximum(sizes, 1), 1e-9, 1 - 1e-9)
    ratio = 2 * sizes * (part * np.log(part / rate) + (1 - part) * np.log((1 - part) / (1 - rate)))
    return names, np.where(part > rate, ratio, -ratio)


def train(texts: list[str], toxic: np.ndarray) -> Field:
    """Fit a field to labelled documents; without both labels it says the same of all texts."""
    rate = (toxic.sum() + 0.5) / (len(toxic) + 1)
    flat = Field(np.zeros(0, np.uint64), np.zeros(0), -8.0, np.zeros((2, 2)), 0.0, np.array([np.log(rate / (1 - rate)), 0.0, 0.0]))
    if not len(texts) or toxic.min() == toxic.max():
        return flat
    parts = [features(piece.column(0)) for piece in text_slices([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])], "text", 1 << 20)]
    lengths, hashes = np.concatenate([np.diff(w.bounds) for w, _ in parts]), np.concatenate([h for _, h in parts], axis=1)
    del parts
    owner = np.repeat(np.arange(len(lengths)), lengths)
    found = [evidence(kind, owner, toxic) for kind in hashes]
    names, ratio = (np.concatenate(x) for x in zip(*found, strict=True))
    keep = np.argsort(-np.abs(ratio), kind="stable")[:MOST_FEATURES]
    keep = keep[np.abs(ratio[keep]) >= KEPT]
    keep = keep[np.argsort(names[keep], kind="stable")]
    field = Field(names[keep], np.zeros(len(keep)), -4.0, np.zeros((2, 2)), 0.0, flat.score)
    marking = np.append(ratio[keep] >= MARKS, False)
    # The weights come from all toxic documents and as many others again, up to a bound.
    used = np.zeros(len(lengths), dtype=bool)
    for value in (1, 0):
        used[np.flatnonzero(toxic == value)[: FIELD_DOCS // 2]] = True
    hashes, owner, bounds = hashes[:, used[owner]], owner[used[owner]], np.concatenate([[0], np.cumsum(lengths[used])])
    index = field.index(hashes)
    del hashes
    label = marking[index].any(axis=0) & toxic.astype(bool)[owner]
    first = np.zeros(len(label), dtype=bool)
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    inner = ~first
    wanted = np.zeros((2, 2))
    np.add.at(wanted, (label[:-1][inner[1:]].astype(int), label[1:][inner[1:]].astype(int)), 1)
    seen = [np.zeros(len(keep) + 1) + np.bincount(row, weights=label, minlength=len(keep) + 1) for row in index]
    observed = np.sum(seen, axis=0)[:-1]
    # Gradient steps with a size of its own for each weight.
    weights = np.zeros(len(keep) + 6)
    weights[len(keep)] = field.bias
    size = np.zeros_like(weights)
    n = max(label.sum(), 1)
    for _ in range(STEPS):
        field.weights, field.bias, field.start = weights[: len(keep)], weights[len(keep)], weights[len(keep) + 1]
        field.change = weights[len(keep) + 2 :].reshape(2, 2)
        emission = field.emissions(index)
        forward, backward = sums(emission, bounds, field.change, field.start)
        odds = forward * backward
        p = odds / (1 + odds)
        expected = np.sum([np.bincount(row, weights=p, minlength=len(keep) + 1) for row in index], axis=0)[:-1]
        now, then = forward[:-1][inner[1:]], (np.exp(np.clip(emission, -30, 30)) * backward)[1:][inner[1:]]
        e = np.exp(field.change)
        joint = np.array([np.full(len(now), e[0, 0]), e[0, 1] * then, e[1, 0] * now, e[1, 1] * now * then])
        pairs = (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)
        slope = np.concatenate([observed - expected, [label.sum() - p.sum(), label[first].sum() - p[first].sum()], (wanted - pairs).ravel()]) / n - RIDGE * weights
        size += slope**2
        weights = weights + RATE * slope / np.sqrt(size + 1e-12)
    field.score = logistic(document_values(marginals(field.emissions(index), bounds, field.change, field.start), bounds), toxic[used])
    # Toxic documents are a larger part of those used than of all.
    share = toxic[used].mean()
    field.score[0] += np.log(rate / (1 - rate)) - np.log(share / (1 - share))
    return field


def logistic(values: np.ndarray, label: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression by Newton steps."""
    w = np.zeros(values.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(values @ w, -30, 30)))
        curve = (values * (p * (1 - p))[:, None]).T @ values + ridge * np.eye(len(w))
        w = w + np.linalg.solve(curve, values.T @ (label - p) - ridge * w)
    return w


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int) -> DataFrame:
    """At most ``most`` training rows (doc_id, text, toxic): labelled, not held out, by the smallest hashes of their ids."""
    known = narrow(labels, doc_id=id_col, toxic=label_col).where("doc_id IS NOT NULL AND toxic IS NOT NULL AND pmod(crc32(cast(doc_id AS string)), 3) <> 1")
    chosen = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return narrow(docs, doc_id=id_col, text=text_col).join(F.broadcast(chosen), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = MOST_DOCS) -> Field:
    """A field from a bounded sample of the labelled documents that are not held out."""
    rows = labelled_texts(docs, labels, id_col, text_col, label_col, most).dropDuplicates(["doc_id"]).orderBy("doc_id").toArrow()
    return train([t or "" for t in rows.column("text").to_pylist()], np.array(rows.column("toxic").to_pylist(), dtype=np.int64))


SCORED = "doc_id long, score double, spans array<struct<start:int,end:int,probability:double>>"
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))


def score_texts(texts: pa.Array, field: Field, least: float = SPAN_THRESHOLD) -> tuple[np.ndarray, list[list[dict]]]:
    """Scores, and the toxic tokens of each text: where they lie in code points of its small letters, and how likely."""
    words, hashes = features(texts)
    p = marginals(field.emissions(field.index(hashes)), words.bounds, field.change, field.start)
    z = document_values(p, words.bounds) @ field.score
    spans: list[list[dict]] = [[] for _ in range(len(words))]
    at = np.flatnonzero(p >= least)
    points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)]) if len(at) else None
    for i, text in zip(at.tolist(), (np.searchsorted(words.bounds, at, side="right") - 1).tolist(), strict=True):
        base = points[words.offsets[text]]
        spans[text].append({"start": int(points[words.starts[i]] - base), "end": int(points[words.ends[i]] - base), "probability": float(p[i])})
    return 1 / (1 + np.exp(-np.clip(z, -30, 30))), spans


def score_documents(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score and toxic tokens of every whole text: doc_id, score, spans.

    One row for each row of ``docs``.  Null and empty texts get the score of a
    text without tokens.  Nothing but the text is looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            score, spans = score_texts(batch.column("text"), sent.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(score), pa.array(spans, SPANS)], ["doc_id", "score", "spans"])

    return narrow(docs, doc_id=id_col, text=text_col).mapInArrow(run, SCORED)
