"""Secret scans with linked parts of credentials.

Some strings are secrets by their look.  Others are weak: a name of an account,
a token of mixed characters, an address of a service.  Each weak part is an
interval, stretched by a reach and cut to its paragraph.  The intervals of a
text are joined, and a weak secret with a weak or sure identifier in its scope
is reported together with it and with the endpoints around them.

All parts of a text lie in one row, so nothing is shuffled.  The join walks over
both sides in order and keeps the nearest partners, so it makes no pairs.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from scanledger.llm.common import PIECE_BYTES, narrow, released, text_slices

#: The base patterns, their least lengths, and the order of kinds.
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
#: Weak parts, reported only together.
IDENTIFIER = re.compile(r"""(?i:client|user|account|access|app|key)[_-]?(?i:id|name)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})""", re.ASCII)
SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])", re.ASCII)
ENDPOINT = re.compile(r"(?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s\"'<>]+|(?<![\w.-])(?:[a-z0-9-]+\.)+[a-z]{2,}:[0-9]{2,5}(?![0-9])", re.ASCII)
PARAGRAPH_END = re.compile(r"\n[\x20\t]*\n")
REACH = 240

Span = tuple[int, int]


def base_spans(text: str) -> dict[str, list[Span]]:
    """The sure finds, leftmost and without overlap in each kind."""
    found = {"assign": [m.span() for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST_ASSIGNED], "access": [], "hex": [m.span() for m in HEX.finditer(text)]}
    if "AKIA" in text:
        found["access"] = [m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    return found


def mixed(token: str) -> bool:
    """A token with capitals, small letters and digits, as keys have and words do not."""
    return bool(re.search("[A-Z]", token) and re.search("[a-z]", token) and re.search("[0-9]", token))


def apart(spans: list[Span], taken: list[Span]) -> list[Span]:
    """The spans that touch none of the taken ones (both in order, without overlap inside)."""
    starts = [s for s, _ in taken]
    out = []
    for s, e in spans:
        at = bisect.bisect_left(starts, e)
        if not at or taken[at - 1][1] <= s:
            out.append((s, e))
    return out


def union(spans: list[Span]) -> list[Span]:
    """Overlapping spans made one."""
    out: list[Span] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def scopes(spans: list[Span], ends: list[int], size: int, reach: int) -> list[Span]:
    """Each span stretched by the reach and cut to its paragraph."""
    out = []
    for s, e in spans:
        at = bisect.bisect_right(ends, s)
        low, high = (ends[at - 1] if at else 0), (ends[at] if at < len(ends) else size)
        out.append((max(low, s - reach), max(e, min(high, e + reach))))
    return out


def meeting(spans: list[Span], others: list[Span]) -> list[Span]:
    """The spans that overlap any of the other intervals: an interval join that keeps the left side."""
    merged = union(others)
    starts = [s for s, _ in merged]
    out = []
    for s, e in spans:
        at = bisect.bisect_left(starts, e)
        if at and merged[at - 1][1] > s:
            out.append((s, e))
    return out


def linked_spans(text: str, reach: int = REACH) -> list[tuple[str, int, int]]:
    """All reported spans (kind, start, end) by start, then kind, in code points."""
    base = base_spans(text)
    sure = union([s for spans in base.values() for s in spans])
    found = dict(base)
    secrets = apart([m.span() for m in SECRET.finditer(text) if mixed(m.group())], sure)
    names = apart([m.span() for m in IDENTIFIER.finditer(text)], sure)
    if secrets or names:
        secrets = apart(secrets, names)
        ends = [m.start() for m in PARAGRAPH_END.finditer(text)]
        wide = lambda spans: scopes(spans, ends, len(text), reach)
        keys = sorted(base["assign"] + base["hex"])
        found["secret"] = meeting(secrets, wide(sorted(names + base["access"])))
        found["identifier"] = meeting(names, wide(sorted(found["secret"] + keys)))
        pairs = sorted(found["secret"] + found["identifier"])
        found["endpoint"] = meeting(apart([m.span() for m in ENDPOINT.finditer(text)], union(sure + pairs)), wide(pairs)) if pairs else []
    rows = [(s, KINDS.index(k), e, k) for k, spans in found.items() for s, e in spans]
    return [(k, s, e) for s, _, e, k in sorted(rows)]


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
FOUND = "doc_id long, spans array<struct<kind:string,start:int,end:int>>"


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """The spans of secrets in every whole text, one row for each row of ``docs``.

    A null text has none.  Repeated rows and null ids are kept as they are;
    other columns are not looked at.
    """

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", PIECE_BYTES):
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in linked_spans(t or "", reach)] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").cast(pa.int64()), "spans": pa.array(spans, SPANS)})

    return narrow(docs, doc_id=id_col, text=text_col).mapInArrow(run, FOUND)


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", mark: str = "[SECRET]", reach: int = REACH) -> DataFrame:
    """The same rows and columns, with each found span in the text replaced by a mark.

    ``length_col`` gets the new number of code points where the text changed.
    Null and empty texts stay as they are.
    """
    def clean(text: str | None) -> str | None:
        spans = union([(s, e) for _, s, e in linked_spans(text, reach)]) if text else []
        for s, e in reversed(spans):
            text = text[:s] + mark + text[e:]
        return text

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_col, PIECE_BYTES):
            at = batch.schema.get_field_index(text_col)
            old = batch.column(at)
            new = pa.array([clean(t) for t in old.to_pylist()], old.type)
            columns = [new if i == at else c for i, c in enumerate(batch.columns)]
            if length_col in batch.schema.names:
                n = batch.schema.get_field_index(length_col)
                changed = pc.fill_null(pc.not_equal(old, new), False)
                columns[n] = pc.if_else(changed, pc.utf8_length(new).cast(columns[n].type), columns[n])
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
