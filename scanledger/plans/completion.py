"""Answering a request table with a function the user brings."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

Responder = Callable[[Sequence[str]], Sequence[str]]
#: Bytes of prompts that the responder is given at once.
PROMPT_BYTES = 2 << 20


def prompt_slices(batch: pa.RecordBatch, limit: int = PROMPT_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows whose prompts have about ``limit`` bytes; a longer prompt is a piece of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column("prompt")), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(lengths, dtype=np.int64), 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def complete(requests: DataFrame, responder: Responder) -> DataFrame:
    """Replace ``prompt`` with ``content``, some megabytes of prompts at a time.

    The responder gets a list of prompts and returns as many answers.  When it
    fails on a list the prompts are tried one by one, and one that still fails
    is answered with an empty text.
    """
    kept = [c for c in requests.columns if c != "prompt"]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema if f.name != "prompt"]

    def answer(prompts: list[str]) -> list[str]:
        try:
            answers = ["" if a is None else str(a) for a in responder(prompts)]
            if len(answers) == len(prompts):
                return answers
        except Exception:  # noqa: BLE001 - any failure of user code means no answer
            if len(prompts) == 1:
                return [""]
        return [answer([p])[0] for p in prompts] if len(prompts) > 1 else [""]

    def batches(arrived: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrived:
            if not batch.num_rows:
                continue
            text = batch.schema.field("prompt").type
            for part in prompt_slices(batch):
                content = pa.array(answer(part.column("prompt").to_pylist()), text)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), content], [*kept, "content"])
            # Nothing of a batch is held while the next one arrives.
            del batch, part, content

    return requests.mapInArrow(batches, schema=", ".join([*fields, "content string"]))
