"""The same work on reports that keep arriving.

Labelling depends on one report at a time, so a stream runs the batch code and
needs no state.  Stages remember finished keys in their tables; a micro-batch
that is replayed after a failure adds nothing twice.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.fixed_values import STAGE_COLUMNS, STAGE_KEYS
from ..operators.labels import Rule, label_concepts
from ..plans.completion import Responder
from ..plans.stages import answer_stage
from ..sources.catalog import Catalog
from ..sources.store import StageStore


def stream_table(spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None) -> DataFrame:
    """The Parquet files of a table, a folder or a single file, as a stream.

    The last part of the path is written as a pattern of one alternative, which
    a stream needs to accept a single file; its own marks are escaped.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    folder, name = path.rstrip("/").rsplit("/", 1)
    escaped = re.sub(r"([\\*?\[\]{}^,])", r"\\\1", name)
    return reader.parquet(f"{folder}/{{{escaped}}}")


def label_stream(
    reports: DataFrame, path: str, checkpoint: str, rules: Sequence[Rule] | None = None
) -> StreamingQuery:
    """Label everything that has arrived since the last run and stop."""
    return (
        label_concepts(reports, rules)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def distinct_stream(rows: DataFrame, stage: str, path: str, checkpoint: str, event_time: str | None = None, delay: str | None = None) -> StreamingQuery:
    """Write arriving stage rows with each key once, from state instead of what is written.

    The keys seen so far live in the state store beside ``checkpoint`` and
    outlive restarts, and the file sink commits a batch once, so a file that is
    replayed or late adds nothing.  No stored row is ever read.  Of rows of one
    key in one micro-batch any one stays; a later one never replaces it.

    State holds every key, unless ``event_time`` and ``delay`` bound how late a
    repeated key may come.
    """
    columns, keys = STAGE_COLUMNS[stage], list(STAGE_KEYS[stage])
    if event_time and delay:
        unique = rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
    else:
        unique = rows.select(*columns).dropDuplicates(keys)
    writer = unique.select(*columns).writeStream.format("parquet").outputMode("append").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_stream(rows: DataFrame, stage: str, store: StageStore, checkpoint: str) -> StreamingQuery:
    """Append arriving stage rows, each key once."""

    def add(batch: DataFrame, _: int) -> None:
        store.append(stage, batch)

    return rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stage_stream(
    inputs: DataFrame,
    stage: str,
    store: StageStore,
    responder: Responder,
    checkpoint: str,
    catalog: Catalog | None = None,
    templates: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Answer a stage for arriving inputs, micro-batch by micro-batch.

    Each batch is saved before the next starts: valid answers in the stage
    table, rejected ones beside it under the batch's own name.  A batch that
    broke off is answered again after a restart from ``checkpoint`` and adds
    nothing twice; ``retry_stage`` asks again for what was rejected.
    """
    run = checkpoint.rstrip("/").rsplit("/", 1)[-1]

    def answer(batch: DataFrame, number: int) -> None:
        answer_stage(batch.sparkSession, stage, batch, store, responder, catalog, templates, f"{run}-{number}")

    return inputs.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
