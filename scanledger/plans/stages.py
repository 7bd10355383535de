"""Running the stages from reports to final results."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from ..functions.fixed_values import STAGE_ORDER
from ..operators.combine import combine_stages
from ..operators.requests import build_requests
from ..operators.responses import split_valid, to_stage_rows
from ..sources.catalog import Catalog
from ..sources.store import StageStore
from .completion import Responder, complete

STAGE_TABLE = dict(zip(STAGE_ORDER, ("no_comparisons", "findings", "category_findings", "questions")))
_FED_BY = {"extract-findings": "no_comparisons", "map-categories": "findings"}
_MADE_BY = {"no_comparisons": "remove-comparisons", "findings": "extract-findings"}


def ordered_stages(stages: Sequence[str]) -> list[str]:
    if list(stages) == ["all"]:
        return list(STAGE_ORDER)
    unknown = sorted(set(stages) - set(STAGE_ORDER))
    if unknown:
        raise ValueError(f"unknown stages {unknown}")
    return [s for s in STAGE_ORDER if s in stages]


def check_stage_inputs(stages: Sequence[str], available: Collection[str]) -> None:
    """Refuse a run whose inputs are neither given nor made by an earlier stage.

    ``available`` names what is given: "reports" and stage tables.
    """
    chosen = ordered_stages(stages)
    if {"remove-comparisons", "process-questions"} & set(chosen) and "reports" not in available:
        raise ValueError("remove-comparisons and process-questions need reports")
    for stage, table in _FED_BY.items():
        if stage in chosen and _MADE_BY[table] not in chosen and table not in available:
            raise ValueError(f"{stage} needs the {table} table when {_MADE_BY[table]} is not run")


def answer_stage(
    spark: SparkSession,
    stage: str,
    inputs: DataFrame,
    store: StageStore,
    responder: Responder,
    catalog: Catalog | None = None,
    templates: Mapping[str, str] | None = None,
    run: str | None = None,
) -> None:
    """Answer what a stage table still lacks, append the valid answers and keep the rejected ones apart.

    Of the stored rows only the buckets of ``inputs`` are read.  Answers are
    written down before they are used, so the responder is asked once per
    request even when executors are lost afterwards.  A ``run`` that is repeated
    replaces its own answers and rejections; the keys of rejected answers come
    back on the next run.
    """
    run = run or uuid4().hex
    requests = build_requests(stage, inputs, catalog, store.near(spark, stage, inputs), templates)
    folder = f"{store.path}/answers/{stage}/{run}"
    complete(requests, responder).write.mode("overwrite").parquet(folder)
    answered = spark.read.parquet(folder)
    store.reject(stage, split_valid(answered, stage)[1], run)
    store.append(stage, to_stage_rows(answered, stage))


def retry_stage(
    spark: SparkSession,
    stage: str,
    inputs: DataFrame,
    store: StageStore,
    responder: Responder,
    catalog: Catalog | None = None,
    templates: Mapping[str, str] | None = None,
) -> None:
    """Ask again for the reports of ``inputs`` that have a rejected answer and no valid one since."""
    left = store.still_open(spark, stage)
    if left is not None:
        again = inputs.join(left.select("report_id").distinct(), "report_id", "left_semi")
        answer_stage(spark, stage, again, store, responder, catalog, templates)


def run_stages(
    spark: SparkSession,
    stages: Sequence[str],
    store: StageStore,
    responder: Responder,
    reports: DataFrame | None = None,
    catalog: Catalog | None = None,
    inputs: Mapping[str, DataFrame] | None = None,
    templates: Mapping[str, str] | None = None,
) -> DataFrame:
    """Run the chosen stages in order and combine everything stored so far.

    ``inputs`` gives stage tables to read instead of the stored ones.
    """
    inputs = dict(inputs or {})
    stored = {t for t in STAGE_TABLE.values() if store.load(spark, t) is not None}
    check_stage_inputs(stages, {*inputs, *stored, *(["reports"] if reports is not None else [])})
    for name in ordered_stages(stages):
        table = STAGE_TABLE[name]
        source = reports if name not in _FED_BY else inputs.get(_FED_BY[name], store.load(spark, _FED_BY[name]))
        answer_stage(spark, table, source, store, responder, catalog, templates)
    tables = {table: store.load(spark, table) for table in STAGE_TABLE.values()}
    return combine_stages(reports, **tables, unique=True)
