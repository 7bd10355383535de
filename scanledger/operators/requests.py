"""Prompt tables: what to ask about each report.

A catalog is a few hundred lines of configuration, so it becomes a literal array
in the plan and each report row is exploded against it: no join, no shuffle, and
a skewed report table stays as it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.answers import is_valid_result, request_id
from ..functions.fixed_values import STAGE_KEYS
from ..functions.prompts import DEFAULT_TEMPLATES, label_prompt, render
from ..functions.text import eligible_text
from ..sources.catalog import Catalog

# Which text each stage reads and which template it fills.
STAGE_INPUT = {
    "no_comparisons": ("report_text", "remove_comparison"),
    "findings": ("no_comparison_text", "extract_findings"),
    "category_findings": ("findings", "map_category_findings"),
    "questions": ("report_text", "findings_question"),
}


def _category_rows(catalog: Catalog) -> Column:
    rows = [{"category": c.name, "description": c.description} for c in catalog.categories]
    return _literal_rows(rows)


def _question_rows(catalog: Catalog) -> Column:
    rows = [
        {"category": c.name, "question": q, "question_id": question_digest(q)}
        for c in catalog.categories
        for q in c.questions
    ]
    return _literal_rows(rows)


def _literal_rows(rows: Sequence[Mapping[str, str]]) -> Column:
    return F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in row.items()]) for row in rows])


def question_digest(question: str) -> str:
    """``question_id`` for a text known on the driver."""
    return hashlib.md5(question.encode()).hexdigest()[:8]


def pending(candidates: DataFrame, done: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Candidates whose key is not among the finished rows.

    Finished keys are made distinct first, with a map-side part: a key that is
    repeated without bound is one row by the time it meets the join.
    """
    if done is None:
        return candidates
    return candidates.join(done.select(*keys).distinct(), list(keys), "left_anti")


def _fan_out(inputs: DataFrame, rows: Column, done: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """One row per input row and catalog entry that is not finished yet.

    Finished entries become their places in the catalog, which as a table of its
    places is broadcast (its size is that of the catalog).  They are gathered per
    report, at most the catalog's, and one difference of two sets of numbers
    leaves the open places: the work per report grows with the catalog, not with
    its square, and texts are moved once per report, not once per question.
    """
    if done is None:
        return inputs.select("*", F.inline(rows))
    own = [k for k in keys if k != "report_id"]
    places = done.sparkSession.range(1).select(F.posexplode(rows).alias("__place", "__entry"))
    places = places.select("__place", *[F.col(f"__entry.{k}").alias(k) for k in own])
    finished = done.select(*keys).join(F.broadcast(places), own).groupBy("report_id").agg(F.collect_set("__place").alias("__done"))
    joined = inputs.join(finished, "report_id", "left")
    none = F.array().cast("array<int>")
    still_open = F.array_except(F.sequence(F.lit(0), F.size(rows) - 1), F.coalesce("__done", none))
    return joined.select(*inputs.columns, F.explode(still_open).alias("__at")).select(
        *inputs.columns, F.inline(F.array(F.get(rows, F.col("__at"))))
    )


def fan_out_categories(findings: DataFrame, catalog: Catalog, done: DataFrame | None = None) -> DataFrame:
    """One row per report and category; texts without findings are dropped first."""
    kept = findings.filter(is_valid_result(F.col("findings"), "findings")).select("report_id", "findings")
    return _fan_out(kept, _category_rows(catalog), done, STAGE_KEYS["category_findings"])


def fan_out_questions(reports: DataFrame, catalog: Catalog, done: DataFrame | None = None) -> DataFrame:
    """One row per report, category and question."""
    kept = reports.select("report_id", "report_text")
    return _fan_out(kept, _question_rows(catalog), done, STAGE_KEYS["questions"])


def candidates_for(
    stage: str, inputs: DataFrame, catalog: Catalog | None = None, done: DataFrame | None = None
) -> DataFrame:
    """The keys a stage still has to produce, with the texts its prompt needs."""
    if stage not in STAGE_INPUT:
        raise ValueError(f"unknown stage {stage!r}")
    if stage in ("category_findings", "questions"):
        if catalog is None or not catalog.categories:
            raise ValueError(f"stage {stage} needs a catalog with categories")
        return (fan_out_categories if stage == "category_findings" else fan_out_questions)(inputs, catalog, done)
    return pending(inputs.select("report_id", STAGE_INPUT[stage][0]), done, STAGE_KEYS[stage])


def build_requests(
    stage: str,
    inputs: DataFrame,
    catalog: Catalog | None = None,
    done: DataFrame | None = None,
    templates: Mapping[str, str] | None = None,
) -> DataFrame:
    """Requests still to be answered: key columns, request_id and prompt.

    Finished keys are removed before prompts are rendered.
    """
    text_col, template = STAGE_INPUT[stage]
    keys = STAGE_KEYS[stage]
    todo = candidates_for(stage, inputs, catalog, done)
    columns = {"report": F.col(text_col), "findings": F.col(text_col)}
    columns.update({c: F.col(c) for c in ("category", "description", "question") if c in todo.columns})
    prompt = render((templates or DEFAULT_TEMPLATES)[template], **columns)
    shown = list(keys) + (["question"] if stage == "questions" else [])
    return todo.select(*shown, request_id(*[F.col(k) for k in keys]).alias("request_id"), prompt.alias("prompt"))


def label_requests(reports: DataFrame) -> DataFrame:
    """One prompt per report asking for the labels of every concept."""
    text = eligible_text(F.col("report_text"))
    return reports.select("report_id", F.col("report_id").alias("request_id"), label_prompt(text).alias("prompt"))
