"""Stage tables to one row per report, and back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .responses import one_per_key

_TEXT_MAP = "map<string,string>"
_QA_MAP = "map<string,array<map<string,string>>>"


def _one_per_key(rows: DataFrame, keys: list[str], unique: bool) -> DataFrame:
    return rows if unique else one_per_key(rows, keys)


def nest_categories(rows: DataFrame, unique: bool = False) -> DataFrame:
    """report_id, category_findings: one map entry per category.

    One row per key is made first with a map-side part, so what is collected
    for a report is at most the catalog's categories however often rows repeat.
    ``unique`` says the rows are so already, as those of a stage store are.
    """
    single = _one_per_key(rows.select("report_id", "category", "findings"), ["report_id", "category"], unique)
    entries = F.collect_list(F.struct("category", "findings"))
    return single.groupBy("report_id").agg(F.map_from_entries(F.array_sort(entries)).alias("category_findings"))


def nest_questions(rows: DataFrame, unique: bool = False) -> DataFrame:
    """report_id, qa_results: per category the answers in question_id order."""
    keys = ["report_id", "category", "question_id"]
    single = _one_per_key(rows.select(*keys, "question", "answer"), keys, unique)
    items = single.groupBy("report_id").agg(
        F.array_sort(F.collect_list(F.struct("category", "question_id", "question", "answer"))).alias("items")
    )
    answered = F.map_from_entries(
        F.transform(
            F.array_distinct(F.transform("items", lambda i: i["category"])),
            lambda c: F.struct(
                c,
                F.transform(
                    F.filter("items", lambda i: i["category"] == c),
                    lambda i: F.create_map(i["question"], i["answer"]),
                ),
            ),
        )
    )
    return items.select("report_id", answered.alias("qa_results"))


def flatten_categories(nested: DataFrame) -> DataFrame:
    """report_id, category, findings"""
    return nested.select("report_id", F.explode("category_findings").alias("category", "findings"))


def flatten_questions(nested: DataFrame) -> DataFrame:
    """report_id, category, ord, question, answer; ord is the position in the category."""
    per_category = nested.select("report_id", F.explode("qa_results").alias("category", "answers"))
    per_answer = per_category.select("report_id", "category", F.posexplode("answers").alias("ord", "qa"))
    return per_answer.select("report_id", "category", "ord", F.explode("qa").alias("question", "answer"))


def combine_stages(
    reports: DataFrame | None,
    no_comparisons: DataFrame | None = None,
    findings: DataFrame | None = None,
    category_findings: DataFrame | None = None,
    questions: DataFrame | None = None,
    processing_time: float = 0.0,
    unique: bool = False,
) -> DataFrame:
    """One row per report with everything known about it.

    Without reports the ids are those of any stage and the raw text is empty.
    Each side is one row per report and hashed on its id, and a repeated id
    does not multiply.  ``unique`` says each stage table has one row per key,
    as those of a stage store have; each is then shuffled once.
    """
    parts: dict[str, DataFrame] = {}
    if no_comparisons is not None:
        texts = no_comparisons.select("report_id", "no_comparison_text")
        parts["no_comparison_text"] = _one_per_key(texts, ["report_id"], unique)
    if findings is not None:
        texts = findings.selectExpr("report_id", "findings AS findings_text")
        parts["findings_text"] = _one_per_key(texts, ["report_id"], unique)
    if category_findings is not None:
        parts["category_findings"] = nest_categories(category_findings, unique)
    if questions is not None:
        parts["qa_results"] = nest_questions(questions, unique)
    empty = {
        "no_comparison_text": F.lit(""),
        "findings_text": F.lit(""),
        "category_findings": F.create_map().cast(_TEXT_MAP),
        "qa_results": F.create_map().cast(_QA_MAP),
    }
    if reports is not None:
        base = reports.selectExpr("report_id", "coalesce(report_text, '') AS raw_text")
    elif parts:
        ids = reduce(DataFrame.union, [df.select("report_id") for df in parts.values()]).distinct()
        base = ids.withColumn("raw_text", F.lit(""))
    else:
        raise ValueError("nothing to combine")
    joined = reduce(lambda left, df: left.join(df, "report_id", "left"), parts.values(), base)
    columns = [F.coalesce(F.col(n), e).alias(n) if n in parts else e.alias(n) for n, e in empty.items()]
    return joined.select(
        "report_id",
        "raw_text",
        *columns,
        F.lit(float(processing_time)).alias("processing_time"),
        F.lit(None).cast("string").alias("error"),
    )
