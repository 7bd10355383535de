"""Short answers: yes/no, annotations, response classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .text import matches, strip


def _cell(value: Column) -> Column:
    return F.lower(strip(value))


def yes_no(answer: Column) -> Column:
    """1 for a yes, 0 for a no, null for neither, both or an unsure answer."""
    yes, no = matches(answer, r"\byes\b"), matches(answer, r"\bno\b")
    return (
        F.when(matches(answer, fixed.UNCERTAIN_ANSWER), None)
        .when(yes & ~no, 1)
        .when(no & ~yes, 0)
        .cast("int")
    )


def qc_answer(answer: Column) -> Column:
    """1 or 0 for a whole answer of yes or no, else null."""
    word = _cell(answer)
    return F.when(word.isin(*fixed.QC_YES), 1).when(word.isin(*fixed.QC_NO), 0).cast("int")


def qc_value(answer: Column) -> Column:
    """``qc_answer`` for a JSON value: text is read as such, numbers and truth values by their sign, others are null."""
    kind = F.schema_of_variant(answer)
    number = F.when(F.try_variant_get(answer, "$", "double") > 0, 1).otherwise(0)
    truth = F.try_variant_get(answer, "$", "boolean").cast("int")
    text = qc_answer(F.try_variant_get(answer, "$", "string"))
    numeric = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    return F.when(kind == "STRING", text).when(kind == "BOOLEAN", truth).when(numeric, number).cast("int")


def is_blank_cell(value: Column) -> Column:
    """A cell a CSV reader takes as missing."""
    return value.isNull() | value.isin(*fixed.MISSING_CELLS)


def annotation(value: Column, all_numbers: Column) -> Column:
    """1 or 0 for an annotated cell, null for an empty or unknown one.

    ``all_numbers`` tells whether every filled cell of the sheet's column is a
    number.  Then the sign decides; otherwise only the known words count.
    """
    word = _cell(value)
    as_number = F.when(value.try_cast("double") > 0, 1).otherwise(0)
    as_word = F.when(word.isin(*fixed.ANNOTATION_YES), 1).when(word.isin(*fixed.ANNOTATION_NO), 0)
    return F.when(is_blank_cell(value), None).when(all_numbers, as_number).otherwise(as_word).cast("int")


def all_numbers(value: Column) -> Column:
    """Aggregate: is every filled cell of this column a number?"""
    return F.coalesce(F.bool_and(F.when(~is_blank_cell(value), value.try_cast("double").isNotNull())), F.lit(True))


def question_key(question: Column) -> Column:
    """A question as a name: no question marks, underscores for spaces and slashes."""
    return F.translate(question, " /?", "__")


def percent(share: Column) -> Column:
    """A share as a percentage with one decimal, ties to even."""
    return F.bround(share * 100, 1)


def question_id(question: Column) -> Column:
    return F.left(F.md5(question), F.lit(8))


def request_id(*keys: Column) -> Column:
    """The keys joined for display.  Joins use the key columns, which cannot collide."""
    return F.concat_ws("_", *keys)


def is_valid_result(content: Column, stage: str) -> Column:
    """Does a response count as a result of ``stage``?"""
    word = _cell(F.coalesce(content, F.lit("")))
    refused = {"findings": fixed.NO_SECTION, "category_findings": fixed.FAILED_CATEGORY}.get(stage, ())
    return ~word.isin("", *refused)


def response_pattern(content: Column) -> Column:
    """A coarse class for a response; the first that fits."""
    word = _cell(F.coalesce(content, F.lit("")))
    return (
        F.when(word == "", "EMPTY")
        .when(word.contains("no relevant findings"), "no_relevant_findings")
        .when(word.contains("no findings"), "no_findings")
        .when(word.contains("normal"), "normal")
        .when(F.length(word) < 10, "very_short")
        .otherwise("substantial")
    )


def invalid_pattern(content: Column) -> Column:
    """How a rejected response looks: empty, short (whole) or long (its start)."""
    word = _cell(F.coalesce(content, F.lit("")))
    return (
        F.when(word == "", "EMPTY")
        .when(F.length(word) < 20, F.concat(F.lit("SHORT: '"), word, F.lit("'")))
        .otherwise(F.concat(F.lit("LONG: '"), F.left(word, F.lit(30)), F.lit("...'")))
    )
