"""Model responses: reading text and JSON out of them with VARIANT columns.

A path that is missing reads as SQL null, a JSON null as a variant null, so
``_present`` tells them apart: a field that is there but null stops the search.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import REASONING_END
from .text import squeeze, strip

_FALSY = ("null", "false", "0", "0.0", "[]", "{}", '""')


def _at(body: Column, path: str) -> Column:
    return F.try_variant_get(body, path, "variant")


def _is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def _is_array(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("ARRAY")


def _text(value: Column) -> Column:
    """A field as text, empty for null and other empty values."""
    return F.when(F.to_json(value).isin(*_FALSY), "").otherwise(
        F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value))
    )


def without_reasoning(content: Column) -> Column:
    """The text after the last end-of-reasoning tag, stripped."""
    return strip(F.substring_index(content, REASONING_END, -1))


def _message_text(holder: Column, path: str, delta: bool) -> Column:
    """Text of one choice: message content, else text, else (for lists) delta content."""
    text = F.when(_at(holder, f"{path}.message.content").isNotNull(), _text(_at(holder, f"{path}.message.content")))
    text = text.when(_at(holder, f"{path}.text").isNotNull(), _text(_at(holder, f"{path}.text")))
    if delta:
        text = text.when(_at(holder, f"{path}.delta.content").isNotNull(), _text(_at(holder, f"{path}.delta.content")))
    return text.otherwise("")


def completion_text(body: Column) -> Column:
    """The answer in a chat completion body, in any of the layouts servers use."""
    choices = _at(body, "$.choices")
    return (
        F.when(_is_object(_at(body, "$.error")), "")
        .when(_at(body, "$.choices[0]").isNotNull(), _message_text(body, "$.choices[0]", delta=True))
        .when(_is_object(choices), _message_text(body, "$.choices", delta=False))
        .when(_at(body, "$.content").isNotNull(), _text(_at(body, "$.content")))
        .when(_at(body, "$.text").isNotNull(), _text(_at(body, "$.text")))
        .otherwise("")
    )


def completion_or_reasoning(body: Column) -> Column:
    """The message content of the first choice, or its reasoning when that is empty."""
    content = _text(_at(body, "$.choices[0].message.content"))
    reasoning = _text(_at(body, "$.choices[0].message.reasoning_content"))
    return F.coalesce(F.nullif(content, F.lit("")), F.nullif(reasoning, F.lit("")), F.lit(""))


def batch_line_text(line: Column) -> Column:
    """The answer in one line of a batch result file; null for a line to skip.

    Only message content counts here.  A line without it, or with an error,
    gives an empty answer; content that is neither text nor empty is skipped.
    """
    body = "$.response.body"
    choices = _at(line, f"{body}.choices")
    content = F.coalesce(
        F.when(_is_array(choices), _at(line, f"{body}.choices[0].message.content")),
        F.when(_is_object(choices), _at(line, f"{body}.choices.message.content")),
    )
    is_text = F.schema_of_variant(content) == "STRING"
    text = F.when(content.isNull() | F.to_json(content).isin(*_FALSY), "").when(
        is_text, without_reasoning(F.variant_get(content, "$", "string"))
    )
    broken = _at(line, "$.response").isNotNull() & ~_is_object(_at(line, "$.response"))
    return F.when(~broken, text)


def quote_in_text(quote: Column, squeezed_text: Column) -> Column:
    """Is a quote in the text, without regard to case and runs of blanks?

    ``squeezed_text`` is the text after ``lower(squeeze(text))``, done once.
    """
    return (quote != "") & squeezed_text.contains(F.lower(squeeze(quote)))


def json_block(text: Column) -> Column:
    """The JSON between the first { and the last }, null if there is none.

    NaN and Infinity are read as numbers.  Of repeated keys the last counts in a
    session with ``spark.sql.variant.allowDuplicateKeys``, which ``build_session``
    sets; without that setting such a block is null.
    """
    block = F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))
    return F.coalesce(F.try_parse_json(block), F.from_json(block, "variant", {"allowSingleQuotes": "false"}))


def coerced_label(value: Column) -> Column:
    """A JSON value as -1, 0 or 1; anything else is 0.

    Numbers are cut to whole ones, true counts as 1, and a text must spell a
    whole number ("1" but not "1.0").
    """
    kind = F.schema_of_variant(value)
    text = strip(F.try_variant_get(value, "$", "string"))
    spelled = F.when(text.rlike(r"^\+?(0_?)*1$"), 1).when(text.rlike(r"^-(0_?)*1$"), -1).otherwise(0)
    number = F.try_variant_get(value, "$", "double")
    whole = F.when((number >= 1) & (number < 2), 1).when((number <= -1) & (number > -2), -1).otherwise(0)
    return (
        F.when(kind == "STRING", spelled)
        .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("int"))
        .when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), whole)
        .otherwise(0)
        .cast("int")
    )


def coerced_evidence(value: Column) -> Column:
    """A JSON value as a list of texts that are not blank."""
    many = F.transform(F.try_variant_get(value, "$", "array<variant>"), _spelled)
    one = F.when(F.schema_of_variant(value) == "STRING", F.array(F.try_variant_get(value, "$", "string")))
    return F.filter(F.coalesce(many, one, F.array().cast("array<string>")), lambda q: strip(q) != "")


def _spelled(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "VOID", "None")
        .when(kind == "BOOLEAN", F.initcap(F.try_variant_get(value, "$", "string")))
        .otherwise(F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value)))
    )
