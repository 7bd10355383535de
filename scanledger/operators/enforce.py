"""Labels that came from a model: read them, check them against the report.

Everything happens inside the row that holds the report's eligible text and the
response, so nothing shuffles beyond the join that brought the two together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.completions import coerced_evidence, coerced_label, json_block, quote_in_text
from ..functions.text import eligible_text, let, matches, squeeze
from ..session import settle
from .labels import ABSENT, PRESENT, UNCERTAIN, _result, label_results

CONCEPTS = tuple(fixed.CONCEPT_QUESTIONS)
_SQUEEZED, _ELIGIBLE, _PAYLOAD, _RESULTS = "__squeezed", "__eligible", "__payload", "__results"


def _field(payload: Column, name: str) -> Column:
    """A JSON object as a map of its values; empty if it is something else."""
    empty = F.create_map().cast("map<string,variant>")
    return F.coalesce(F.try_variant_get(payload, f"$.{name}", "map<string,variant>"), empty)


def _columns_of(df: DataFrame, results: Column, concepts: Sequence[str]) -> DataFrame:
    """An array of results, in the order of the concepts, as one column each."""
    listed = settle(df, {_RESULTS: results})
    taken = {c: F.get(F.col(_RESULTS), F.lit(i)) for i, c in enumerate(concepts)}
    return listed.withColumns(taken).drop(_RESULTS)


def parse_labels(df: DataFrame, payload_col: str, concepts: Sequence[str] = CONCEPTS) -> DataFrame:
    """Add one result column per concept from a payload of labels and evidence."""
    payload = F.col(f"`{payload_col}`")
    read = df.withColumns({"__labels": _field(payload, "labels"), "__evidence": _field(payload, "evidence")})
    results = F.transform(
        F.array(*[F.lit(c) for c in concepts]),
        lambda c: _result(
            coerced_label(F.try_element_at(F.col("__labels"), c)),
            coerced_evidence(F.try_element_at(F.col("__evidence"), c)),
        ),
    )
    return _columns_of(read, results, concepts).drop("__labels", "__evidence")


def _quoted(result: Column) -> Column:
    """Present needs a quote that is in the text; the first three such quotes stay."""
    valid = F.filter(result["evidence"], lambda q: quote_in_text(q, F.col(_SQUEEZED)))
    return F.when(
        result["label"] == PRESENT,
        let(
            valid,
            lambda quotes: F.when(
                F.size(quotes) > 0, _result(F.lit(PRESENT), F.slice(quotes, 1, fixed.MAX_EVIDENCE))
            ).otherwise(_result(F.lit(UNCERTAIN), F.array())),
        ),
    ).otherwise(result)


def _coronary(result: Column) -> Column:
    """Present needs both cues in its quotes, or in the text when the quotes are empty."""
    joined = F.coalesce(F.nullif(F.array_join(result["evidence"], " "), F.lit("")), F.col(_ELIGIBLE))
    both = matches(joined, fixed.CORONARY_WORD) & matches(joined, fixed.CALCIFICATION_STEM)
    return F.when((result["label"] == PRESENT) & ~both, _result(F.lit(UNCERTAIN), F.array())).otherwise(result)


def _renal(cyst: Column, hypodensities: Column) -> tuple[Column, Column]:
    """Cyst-like quotes make the cyst present, and a cyst takes the hypodensity over."""
    quoted_cyst = F.array_join(cyst["evidence"], " ")
    quoted_hypo = F.array_join(hypodensities["evidence"], " ")
    cyst_like = matches(quoted_cyst, fixed.CYST_STEM) | matches(quoted_hypo, fixed.LIKELY_CYST)
    new_cyst = _result(F.when(cyst_like, PRESENT).otherwise(cyst["label"]), cyst["evidence"])
    is_cyst = cyst_like | (cyst["label"] == PRESENT)
    taken = is_cyst & matches(quoted_hypo, fixed.CYST_STEM)
    return new_cyst, F.when(taken, _result(F.lit(ABSENT), F.array())).otherwise(hypodensities)


def enforce_labels(df: DataFrame, text_col: str, concepts: Sequence[str] = CONCEPTS) -> DataFrame:
    """Check result columns against the eligible part of ``text_col``."""
    checked = df.withColumn(_ELIGIBLE, eligible_text(F.col(f"`{text_col}`"))).withColumn(
        _SQUEEZED, F.lower(squeeze(F.col(_ELIGIBLE)))
    )
    given = F.array(*[F.col(f"`{c}`") for c in concepts])
    checked = _columns_of(checked, F.transform(given, _quoted), concepts)
    if "coronary_calcification" in concepts:
        checked = checked.withColumn("coronary_calcification", _coronary(F.col("coronary_calcification")))
    if {"renal_cyst", "renal_hypodensities"} <= set(concepts):
        cyst, hypodensities = _renal(F.col("renal_cyst"), F.col("renal_hypodensities"))
        checked = checked.withColumns({"renal_cyst": cyst, "renal_hypodensities": hypodensities})
    return checked.drop(_ELIGIBLE, _SQUEEZED)


def parse_label_responses(
    df: DataFrame, text_col: str = "report_text", content_col: str = "content", mode: str = "report"
) -> DataFrame:
    """Reports with a response each -> result columns and the raw payload.

    A response without usable JSON falls back to the rule labels, which read the
    text as ``mode`` says ("report" or "direct").  Both are branches of one
    expression per row: the rules only run for such rows.
    """
    rules_only = F.col(_PAYLOAD).isNull() | (F.to_json(F.col(_PAYLOAD)) == "{}")
    kept = [c for c in df.columns if c != text_col]
    rule_text, rule_name = "__rule_text", "__rule_{}".format
    prepared = settle(df, {_PAYLOAD: json_block(F.col(f"`{content_col}`"))})
    # Without text the rules find no anchor word and stop there.
    fallback = prepared.withColumn(rule_text, F.when(rules_only, F.col(f"`{text_col}`")))
    ruled = label_results(fallback, text_col=rule_text, mode=mode)
    ruled = ruled.withColumnsRenamed({c: rule_name(c) for c in CONCEPTS}).drop(rule_text)
    enforced = enforce_labels(parse_labels(ruled, _PAYLOAD), text_col)
    chosen = [F.when(rules_only, F.col(rule_name(c))).otherwise(F.col(c)).alias(c) for c in CONCEPTS]
    payload = F.coalesce(F.to_json(F.col(_PAYLOAD)), F.lit("{}")).alias("raw_payload")
    return enforced.select(*[F.col(f"`{c}`") for c in kept], *chosen, payload)


