"""Label reports with concepts: present 1, absent 0, uncertain -1, with quotes.

Every label depends on one report only, so it is computed inside the row: cut
the text into sentences, keep the ones that mention the concept, judge each
mention, resolve the document.  No step shuffles, a skewed report id or source
changes nothing, and the same code runs on a stream.

Work is saved in this order: a concept none of whose anchor words occurs in the
text costs one substring search; a report without any anchor is never cut into
sentences; only sentences that match a concept are judged.  Anchors are looked
for before skipped blocks are removed, which can only let more through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    EVIDENCE_SEPARATOR,
    MAX_EVIDENCE,
    NEGATION_AFTER,
    NEGATION_CUES,
    UNCERTAINTY_CUES,
    WINDOW_AFTER,
    WINDOW_BEFORE,
)
from ..functions.text import any_of, eligible_lines, fold, let, matches, pattern, report_lines, sentences, sql_text
from ..session import settle
from .lexicon import ConceptRule, LesionRule, check_lexicon, default_lexicon

ABSENT, PRESENT, UNCERTAIN = 0, 1, -1
_LINES, _FOLDED, _ANCHOR, _PARTS = "__lines", "__folded", "__anchor_", "__parts"
_VERDICTS, _RESULTS = "__verdicts", "__results"

Rule = ConceptRule | LesionRule


# --- judging one sentence ---------------------------------------------------


def is_uncertain(sentence: Column) -> Column:
    """An uncertainty cue anywhere in the sentence."""
    return sentence.rlike(any_of(UNCERTAINTY_CUES))


def is_negated(sentence: Column, before: Column) -> Column:
    """A cue in the window ending at a match, or "is absent" in the one starting there.

    ``before`` is the sentence up to the match.
    """
    after = F.substr(sentence, F.length(before) + 1, F.lit(WINDOW_AFTER))
    return F.right(before, F.lit(WINDOW_BEFORE)).rlike(any_of(NEGATION_CUES)) | matches(after, NEGATION_AFTER)


# The parts that differ from rule to rule are written as SQL text, one expression
# per rule: a lexicon of many rules is then a short plan to build.


def _matches_sql(text: str, regexes: Sequence[str]) -> str:
    return f"{text} RLIKE {sql_text(any_of(regexes))}"


def _anchored(rule: Rule, folded: str) -> str:
    """Does the folded sentence hold an anchor of the rule?"""
    tests = [f"contains({folded}, {sql_text(a)})" for a in rule.anchors]
    return f"({' OR '.join(tests)})" if tests else "TRUE"


def _counts_for(rule: Rule) -> str:
    """Can the sentence ``p`` say anything about the concept?  Cheap tests first."""
    tests = [_anchored(rule, "p.folded")] if rule.anchors else []
    if isinstance(rule, LesionRule):
        tests += [_matches_sql("p.sent", [r]) for r in (rule.context, rule.mention)]
    else:
        tests.append(_matches_sql("p.sent", rule.mentions + rule.always_present))
        tests += [_matches_sql("p.sent", [r]) for r in rule.require]
        tests += [f"NOT ({_matches_sql('p.sent', [r])})" for r in rule.forbid]
    return " AND ".join(tests)


def _before_sql(text: str, regex: str) -> str:
    """The text up to the first match, null without one."""
    upto = pattern(f"^((?s:.*?))(?:{regex})")
    return f"CASE WHEN {_matches_sql(text, [regex])} THEN regexp_extract({text}, {sql_text(upto)}, 1) END"


def _found(rule: ConceptRule, gate: str) -> str:
    """What the patterns of a rule find in the sentences that count, null behind its gate.

    ``before`` holds the text up to the first match of each mention pattern, null
    where it does not occur.
    """
    sure = _matches_sql("p.sent", rule.always_present) if rule.always_present else "FALSE"
    special = _matches_sql("p.sent", rule.special_uncertain) if rule.special_uncertain else "FALSE"
    before = ", ".join(_before_sql("p.sent", m) for m in rule.mentions)
    return f"""CASE WHEN {gate} THEN transform(
        filter({_PARTS}, p -> {_counts_for(rule)}),
        p -> named_struct('concept', {sql_text(rule.name)}, 'idx', p.idx, 'sent', p.sent, 'sure', {sure},
                          'special', {special}, 'before', CAST(array({before}) AS ARRAY<STRING>))) END"""


def _verdict(found: Column) -> Column:
    """Does the sentence state the concept as present, uncertain, absent?

    It can do two of these, as each mention has its own window.
    """
    sent, sure = found["sent"], found["sure"]
    vague = found["special"] | is_uncertain(sent)
    denials = F.transform(F.array_compact(found["before"]), lambda before: is_negated(sent, before))

    def decided(d: Column) -> Column:
        affirmed, denied = F.exists(d, lambda x: ~x), F.exists(d, lambda x: x)
        return F.struct(
            found["concept"].alias("concept"),
            found["idx"].alias("idx"),
            sent.alias("sent"),
            (sure | (affirmed & ~vague)).alias("present"),
            (~sure & affirmed & vague).alias("uncertain"),
            (~sure & denied).alias("absent"),
        )

    return let(denials, decided)


# --- resolving one document ---------------------------------------------------


def first_distinct(texts: Column, limit: int = MAX_EVIDENCE) -> Column:
    """The first ``limit`` texts that differ without regard to case."""
    return F.aggregate(
        texts,
        F.array().cast("array<string>"),
        lambda kept, t: F.when(
            (F.size(kept) < limit) & ~F.exists(kept, lambda k: F.lower(k) == F.lower(t)),
            F.concat(kept, F.array(t)),
        ).otherwise(kept),
    )


def _result(label: Column, evidence: Column) -> Column:
    return F.struct(label.cast("int").alias("label"), evidence.cast("array<string>").alias("evidence"))


def _nothing() -> Column:
    return _result(F.lit(ABSENT), F.array())


def _resolve(verdicts: Column) -> Column:
    """Present wins; uncertain counts only while nothing is negated."""
    present = F.exists(verdicts, lambda x: x["present"])
    uncertain = F.exists(verdicts, lambda x: x["uncertain"]) & ~F.exists(verdicts, lambda x: x["absent"])

    def winner(label: Column) -> Column:
        stated = F.filter(
            verdicts,
            lambda x: F.when(label == PRESENT, x["present"])
            .when(label == UNCERTAIN, x["uncertain"])
            .otherwise(x["absent"]),
        )
        return _result(label, first_distinct(F.transform(stated, lambda x: x["sent"])))

    return let(F.when(present, PRESENT).when(uncertain, UNCERTAIN).otherwise(ABSENT), winner)


def _in_context(result: Column, context: str) -> Column:
    """Keep evidence in context; present without any becomes absent."""

    def narrowed(r: Column) -> Column:
        kept = F.filter(r["evidence"], lambda e: matches(e, context))
        return (
            F.when(F.size(kept) > 0, _result(r["label"], kept))
            .when(r["label"] == PRESENT, _nothing())
            .otherwise(r)
        )

    return let(result, narrowed)


def _lesion_verdict(rule: LesionRule, sent: Column) -> Column:
    confirmed = matches(sent, rule.confirming)
    equivocal = matches(sent, rule.equivocal)
    before = F.regexp_extract(sent, pattern(f"^((?s:.*?))(?:{rule.mention})"), 1)
    counted = ~is_negated(sent, before) & (confirmed | ~matches(sent, rule.excluding))
    unsure = is_uncertain(sent) | equivocal
    return F.struct(
        sent.alias("sent"),
        (counted & confirmed & ~unsure).alias("present"),
        (counted & ((confirmed & unsure) | (~confirmed & equivocal))).alias("uncertain"),
        F.lit(False).alias("absent"),
    )


def _lesion_result(rule: LesionRule) -> Column:
    hits = F.expr(f"filter({_PARTS}, p -> {_counts_for(rule)})")
    verdicts = F.transform(hits, lambda p: _lesion_verdict(rule, p["sent"]))
    explained = F.col(f"`{rule.yields_to}`")["label"] == PRESENT

    def narrowed(r: Column) -> Column:
        return F.when(explained & (r["label"] == UNCERTAIN), _nothing()).otherwise(r)

    return let(let(verdicts, _resolve), narrowed)


# --- labelling reports ----------------------------------------------------------


def _anchors(rules: Sequence[Rule]) -> dict[str, str]:
    """A column name for each distinct anchor."""
    return {a: f"{_ANCHOR}{i}" for i, a in enumerate(dict.fromkeys(a for r in rules for a in r.anchors))}


def _gate(rule: Rule, anchors: dict[str, str]) -> str:
    """Does the report hold an anchor of the rule?"""
    return f"({' OR '.join(anchors[a] for a in rule.anchors)})" if rule.anchors else "TRUE"


def _prepare(reports: DataFrame, rules: Sequence[Rule], text_col: str, mode: str) -> DataFrame:
    """Add the anchors, the numbered sentences and the verdicts of each concept rule."""
    if mode not in ("report", "direct"):
        raise ValueError(f"mode must be 'report' or 'direct', not {mode!r}")
    anchors = _anchors(rules)
    any_gate = " OR ".join(dict.fromkeys(_gate(r, anchors) for r in rules))
    eligible = eligible_lines(F.col(_LINES), F.col(_FOLDED), mode)
    prepared = (
        reports.withColumn(_LINES, report_lines(F.col(f"`{text_col}`")))
        .withColumn(_FOLDED, fold(F.col(_LINES)))
        .selectExpr("*", *[f"contains({_FOLDED}, {sql_text(a)}) AS {name}" for a, name in anchors.items()])
        .withColumn(_PARTS, F.when(F.expr(any_gate), _numbered(eligible)))
    )
    per_rule = [_found(r, _gate(r, anchors)) for r in rules if isinstance(r, ConceptRule)]
    found = F.expr(f"array({', '.join(per_rule)})")
    return prepared.withColumn(_VERDICTS, F.transform(found, lambda sents: F.transform(sents, _verdict)))


def _numbered(text: Column) -> Column:
    return F.transform(sentences(text), lambda s, i: F.struct(i.alias("idx"), s.alias("sent"), fold(s).alias("folded")))


def label_results(
    reports: DataFrame,
    rules: Sequence[Rule] | None = None,
    text_col: str = "report_text",
    mode: str = "report",
) -> DataFrame:
    """Add one ``struct<label, evidence>`` column per concept, named after it."""
    rules = tuple(rules) if rules is not None else default_lexicon()
    check_lexicon(rules)
    plain = [r for r in rules if isinstance(r, ConceptRule)]
    lesions = [r for r in rules if isinstance(r, LesionRule)]
    kept = [F.col(f"`{c}`") for c in reports.columns]

    resolved = F.transform(F.col(_VERDICTS), lambda v: F.when(v.isNull(), _nothing()).otherwise(_resolve(v)))
    labelled = _prepare(reports, rules, text_col, mode).withColumn(_RESULTS, resolved)
    columns = {}
    for i, rule in enumerate(plain):
        result = F.get(F.col(_RESULTS), F.lit(i))
        columns[rule.name] = _in_context(result, rule.evidence_context) if rule.evidence_context else result
    labelled = labelled.withColumns(columns)
    if lesions:
        labelled = labelled.withColumns(
            {r.name: F.when(F.expr(_gate(r, _anchors(rules))), _lesion_result(r)).otherwise(_nothing()) for r in lesions}
        )
    results = {name: F.col(f"`{name}`") for name in names_of(rules)}
    return settle(labelled.select(*kept, *results.values()), results)


def names_of(rules: Sequence[Rule] | None) -> list[str]:
    return [r.name for r in (rules if rules is not None else default_lexicon())]


def to_long(results: DataFrame, names: Sequence[str], id_col: str = "report_id") -> DataFrame:
    """One row per report and concept: report_id, concept, label, evidence."""
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("concept"),
                F.col(f"`{n}`")["label"].alias("label"),
                F.col(f"`{n}`")["evidence"].alias("evidence"),
            )
            for n in names
        ]
    )
    return results.select(F.col(f"`{id_col}`").alias("report_id"), F.inline(rows))


def to_wide(results: DataFrame, names: Sequence[str], id_col: str = "report_id") -> DataFrame:
    """One row per report with ``<concept>`` and ``evidence_<concept>`` columns.

    The concepts are columns already, so this is a projection, not a pivot.
    """
    columns = [F.col(f"`{id_col}`").alias("report_id")]
    for n in names:
        columns.append(F.col(f"`{n}`")["label"].alias(n))
        columns.append(F.array_join(F.col(f"`{n}`")["evidence"], EVIDENCE_SEPARATOR).alias(f"evidence_{n}"))
    return results.select(*columns)


def to_nested(
    results: DataFrame, names: Sequence[str], id_col: str = "report_id", extra: Sequence[str] = ()
) -> DataFrame:
    """One row per report with a label map, an evidence map and ``extra`` columns."""
    keys = F.array(*[F.lit(n) for n in names])
    return results.select(
        F.col(f"`{id_col}`").alias("report_id"),
        F.map_from_arrays(keys, F.array(*[F.col(f"`{n}`")["label"] for n in names])).alias("labels"),
        F.map_from_arrays(keys, F.array(*[F.col(f"`{n}`")["evidence"] for n in names])).alias("evidence"),
        *extra,
    )


def label_concepts(
    reports: DataFrame,
    rules: Sequence[Rule] | None = None,
    id_col: str = "report_id",
    text_col: str = "report_text",
    mode: str = "report",
) -> DataFrame:
    """Reports to long labels.  Works on batch and streaming frames alike."""
    narrow = reports.select(F.col(f"`{id_col}`").alias("report_id"), F.col(f"`{text_col}`").alias("report_text"))
    return to_long(label_results(narrow, rules, mode=mode), names_of(rules))


def pivot_labels(labels: DataFrame, names: Sequence[str]) -> DataFrame:
    """Long labels that arrive as a table, back to one row per report.

    The names are given, so no job is needed to find them.  The pivot is a
    partial aggregate over at most one row per report and concept.
    """
    tidy = labels.select(
        "report_id", "concept", F.struct("label", F.array_join("evidence", EVIDENCE_SEPARATOR).alias("quote")).alias("v")
    )
    wide = tidy.groupBy("report_id").agg(
        *[F.max(F.when(F.col("concept") == n, F.col("v"))).alias(f"__{i}") for i, n in enumerate(names)]
    )
    columns = [F.col("report_id")]
    for i, n in enumerate(names):
        columns += [F.col(f"__{i}")["label"].alias(n), F.col(f"__{i}")["quote"].alias(f"evidence_{n}")]
    return wide.select(*columns)


def unpivot_labels(wide: DataFrame, names: Sequence[str], id_col: str = "report_id") -> DataFrame:
    """One row per report and concept from a wide label table: a narrow explode."""
    rows = F.array(
        *[F.struct(F.lit(n).alias("concept"), F.col(f"`{n}`").cast("string").alias("label")) for n in names]
    )
    return wide.select(F.col(f"`{id_col}`").alias("case_id"), F.inline(rows))


# --- the mentions behind the labels ------------------------------------------------


def mentions(
    reports: DataFrame,
    rules: Sequence[Rule] | None = None,
    id_col: str = "report_id",
    text_col: str = "report_text",
    mode: str = "report",
) -> DataFrame:
    """Every sentence that speaks for or against a concept.

    report_id, idx (sentence number from 0), sent, concept, kind with kind one
    of P, U, A; a sentence can give two kinds.  Lesion rules are decided per
    document and have no rows here.
    """
    rules = [r for r in (rules if rules is not None else default_lexicon()) if isinstance(r, ConceptRule)]
    narrow = reports.select(F.col(f"`{id_col}`").alias("report_id"), F.col(f"`{text_col}`").alias("report_text"))
    verdicts = _prepare(narrow, rules, "report_text", mode).select(
        "report_id", F.inline(F.flatten(F.filter(F.col(_VERDICTS), lambda v: v.isNotNull())))
    )
    kinds = F.array_compact(F.array(F.when(F.col("present"), "P"), F.when(F.col("uncertain"), "U"), F.when(F.col("absent"), "A")))
    return verdicts.select("report_id", "idx", "sent", "concept", F.explode(kinds).alias("kind"))
