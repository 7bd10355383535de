"""The registered queries in SQL, for DuckDB over the same tables.

Written from the definitions, with windows over lines and rows per mention
where the Spark side uses one regular expression or works inside a row.  RE2
has no look-behind and its word boundary is ASCII, so sentences are cut by
replacing and letters outside ASCII are masked before matching.
"""

from __future__ import annotations

from collections.abc import Callable

from ..functions import fixed_values as fixed
from ..functions.prompts import DEFAULT_TEMPLATES, label_prompt_parts
from ..operators.lexicon import ConceptRule, default_lexicon
from . import derived, queries

_CHECKS: dict[str, Callable[[], str]] = {}

BLANK = r"[\t\n\x0b\f\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def check(function: Callable[[], str]) -> Callable[[], str]:
    _CHECKS[function.__name__] = function
    return function


def all_checks() -> dict[str, str]:
    from . import file_checks  # noqa: F401 - registers its checks

    return {name: build() for name, build in _CHECKS.items()}


def text(value: str) -> str:
    """A text as SQL."""
    return "'" + value.replace("'", "''") + "'"


def strip(column: str) -> str:
    return f"regexp_replace({column}, '^{BLANK}+|{BLANK}+$', '', 'g')"


def cell(column: str) -> str:
    return f"lower({strip(column)})"


def has(column: str, regex: str) -> str:
    return f"regexp_matches({column}, {text('(?i)' + regex)})"


def one_of(column: str, regexes) -> str:
    return has(column, "|".join(f"(?:{r})" for r in regexes))


def words(values) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


def mask(column: str) -> str:
    return rf"regexp_replace(regexp_replace({column}, '[^\x00-\x7f\pL\pN]', ' ', 'g'), '[^\x00-\x7f]', 'x', 'g')"


# --- shared parts ---------------------------------------------------------------------

REPORTS = f"reports AS ({derived.REPORTS_SQL})"

_REGION = (
    rf"CASE WHEN regexp_matches(report_text, '(?i){fixed.FINDINGS_HEADING}') "
    rf"THEN {strip(rf'''regexp_extract(report_text, '(?is){fixed.FINDINGS_HEADING}.*')''')} ELSE report_text END"
)


def _eligible(name: str, closes: str) -> str:
    """The region without skipped blocks, by the last heading above each line."""
    opens = f"regexp_full_match({strip('line')}, '(?i)({'|'.join(fixed.SKIPPED_HEADINGS)}){BLANK}*:?')"
    return f"""
    {name}_lines AS (SELECT report_id, unnest(string_split(t, chr(10))) AS line,
        generate_subscripts(string_split(t, chr(10)), 1) AS i FROM (SELECT report_id, {_REGION} AS t FROM reports)),
    {name}_marked AS (SELECT *, CASE WHEN {opens} THEN 1 WHEN {closes} THEN 0 END AS mark FROM {name}_lines),
    {name}_open AS (SELECT *, last_value(mark IGNORE NULLS) OVER (PARTITION BY report_id ORDER BY i) AS inside FROM {name}_marked),
    {name} AS (SELECT report_id, {strip("coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE coalesce(inside, 0) = 0), '')")} AS t
        FROM {name}_open GROUP BY report_id)"""


_KNOWN = f"regexp_full_match({strip('line')}, '(?i)({'|'.join(fixed.KEPT_HEADINGS)}){BLANK}*:?')"
_UPPER = f"regexp_full_match({strip('line')}, '{fixed.UPPER_CASE_HEADING}')"
ELIGIBLE = f"{REPORTS}, {_eligible('eligible', _KNOWN)}"

SENTENCES = rf"""{ELIGIBLE},
    parts AS (SELECT report_id, string_split_regex(regexp_replace(t, '([.?!]){BLANK}+', '\1' || chr(10), 'g'), '\n+') AS p FROM eligible),
    pieces AS (SELECT report_id, {strip('piece')} AS sent, i FROM
        (SELECT report_id, unnest(p) AS piece, generate_subscripts(p, 1) AS i FROM parts)),
    sents AS MATERIALIZED (SELECT report_id, CAST(row_number() OVER (PARTITION BY report_id ORDER BY i) - 1 AS INTEGER) AS idx, sent,
        {mask('sent')} AS ms FROM pieces WHERE sent <> '')"""


def _negated(sentence: str, before: str) -> str:
    return (
        f"({one_of(f'right({before}, {fixed.WINDOW_BEFORE})', fixed.NEGATION_CUES)} OR "
        f"{has(f'substr({sentence}, length({before}) + 1, {fixed.WINDOW_AFTER})', fixed.NEGATION_AFTER)})"
    )


def _before(regex: str) -> str:
    return f"regexp_extract(ms, {text(f'(?is)^(.*?)(?:{regex})')}, 1)"


def _rule_rows(rule: ConceptRule) -> list[str]:
    gates = [has("ms", r) for r in rule.require] + [f"NOT {has('ms', r)}" for r in rule.forbid]
    where = " AND ".join(gates) or "TRUE"
    rows = []
    if rule.always_present:
        sure = one_of("ms", rule.always_present)
        rows.append(f"SELECT report_id, idx, sent, '{rule.name}' AS concept, 'P' AS kind FROM sents WHERE {where} AND {sure}")
        where += f" AND NOT {sure}"
    vague = one_of("ms", (*rule.special_uncertain, *fixed.UNCERTAINTY_CUES))
    for regex in rule.mentions:
        kind = f"CASE WHEN {_negated('ms', 'pre')} THEN 'A' WHEN {vague} THEN 'U' ELSE 'P' END"
        rows.append(
            f"SELECT report_id, idx, sent, '{rule.name}' AS concept, {kind} AS kind FROM "
            f"(SELECT *, {_before(regex)} AS pre FROM sents WHERE {has('ms', regex)} AND {where})"
        )
    return rows


def _kinds() -> str:
    rows = [row for rule in default_lexicon() if isinstance(rule, ConceptRule) for row in _rule_rows(rule)]
    return f"{SENTENCES}, kinds AS MATERIALIZED (SELECT DISTINCT * FROM ({' UNION ALL '.join(rows)}))"


def _lesion_kinds() -> str:
    confirmed, equivocal = has("ms", fixed.NON_CYSTIC_CUES), has("ms", fixed.TOO_SMALL_CUES)
    unsure = f"({one_of('ms', fixed.UNCERTAINTY_CUES)} OR {equivocal})"
    return f"""lesions AS (SELECT report_id, idx, sent, 'renal_hypodensities' AS concept,
        CASE WHEN {confirmed} AND NOT {unsure} THEN 'P' WHEN {confirmed} OR {equivocal} THEN 'U' END AS kind
        FROM (SELECT *, {_before(fixed.HYPODENSITY_MENTION)} AS pre FROM sents
              WHERE {has('ms', fixed.RENAL_CONTEXT)} AND {has('ms', fixed.HYPODENSITY_MENTION)})
        WHERE NOT {_negated('ms', 'pre')} AND NOT ({has('ms', fixed.CYSTIC_CUES)} AND NOT {confirmed}))"""


def _labels() -> str:
    concepts = ", ".join(f"('{c}')" for c in fixed.CONCEPT_QUESTIONS)
    context = f"[e FOR e IN evidence IF {has(mask('e'), fixed.RENAL_CONTEXT)}]"
    return f"""{_kinds()}, {_lesion_kinds()},
    stated AS (SELECT * FROM kinds UNION ALL SELECT * FROM lesions WHERE kind IS NOT NULL),
    resolved AS (SELECT report_id, concept, CASE WHEN bool_or(kind = 'P') THEN 1
        WHEN bool_or(kind = 'U') AND NOT bool_or(kind = 'A') THEN -1 ELSE 0 END AS label FROM stated GROUP BY report_id, concept),
    firsts AS (SELECT s.report_id, s.concept, min(idx) AS idx, arg_min(sent, idx) AS sent FROM stated s JOIN resolved r
        ON s.report_id = r.report_id AND s.concept = r.concept AND s.kind = CASE r.label WHEN 1 THEN 'P' WHEN -1 THEN 'U' ELSE 'A' END
        GROUP BY s.report_id, s.concept, lower(sent)),
    top3 AS (SELECT * FROM firsts QUALIFY row_number() OVER (PARTITION BY report_id, concept ORDER BY idx) <= 3),
    quoted AS (SELECT report_id, concept, list(sent ORDER BY idx) AS evidence FROM top3 GROUP BY report_id, concept),
    filled AS (SELECT r.report_id, c.concept, coalesce(x.label, 0) AS label, coalesce(q.evidence, []) AS evidence
        FROM reports r CROSS JOIN (VALUES {concepts}) c(concept)
        LEFT JOIN resolved x ON x.report_id = r.report_id AND x.concept = c.concept
        LEFT JOIN quoted q ON q.report_id = r.report_id AND q.concept = c.concept),
    cysts AS (SELECT report_id, concept, CASE WHEN label = 1 AND len({context}) = 0 THEN 0 ELSE label END AS label,
        CASE WHEN len({context}) > 0 THEN {context} WHEN label = 1 THEN [] ELSE evidence END AS evidence
        FROM filled WHERE concept = 'renal_cyst'),
    hypodensities AS (SELECT f.report_id, f.concept, CASE WHEN f.label = -1 AND c.label = 1 THEN 0 ELSE f.label END AS label,
        CASE WHEN f.label = 0 OR (f.label = -1 AND c.label = 1) THEN [] ELSE f.evidence END AS evidence
        FROM filled f JOIN cysts c USING (report_id) WHERE f.concept = 'renal_hypodensities'),
    labels AS MATERIALIZED (SELECT report_id, concept, CAST(label AS INTEGER) AS label,
        array_to_string(evidence, {text(fixed.EVIDENCE_SEPARATOR)}) AS evidence, evidence AS quotes
        FROM (SELECT * FROM filled WHERE concept NOT IN ('renal_cyst', 'renal_hypodensities')
              UNION ALL SELECT * FROM cysts UNION ALL SELECT * FROM hypodensities))"""


def _with_labels(select: str) -> str:
    return f"WITH {_labels()} {select}"


# --- text and labels --------------------------------------------------------------------


@check
def report_regions() -> str:
    return f"""WITH {ELIGIBLE}, {_eligible('direct', _UPPER)}
    SELECT report_id, e.t AS eligible, d.t AS eligible_direct FROM eligible e JOIN direct d USING (report_id)"""


@check
def report_sentences() -> str:
    return f"WITH {SENTENCES} SELECT report_id, idx, sent FROM sents"


@check
def concept_mentions() -> str:
    return f"WITH {_kinds()} SELECT report_id, idx, sent, concept, kind FROM kinds"


@check
def concept_labels() -> str:
    return _with_labels("SELECT report_id, concept, label, evidence FROM labels")


def _wide() -> str:
    columns = ", ".join(
        f"max(label) FILTER (WHERE concept = '{c}') AS {c}, max(evidence) FILTER (WHERE concept = '{c}') AS evidence_{c}"
        for c in fixed.CONCEPT_QUESTIONS
    )
    return f"SELECT report_id, {columns} FROM labels GROUP BY report_id"


@check
def concept_labels_wide() -> str:
    return _with_labels(_wide())


@check
def concept_labels_pivoted() -> str:
    return _with_labels(_wide())


@check
def concept_labels_nested() -> str:
    return concept_labels()


@check
def concept_counts() -> str:
    return _with_labels("SELECT concept, label, count(*) AS n FROM labels GROUP BY concept, label")


@check
def renal_gates() -> str:
    return _with_labels(
        "SELECT report_id, concept, label, evidence FROM labels WHERE concept IN ('renal_cyst', 'renal_hypodensities')"
    )


@check
def hydronephrosis_special() -> str:
    return _with_labels("SELECT report_id, concept, label, evidence FROM labels WHERE concept = 'hydronephrosis'")


@check
def stream_labels() -> str:
    return concept_labels()


# --- prompts and requests -----------------------------------------------------------------


def prompt(template: str, **columns: str) -> str:
    """A template as SQL, its places replaced by columns."""
    out = text(template)
    for name, column in columns.items():
        out = out.replace("{" + name + "}", f"' || {column} || '")
    return out


def _catalog() -> str:
    rows = ", ".join(f"({text(name)}, {text(body)})" for name, (body, _) in derived.CATEGORIES.items())
    asked = ", ".join(
        f"({text(name)}, {text(fixed.CONCEPT_QUESTIONS[c])})" for name, (_, cs) in derived.CATEGORIES.items() for c in cs
    )
    return (
        f"categories(category, description) AS (VALUES {rows}), "
        f"asked AS (SELECT category, question, left(md5(question), 8) AS question_id FROM (VALUES {asked}) v(category, question))"
    )


def _refused(column: str, values) -> str:
    return f"{cell(column)} IN {words(('', *values))}"


STAGES = f"""{REPORTS}, {_catalog()},
    no_comparisons AS (SELECT report_id, {derived.NO_COMPARISON_SQL} AS no_comparison_text FROM reports),
    all_findings AS (SELECT report_id, {derived.FINDINGS_SQL} AS findings FROM reports),
    findings AS (SELECT * FROM all_findings WHERE NOT {_refused('findings', fixed.NO_SECTION)})"""


def hashed(pool, *columns: str) -> str:
    """An item of a pool picked by the md5 of some columns."""
    cases = " ".join(f"WHEN {i} THEN {text(item)}" for i, item in enumerate(pool))
    joined = f"concat_ws(':', {', '.join(columns)})"
    return f"CASE CAST('0x' || left(md5({joined}), 4) AS INTEGER) % {len(pool)} {cases} END"


STORED = f"""{STAGES},
    category_answers AS (SELECT report_id, category, CASE WHEN kind = 'seen' THEN category || ': ' || findings ELSE kind END AS content
        FROM (SELECT report_id, category, findings,
              {hashed(("No relevant findings", "error", "seen", "seen", "No relevant findings."), "report_id", "category")} AS kind
              FROM findings CROSS JOIN categories)),
    category_findings AS (SELECT report_id, category, content AS findings FROM category_answers
        WHERE NOT {_refused('content', fixed.FAILED_CATEGORY)}),
    questions AS (SELECT * FROM (SELECT report_id, category, question_id, question,
        {hashed(derived.ANSWERS, "report_id", "category", "question_id")} AS answer FROM reports CROSS JOIN asked)
        WHERE {strip('answer')} <> '')"""


@check
def requests_simple() -> str:
    first = prompt(DEFAULT_TEMPLATES["remove_comparison"], report="report_text")
    second = prompt(DEFAULT_TEMPLATES["extract_findings"], report="no_comparison_text")
    return f"""WITH {STAGES} SELECT report_id, report_id AS request_id, {first} AS prompt, 'no_comparisons' AS stage FROM reports
    UNION ALL SELECT report_id, report_id AS request_id, {second} AS prompt, 'findings' AS stage FROM no_comparisons"""


@check
def requests_categories() -> str:
    asked = prompt(DEFAULT_TEMPLATES["map_category_findings"], findings="findings", category="category", description="description")
    return f"""WITH {STAGES} SELECT report_id, category, report_id || '_' || category AS request_id, {asked} AS prompt
    FROM findings CROSS JOIN categories"""


@check
def requests_questions() -> str:
    asked = prompt(DEFAULT_TEMPLATES["findings_question"], report="report_text", question="question")
    return f"""WITH {STAGES} SELECT report_id, category, question_id, question,
    report_id || '_' || category || '_' || question_id AS request_id, {asked} AS prompt FROM reports CROSS JOIN asked"""


@check
def requests_resumed() -> str:
    return f"""WITH {STORED} SELECT report_id, category, question_id, report_id || '_' || category || '_' || question_id AS request_id
    FROM reports CROSS JOIN asked WHERE NOT EXISTS (SELECT 1 FROM questions q WHERE q.report_id = reports.report_id
        AND q.category = asked.category AND q.question_id = asked.question_id AND q.answer <> 'true')"""


@check
def label_prompts() -> str:
    opening, closing = label_prompt_parts(tuple(fixed.CONCEPT_QUESTIONS))
    return f"WITH {ELIGIBLE} SELECT report_id, report_id AS request_id, {text(opening)} || t || {text(closing)} AS prompt FROM eligible"


# --- responses ------------------------------------------------------------------------------

TURNS = f"turns AS ({derived.TURNS_SQL})"
LINES = f"{TURNS}, lines AS (SELECT {derived.LINE_SQL} AS value, conv_id * 1000 + turn AS ord FROM turns)"


def _read_lines(source: str) -> str:
    content = (
        "CASE json_type(value, '$.response.body.choices') WHEN 'ARRAY' THEN json_extract_string(value, '$.response.body.choices[0].message.content') "
        "WHEN 'OBJECT' THEN json_extract_string(value, '$.response.body.choices.message.content') END"
    )
    cut = strip(r"regexp_replace(coalesce(content, ''), '(?s)^.*</think>', '')")
    return f"""read AS (SELECT json_extract_string(value, '$.custom_id') AS request_id, {content} AS content, ord FROM {source} WHERE json_valid(value)),
    answers AS (SELECT request_id, {cut} AS content FROM read WHERE request_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY ord DESC) = 1)"""


@check
def response_lines() -> str:
    return f"WITH {LINES}, {_read_lines('lines')} SELECT request_id, content FROM answers"


@check
def response_last_line() -> str:
    again = """repeated AS (SELECT * FROM lines UNION ALL SELECT replace(value, '"content": "', '"content": "Again: '),
        ord + 1000000000 * (ord % 3) FROM lines WHERE ord % 3 > 0)"""
    return f"WITH {LINES}, {again}, {_read_lines('repeated')} SELECT request_id, content FROM answers"


@check
def chat_bodies() -> str:
    layout = "(conv_id * 3 + turn) % 8"
    return f"""WITH {TURNS} SELECT request_id,
    CASE WHEN {layout} IN (0, 1, 2, 3, 4, 5) THEN content ELSE '' END AS content,
    CASE {layout} WHEN 0 THEN CASE content WHEN '' THEN 'why' ELSE content END WHEN 7 THEN content ELSE '' END AS content_or_reasoning
    FROM turns"""


def _kept(stage: str, refused) -> str:
    return f"SELECT '{stage}' AS stage, request_id, content FROM turns WHERE NOT {_refused('content', refused)}"


@check
def responses_valid() -> str:
    refused = {"no_comparisons": (), "findings": fixed.NO_SECTION, "category_findings": fixed.FAILED_CATEGORY, "questions": ()}
    return f"WITH {TURNS} " + " UNION ALL ".join(_kept(stage, r) for stage, r in refused.items())


@check
def rejected_patterns() -> str:
    word = cell("content")
    shape = f"CASE WHEN {word} = '' THEN 'EMPTY' WHEN length({word}) < 20 THEN 'SHORT: ''' || {word} || '''' ELSE 'LONG: ''' || left({word}, 30) || '...''' END"
    parts = [
        f"SELECT {shape} AS pattern, count(*) AS n, '{stage}' AS stage FROM turns WHERE {_refused('content', refused)} GROUP BY 1"
        for stage, refused in (("findings", fixed.NO_SECTION), ("category_findings", fixed.FAILED_CATEGORY))
    ]
    return f"WITH {TURNS} " + " UNION ALL ".join(parts)


@check
def response_patterns() -> str:
    word = cell("content")
    return f"""WITH {TURNS} SELECT CASE WHEN {word} = '' THEN 'EMPTY' WHEN {word} LIKE '%no relevant findings%' THEN 'no_relevant_findings'
    WHEN {word} LIKE '%no findings%' THEN 'no_findings' WHEN {word} LIKE '%normal%' THEN 'normal'
    WHEN length({word}) < 10 THEN 'very_short' ELSE 'substantial' END AS pattern, count(*) AS n FROM turns GROUP BY 1"""


@check
def response_counts() -> str:
    return f"""WITH {TURNS} SELECT count(*) FILTER (WHERE {strip('content')} <> '') AS n_non_empty,
    count(*) FILTER (WHERE {strip('content')} = '') AS n_empty FROM turns"""


@check
def response_samples() -> str:
    return f"""WITH {TURNS} (SELECT request_id, content, 'any' AS kind FROM turns ORDER BY request_id LIMIT 5)
    UNION ALL (SELECT request_id, content, 'empty' AS kind FROM turns WHERE {strip('content')} = '' ORDER BY request_id LIMIT 3)"""


@check
def rejected_samples() -> str:
    parts = [
        f"(SELECT request_id, content, '{stage}' AS stage FROM turns WHERE {_refused('content', refused)} ORDER BY request_id LIMIT 10)"
        for stage, refused in (("findings", fixed.NO_SECTION), ("category_findings", fixed.FAILED_CATEGORY))
    ]
    return f"WITH {TURNS} " + " UNION ALL ".join(parts)


@check
def missing_results() -> str:
    return f"WITH {TURNS} SELECT request_id FROM turns WHERE (conv_id + turn) % 4 = 1"


@check
def filled_results() -> str:
    return f"WITH {TURNS} SELECT request_id, CASE WHEN (conv_id + turn) % 4 = 1 THEN '' ELSE content END AS content FROM turns"


@check
def matched_results() -> str:
    return f"WITH {STORED} SELECT report_id, category, findings FROM category_findings"


@check
def udf_answers() -> str:
    asked = prompt(DEFAULT_TEMPLATES["remove_comparison"], report="report_text")
    return f"""WITH {REPORTS} SELECT report_id, report_id AS request_id,
    CAST(length({asked}) - length(replace({asked}, ' ', '')) AS VARCHAR) AS content FROM reports"""


# --- stage tables and final results ------------------------------------------------------------

_ROWS = f"{TURNS}, stage_rows AS (SELECT CAST(conv_id AS VARCHAR) AS report_id, role || ' ' || turn % 3 AS category, content AS findings, conv_id FROM turns)"


@check
def stage_append() -> str:
    return f"""WITH {_ROWS}, firsts AS (SELECT report_id, category, max(findings) AS findings FROM stage_rows WHERE conv_id % 3 <> 0 GROUP BY 1, 2),
    seconds AS (SELECT report_id, category, max('again ' || findings) AS findings FROM stage_rows GROUP BY 1, 2)
    SELECT * FROM firsts UNION ALL SELECT * FROM seconds s
    WHERE NOT EXISTS (SELECT 1 FROM firsts f WHERE f.report_id = s.report_id AND f.category = s.category)"""


@check
def stream_append() -> str:
    return f"WITH {_ROWS} SELECT report_id, category, max(findings) AS findings FROM stage_rows GROUP BY 1, 2"


@check
def nest_flatten() -> str:
    return f"""WITH {STORED} SELECT report_id, category, -1 AS ord, '' AS question, findings AS value FROM category_findings
    UNION ALL SELECT report_id, category, CAST(row_number() OVER (PARTITION BY report_id, category ORDER BY question_id) - 1 AS INTEGER) AS ord,
    question, answer AS value FROM questions"""


@check
def valid_category_maps() -> str:
    return matched_results()


_SHOWN = """cats AS (SELECT report_id, string_agg(category || '=' || findings, '|' ORDER BY category) AS categories FROM category_findings GROUP BY report_id),
    per AS (SELECT report_id, category, category || ':' || string_agg(question || '=' || answer, ';' ORDER BY question_id) AS listed
        FROM questions GROUP BY report_id, category),
    ans AS (SELECT report_id, string_agg(listed, '|' ORDER BY category) AS answers FROM per GROUP BY report_id)"""
_SHOWN_SELECT = """SELECT report_id, raw_text, coalesce(no_comparison_text, '') AS no_comparison_text,
    coalesce(findings, '') AS findings_text, coalesce(categories, '') AS categories, coalesce(answers, '') AS answers
    FROM base LEFT JOIN no_comparisons USING (report_id) LEFT JOIN findings USING (report_id) LEFT JOIN cats USING (report_id) LEFT JOIN ans USING (report_id)"""


@check
def final_results() -> str:
    return f"WITH {STORED}, base AS (SELECT report_id, report_text AS raw_text FROM reports), {_SHOWN} {_SHOWN_SELECT}"


@check
def final_results_without_reports() -> str:
    names = ("no_comparisons", "findings", "category_findings", "questions")
    own = ", ".join(f"own_{n} AS (SELECT * REPLACE (({derived.own_id_sql(i).replace('STRING', 'VARCHAR')}) AS report_id) FROM {n})" for i, n in enumerate(names))
    ids = " UNION ".join(f"SELECT report_id FROM own_{n}" for n in names)
    shown, select = _SHOWN, _SHOWN_SELECT
    for n in names:
        shown, select = shown.replace(f"FROM {n} ", f"FROM own_{n} "), select.replace(f"JOIN {n} ", f"JOIN own_{n} ")
    renamed = select.replace("no_comparison_text, ''", "own_no_comparisons.no_comparison_text, ''")
    return f"WITH {STORED}, {own}, base AS (SELECT report_id, '' AS raw_text FROM ({ids})), {shown.replace('FROM questions GROUP', 'FROM own_questions GROUP')} {renamed}"


@check
def integrity_reports() -> str:
    return f"""WITH {TURNS} SELECT '' AS missing_columns, 0 AS n_empty_rows, count(*) - count(DISTINCT conv_id) AS n_duplicate_ids, 'rows' AS part FROM turns
    UNION ALL SELECT 'category', count(*) FILTER (WHERE conv_id % 5 = 0),
    count(*) - count(DISTINCT CASE WHEN conv_id % 5 <> 0 THEN conv_id ELSE -1 END), 'thin' FROM turns"""


@check
def all_stages_run() -> str:
    findings = f"""CASE WHEN extracted LIKE '%Solid renal mass%' THEN 'No such section'
        ELSE 'FINDINGS ' || (length(extracted) - length(replace(extracted, '.', ''))) END"""
    mapped = prompt(DEFAULT_TEMPLATES["map_category_findings"], findings="findings", category="category", description="description")
    plain = strip(prompt(DEFAULT_TEMPLATES["remove_comparison"], report="report_text").replace(text(DEFAULT_TEMPLATES["remove_comparison"].split("{report}")[0])[:-1], "'"))
    return f"""WITH {REPORTS}, {_catalog()},
    no_comparisons AS (SELECT report_id, 'Plain: ' || {plain} AS no_comparison_text FROM reports),
    findings AS (SELECT report_id, {findings} AS findings FROM
        (SELECT report_id, {prompt(DEFAULT_TEMPLATES["extract_findings"], report="no_comparison_text")} AS extracted FROM no_comparisons)
        WHERE extracted NOT LIKE '%Solid renal mass%'),
    category_findings AS (SELECT report_id, category, 'No relevant findings' AS findings FROM
        (SELECT report_id, category, {mapped} AS mapped FROM findings CROSS JOIN categories)
        WHERE NOT (mapped LIKE '%kidneys%' AND mapped LIKE '%1%')),
    questions AS (SELECT report_id, category, question_id, question, 'Yes' AS answer FROM reports CROSS JOIN asked
        WHERE NOT (question = 'Is there a fracture?' AND report_text LIKE '%No fracture%')),
    base AS (SELECT report_id, report_text AS raw_text FROM reports), {_SHOWN} {_SHOWN_SELECT}"""


@check
def stream_distinct() -> str:
    key = "CAST(conv_id AS VARCHAR) AS report_id, role || ' ' || turn AS category"
    return f"""WITH {TURNS} SELECT {key}, CASE WHEN conv_id % 3 <> 0 THEN content ELSE 'again ' || content END AS findings
    FROM turns WHERE conv_id % 3 <> 0 OR conv_id % 2 = 0"""


@check
def stream_batches() -> str:
    refused = "question = 'Is there a fracture?' AND report_text LIKE '%No fracture%'"
    return f"""WITH {REPORTS}, {_catalog()}, every AS (SELECT report_id, category, question_id, {refused} AS refused FROM reports CROSS JOIN asked)
    SELECT report_id, category, question_id, CASE WHEN refused THEN 'Unsure' ELSE 'Yes' END AS answer, 'stored' AS kind FROM every
    UNION ALL SELECT report_id, category, question_id, '', 'rejected' FROM every WHERE refused"""


@check
def stream_stage() -> str:
    return f"""WITH {REPORTS}, {_catalog()} SELECT report_id, category, question_id, question, 'Yes' AS answer FROM reports CROSS JOIN asked
    WHERE NOT (question = 'Is there a fracture?' AND report_text LIKE '%No fracture%')"""


# --- labels that came from a model ---------------------------------------------------------------


def _squeeze(column: str) -> str:
    return strip(f"regexp_replace({column}, '{BLANK}+', ' ', 'g')")


_IN_TEXT = f"q <> '' AND contains(squeezed, lower({_squeeze('q')}))"


def _enforced(source: str, concepts) -> str:
    """Checks on ``source``(report_id, concept, label, evidence) beside ``texts``(report_id, t)."""
    names = words(concepts)
    joined = "array_to_string(evidence, ' ')"
    cues = f"{has('said', fixed.CORONARY_WORD)} AND {has('said', fixed.CALCIFICATION_STEM)}"
    return f"""texts AS (SELECT report_id, t, lower({_squeeze('t')}) AS squeezed FROM eligible),
    fitting AS (SELECT s.*, t, [q FOR q IN evidence IF {_IN_TEXT}] AS fits FROM {source} s JOIN texts USING (report_id)),
    proven AS (SELECT report_id, concept, t, CASE WHEN label = 1 AND len(fits) = 0 THEN -1 ELSE label END AS label,
        CASE WHEN label = 1 THEN fits[1:3] ELSE evidence END AS evidence FROM fitting),
    spoken AS (SELECT *, coalesce(nullif({joined}, ''), t) AS said FROM proven),
    hearted AS (SELECT report_id, concept, CASE WHEN off THEN -1 ELSE label END AS label, CASE WHEN off THEN [] ELSE evidence END AS evidence
        FROM (SELECT *, concept = 'coronary_calcification' AND label = 1 AND NOT ({cues}) AS off FROM spoken)),
    renal AS (SELECT report_id, max({joined}) FILTER (WHERE concept = 'renal_cyst') AS cyst_said, max(label) FILTER (WHERE concept = 'renal_cyst') AS cyst_label,
        max({joined}) FILTER (WHERE concept = 'renal_hypodensities') AS hypo_said FROM hearted GROUP BY report_id),
    gated AS (SELECT *, cyst_like OR cyst_label = 1 AS is_cyst FROM (SELECT *,
        {has('cyst_said', fixed.CYST_STEM)} OR {has('hypo_said', fixed.LIKELY_CYST)} AS cyst_like FROM renal)),
    enforced AS (SELECT report_id, concept, CASE WHEN concept = 'renal_cyst' AND cyst_like THEN 1 WHEN taken THEN 0 ELSE label END AS label,
        CASE WHEN taken THEN [] ELSE evidence END AS evidence FROM (SELECT h.*, cyst_like,
            h.concept = 'renal_hypodensities' AND is_cyst AND {has('hypo_said', fixed.CYST_STEM)} AS taken
            FROM hearted h JOIN gated USING (report_id)) WHERE concept IN {names})"""


_SHOW_ENFORCED = f"""SELECT report_id, concept, CAST(label AS INTEGER) AS label,
    array_to_string(evidence, {text(fixed.EVIDENCE_SEPARATOR)}) AS evidence FROM enforced"""


@check
def quote_checks() -> str:
    rows = " UNION ALL ".join(
        f"SELECT report_id, '{name}' AS concept, {label} AS label, [{', '.join(quotes)}] AS evidence FROM reports"
        for name, (label, quotes) in queries.QUOTED_PARTS.items()
    )
    return f"WITH {ELIGIBLE}, given AS ({rows}), {_enforced('given', queries.QUOTED_PARTS)} {_SHOW_ENFORCED}"


@check
def response_labels() -> str:
    concepts = ", ".join(f"('{c}')" for c in fixed.CONCEPT_QUESTIONS)
    block = r"regexp_extract(content, '(?s)\{.*\}')"
    at = "json_extract_string(payload, '$.labels.' || concept)"
    number = f"CAST(trunc(TRY_CAST({at} AS DOUBLE)) AS BIGINT)"
    whole = f"CASE WHEN {number} BETWEEN -1 AND 1 THEN {number} ELSE 0 END"
    label = f"""CASE json_type(payload, '$.labels.' || concept) WHEN 'VARCHAR' THEN CASE WHEN regexp_full_match({at}, '[+-]?0*[01]') THEN {whole} ELSE 0 END
        WHEN 'BOOLEAN' THEN CASE {at} WHEN 'true' THEN 1 ELSE 0 END WHEN 'NULL' THEN 0 WHEN 'ARRAY' THEN 0 WHEN 'OBJECT' THEN 0 ELSE coalesce({whole}, 0) END"""
    evidence = f"""CASE json_type(payload, '$.evidence.' || concept) WHEN 'ARRAY' THEN [q FOR q IN CAST(json_extract(payload, '$.evidence.' || concept) AS VARCHAR[]) IF {strip('q')} <> '']
        WHEN 'VARCHAR' THEN [json_extract_string(payload, '$.evidence.' || concept)] ELSE [] END"""
    return f"""WITH {_labels()}, replies AS (SELECT report_id, {queries.LABEL_RESPONSE_SQL} AS content FROM reports),
    payloads AS (SELECT report_id, CASE WHEN json_valid({block}) AND {block} <> '{{}}' THEN {block} END AS payload FROM replies),
    given AS (SELECT report_id, concept, {label} AS label, {evidence} AS evidence FROM payloads CROSS JOIN (VALUES {concepts}) c(concept) WHERE payload IS NOT NULL),
    {_enforced('given', fixed.CONCEPT_QUESTIONS)} {_SHOW_ENFORCED}
    UNION ALL SELECT report_id, concept, label, evidence FROM labels WHERE report_id IN (SELECT report_id FROM payloads WHERE payload IS NULL)"""


# --- samples for review ----------------------------------------------------------------------------


def order_key(*columns: str) -> str:
    return f"md5(concat_ws(':', '42', {', '.join(columns)}))"


@check
def sampled_reports() -> str:
    return f"WITH {REPORTS} SELECT report_id, report_text FROM reports ORDER BY {order_key('report_id')} LIMIT 100"


@check
def sampled_catalog() -> str:
    return f"""WITH asked AS (SELECT DISTINCT 'topic ' || conv_id % 9 AS category, text AS question FROM conversations),
    chosen AS (SELECT category FROM (SELECT DISTINCT category FROM asked) ORDER BY {order_key('category')} LIMIT 4)
    SELECT category, question FROM asked WHERE category IN (SELECT category FROM chosen)
    QUALIFY row_number() OVER (PARTITION BY category ORDER BY {order_key('category', 'question')}) <= 10"""


_RESULTS = f"{STORED}, base AS (SELECT report_id, report_text AS raw_text FROM reports)"


@check
def qc_findings() -> str:
    return f"""WITH {_RESULTS} SELECT report_id AS query_id, raw_text, coalesce(no_comparison_text, '') AS no_comparison_text,
    coalesce(findings, '') AS findings, '' AS no_comparison_correct, '' AS findings_correct
    FROM base LEFT JOIN no_comparisons USING (report_id) LEFT JOIN findings USING (report_id)
    ORDER BY {order_key('report_id')} LIMIT 40"""


@check
def qc_categories() -> str:
    return f"""WITH {_RESULTS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY category, none ORDER BY {order_key('report_id', 'category')}) AS r,
        count(*) FILTER (WHERE NOT none) OVER (PARTITION BY category) AS relevant FROM
        (SELECT *, contains(findings, '{fixed.NO_RELEVANT_FINDINGS}') AS none FROM category_findings))
    SELECT report_id AS query_id, category, raw_text, ranked.findings AS category_finding, '' AS correct FROM ranked JOIN base USING (report_id)
    WHERE r <= CASE WHEN none THEN 10 - least(7, relevant) ELSE least(7, relevant) END"""


def _qc_word(column: str) -> str:
    word = cell(column)
    return f"CASE WHEN {word} IN {words(fixed.QC_YES)} THEN 1 WHEN {word} IN {words(fixed.QC_NO)} THEN 0 END"


def _draws() -> str:
    def pick(kind: str, size: str) -> str:
        return f"CAST('0x' || left({order_key(text(kind), 'draw')}, 8) AS BIGINT) % {size}"

    return f"""examples AS (SELECT *, row_number() OVER (PARTITION BY report_id, category ORDER BY question_id) - 1 AS ord, {_qc_word('answer')} AS label FROM questions),
    placed AS (SELECT *, row_number() OVER (PARTITION BY label, question ORDER BY {order_key('question', 'report_id', 'category', 'ord')}) - 1 AS place
        FROM examples WHERE label IS NOT NULL),
    topics AS (SELECT label, question, count(*) AS n, row_number() OVER (PARTITION BY label ORDER BY question) - 1 AS rank,
        count(*) OVER (PARTITION BY label) AS topics FROM placed GROUP BY label, question),
    draws AS (SELECT i AS draw, CASE WHEN i < 25 THEN 1 ELSE 0 END AS label FROM range(50) t(i)),
    targets AS (SELECT draw, d.label, t.question, {pick('example', 't.n')} AS place FROM draws d JOIN topics t
        ON t.label = d.label AND t.rank = {pick('question', 't.topics')}),
    sample AS (SELECT p.report_id AS query_id, p.question, raw_text, p.label AS predicted_label, '' AS human_label
        FROM targets JOIN placed p USING (label, question, place) JOIN base USING (report_id))"""


@check
def qc_questions() -> str:
    return f"WITH {_RESULTS}, {_draws()} SELECT * FROM sample"


@check
def qc_statistics() -> str:
    return f"""WITH {_RESULTS}, {_draws()}, per AS (SELECT question, bool_or(label = 1) AS pos, bool_or(label = 0) AS neg FROM placed GROUP BY question)
    SELECT * FROM (SELECT count(*) AS n_samples, count(*) FILTER (WHERE predicted_label = 1) AS n_positive,
        count(*) FILTER (WHERE predicted_label = 0) AS n_negative, count(DISTINCT question) AS n_unique_questions FROM sample)
    CROSS JOIN (SELECT count(*) AS n_questions, count(*) FILTER (WHERE pos) AS n_questions_with_positives,
        count(*) FILTER (WHERE neg) AS n_questions_with_negatives, count(*) FILTER (WHERE pos AND neg) AS n_questions_with_both FROM per)"""


# --- evaluation --------------------------------------------------------------------------------------


def yes_no(column: str) -> str:
    yes, no = has(column, r"\byes\b"), has(column, r"\bno\b")
    return f"CASE WHEN {has(column, fixed.UNCERTAIN_ANSWER)} THEN NULL WHEN {yes} AND NOT {no} THEN 1 WHEN {no} AND NOT {yes} THEN 0 END"


def annotation(column: str, numbers: bool) -> str:
    word = cell(column)
    if numbers:
        read = f"WHEN TRY_CAST({column} AS DOUBLE) > 0 THEN 1 ELSE 0"
    else:
        read = f"WHEN {word} IN {words(fixed.ANNOTATION_YES)} THEN 1 WHEN {word} IN {words(fixed.ANNOTATION_NO)} THEN 0"
    return f"CASE WHEN {column} IS NULL OR {column} IN {words(fixed.MISSING_CELLS)} THEN NULL {read} END"


@check
def answer_readings() -> str:
    notes = (*queries.NOTES, "2", "No - none seen", "Unsure, yes", "yesterday", " good ")
    return f"""WITH {TURNS}, notes AS (SELECT *, {mask('text')} AS ms, {hashed(notes, 'request_id')} AS note FROM turns)
    SELECT request_id, CAST({yes_no('note')} AS INTEGER) AS as_yes_no, CAST({yes_no('ms')} AS INTEGER) AS text_as_yes_no,
    CAST({_qc_word('note')} AS INTEGER) AS as_qc, CAST({annotation('note', False)} AS INTEGER) AS as_annotation,
    CAST({annotation('note', True)} AS INTEGER) AS as_number,
    replace(replace(replace(text, '?', ''), ' ', '_'), '/', '_') AS question_key FROM notes"""


SHEETS = f"""{TURNS},
    findings_sheet AS (SELECT {hashed(queries.NOTES, 'CAST(doc_id AS VARCHAR)')} AS no_comparison_correct,
        CASE WHEN doc_id % 4 <> 0 THEN CAST(quality + 2 * toxic AS VARCHAR) END AS findings_correct FROM labels),
    category_sheet AS (SELECT role || ' ' || turn AS category,
        CASE WHEN turn = 3 THEN 'maybe' ELSE {hashed(queries.NOTES, 'request_id')} END AS correct FROM turns),
    asked_turns AS (SELECT request_id, turn, role || ' asks / turn ' || turn || '?' AS question FROM turns),
    question_sheet AS (SELECT question, {hashed(('0', '1', '1'), 'request_id', 'question')} AS predicted_label,
        CASE WHEN turn = 2 THEN 'maybe' ELSE {hashed(queries.NOTES, 'request_id')} END AS human_label FROM asked_turns)"""


def _judged(task: str, column: str, source: str, numbers: bool, group: str = "") -> str:
    a = annotation(column, numbers)
    return f"SELECT {task} AS task, avg({a}) AS accuracy, count(*) AS n_samples, count({a}) AS n_annotated FROM {source} {group}"


def _correctness() -> str:
    return (
        _judged("'no_comparisons'", "no_comparison_correct", "findings_sheet", False)
        + " UNION ALL "
        + _judged("'findings'", "findings_correct", "findings_sheet", True)
    )


def _categories() -> str:
    return _judged("category", "correct", "category_sheet", False, "GROUP BY category")


def _question_metrics() -> str:
    nan = "CAST('nan' AS DOUBLE)"

    def share(part: str, whole: str, empty: str) -> str:
        return f"CASE WHEN tp + fp + tn + fn = 0 THEN {empty} WHEN {whole} > 0 THEN ({part}) / ({whole}) ELSE 0.0 END"

    return f"""question_pairs AS (SELECT question, {annotation('human_label', False)} AS gt, {annotation('predicted_label', True)} AS pred
        FROM question_sheet WHERE human_label NOT IN {words(fixed.MISSING_CELLS)}),
    question_counts AS (SELECT question, grouping(question) = 1 AS is_total, count(*) FILTER (WHERE gt = 1 AND pred = 1) AS tp,
        count(*) FILTER (WHERE gt = 0 AND pred = 1) AS fp, count(*) FILTER (WHERE gt = 0 AND pred = 0) AS tn,
        count(*) FILTER (WHERE gt = 1 AND pred = 0) AS fn, count(*) AS n_samples, count(DISTINCT question) AS n_unique_questions
        FROM question_pairs GROUP BY GROUPING SETS ((question), ())),
    question_ratios AS (SELECT *, {share('tp + tn', 'tp + fp + tn + fn', nan)} AS accuracy, {share('tp', 'tp + fp', nan)} AS precision,
        {share('tp', 'tp + fn', nan)} AS recall, {share('tn', 'tn + fp', 'NULL')} AS specificity, {share('tn', 'tn + fn', 'NULL')} AS npv FROM question_counts),
    question_metrics AS (SELECT *, CASE WHEN isnan(precision) THEN {nan} WHEN precision + recall > 0
        THEN 2 * (precision * recall) / (precision + recall) ELSE 0.0 END AS f1_score FROM question_ratios)"""


@check
def eval_correctness() -> str:
    return f"WITH {SHEETS} {_correctness()}"


@check
def eval_categories() -> str:
    return f"WITH {SHEETS} {_categories()}"


@check
def eval_questions() -> str:
    return f"""WITH {SHEETS}, {_question_metrics()} SELECT question, is_total, tp, fp, tn, fn, accuracy, precision, recall, f1_score,
    specificity, npv, n_samples, n_samples AS n_annotated, n_unique_questions FROM question_metrics"""


def _tasks() -> str:
    blank = ", ".join(f"CAST(NULL AS DOUBLE) AS {m}" for m in ("precision", "recall", "f1_score", "specificity", "npv"))

    def plain(qc_type: str, source: str) -> str:
        return f"""SELECT {qc_type} AS qc_type, task AS task_name, accuracy, CASE WHEN accuracy IS NULL THEN 0 ELSE n_samples END AS n_samples,
        CASE WHEN accuracy IS NULL THEN 0 ELSE n_annotated END AS n_annotated,
        CASE WHEN accuracy IS NULL THEN 'unknown' ELSE 'correctness_evaluation' END AS evaluation_type, '' AS question_text, {blank} FROM ({source})"""

    key = "replace(replace(replace(question, '?', ''), ' ', '_'), '/', '_')"
    return f"""{SHEETS}, {_question_metrics()}, tasks AS ({plain('task', _correctness())} UNION ALL {plain("'categories'", _categories())}
    UNION ALL SELECT CASE WHEN is_total THEN 'questions_consolidated' ELSE 'questions_individual' END,
        CASE WHEN is_total THEN 'All Questions Combined' ELSE {key} END, accuracy, n_samples, n_samples,
        CASE WHEN is_total THEN 'binary_classification_consolidated' ELSE 'binary_classification' END,
        CASE WHEN is_total THEN 'ALL_QUESTIONS_COMBINED' ELSE question END, precision, recall, f1_score, specificity, npv FROM question_metrics),
    zeroed AS (SELECT * REPLACE (coalesce(accuracy, 0.0) AS accuracy) FROM tasks)"""


@check
def imperfect_tasks() -> str:
    return f"WITH {_tasks()} SELECT *, round_even(accuracy * 100, 1) AS accuracy_percent FROM zeroed WHERE accuracy < 0.6 ORDER BY accuracy"


@check
def imperfect_by_type() -> str:
    return f"WITH {_tasks()} SELECT qc_type, count(*) AS n FROM zeroed WHERE accuracy < 1.0 GROUP BY qc_type"


TRUTH = """truth AS (SELECT CASE WHEN doc_id % 8 = 7 THEN 'gone ' ELSE '' END || doc_id AS case_id, CAST(quality AS VARCHAR) AS fracture,
        CASE WHEN doc_id % 6 = 5 THEN 'unknown' ELSE CAST(toxic AS VARCHAR) END AS renal_cyst,
        CASE WHEN doc_id % 4 = 3 THEN '-1' ELSE CAST(1 - quality AS VARCHAR) END AS pleural_effusion,
        CASE WHEN doc_id % 5 = 0 THEN '1.0' WHEN doc_id % 5 = 1 THEN '0' END AS osteopenia, '2' AS ascites FROM main.labels),
    truth_long AS (SELECT case_id, unnest(['fracture', 'renal_cyst', 'pleural_effusion', 'osteopenia', 'ascites']) AS concept,
        unnest([fracture, renal_cyst, pleural_effusion, osteopenia, ascites]) AS label FROM truth),
    truth_read AS (SELECT case_id, concept, CASE TRY_CAST(label AS DOUBLE) WHEN 1 THEN 1 WHEN 0 THEN 0 END AS gt FROM truth_long)"""


@check
def labels_unpivoted() -> str:
    return f"WITH {TRUTH.replace('main.labels', 'labels')} SELECT case_id, concept, label FROM truth_long"


def _answered() -> str:
    asked = ", ".join(f"('{c}', {text(fixed.CONCEPT_QUESTIONS[c])})" for c in queries.TRUTH)
    return f"""{STORED}, {TRUTH.replace('main.labels', 'labels')}, mapping(concept, question) AS (VALUES {asked}),
    last_answers AS (SELECT report_id, question, arg_max(answer, category) AS answer FROM questions GROUP BY report_id, question),
    pairs AS (SELECT t.case_id, t.concept, t.gt, {yes_no('a.answer')} AS pred FROM truth_read t JOIN mapping USING (concept)
        JOIN (SELECT report_id FROM reports) r ON r.report_id = t.case_id
        LEFT JOIN last_answers a ON a.report_id = t.case_id AND a.question = mapping.question)"""


_COUNTS = """count(*) FILTER (WHERE gt = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE gt = 0 AND pred = 1) AS fp,
    count(*) FILTER (WHERE gt = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE gt = 1 AND pred = 0) AS fn"""


def _ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN ({part}) / ({whole}) ELSE CAST('nan' AS DOUBLE) END"


def _coverage() -> str:
    f1 = "2 * precision_ppv * recall_sensitivity"
    return f"""counted AS (SELECT concept AS disease, count(gt) AS n_labeled, count(*) FILTER (WHERE gt IS NOT NULL AND pred IS NOT NULL) AS n_predicted_yesno,
        {_COUNTS} FROM pairs GROUP BY concept),
    ratios AS (SELECT *, n_labeled - n_predicted_yesno AS n_no_pred, {_ratio('n_predicted_yesno', 'n_labeled')} AS coverage,
        {_ratio('tp + tn', 'n_labeled')} AS accuracy, {_ratio('tp', 'tp + fp')} AS precision_ppv, {_ratio('tp', 'tp + fn')} AS recall_sensitivity FROM counted),
    coverage AS (SELECT *, CASE WHEN isnan(precision_ppv) OR isnan(recall_sensitivity) THEN CAST('nan' AS DOUBLE)
        ELSE {_ratio(f1, 'precision_ppv + recall_sensitivity')} END AS f1 FROM ratios)"""


@check
def coverage_metrics() -> str:
    return f"WITH {_answered()}, {_coverage()} SELECT * FROM coverage ORDER BY f1, n_labeled DESC, disease"


@check
def coverage_overall() -> str:
    return f"""WITH {_answered()}, {_coverage()}, totals AS (SELECT CAST(sum(n_labeled) AS BIGINT) AS total_labeled,
        CAST(sum(n_predicted_yesno) AS BIGINT) AS total_predicted_yesno, sum(tp + tn) AS n_correct FROM coverage)
    SELECT total_labeled, total_predicted_yesno, total_predicted_yesno / total_labeled AS coverage, n_correct / total_labeled AS accuracy,
    (SELECT count(DISTINCT case_id) FROM pairs WHERE gt IS NOT NULL) AS cases_with_predictions FROM totals"""


@check
def case_accuracy() -> str:
    return f"""WITH {_answered()} SELECT case_id, CAST(count(gt) AS INTEGER) AS n_labeled, CAST(count(*) FILTER (WHERE gt = pred) AS INTEGER) AS n_correct,
    count(*) FILTER (WHERE gt = pred) / count(gt) AS accuracy FROM pairs GROUP BY case_id HAVING count(gt) > 0"""


def _predicted() -> str:
    truth = TRUTH.replace("main.labels", "ground")
    # The label CTE is called labels too, so the given table is read before it.
    body = _labels().replace("labels AS MATERIALIZED", "concept_labels AS MATERIALIZED")
    return f"""ground AS (SELECT * FROM labels), {truth}, {body},
    pairs AS (SELECT t.case_id, t.concept, t.gt, CASE WHEN l.label IN (0, 1) THEN l.label END AS pred FROM truth_read t
        JOIN concept_labels l ON l.report_id = t.case_id AND l.concept = t.concept),
    evaluable AS (SELECT *, {_ratio('tp', 'tp + fp')} AS precision_ppv, {_ratio('tp', 'tp + fn')} AS recall_sensitivity,
        {_ratio('2 * tp', '2 * tp + fp + fn')} AS f1, {_ratio('tp + tn', 'tp + tn + fp + fn')} AS accuracy FROM
        (SELECT concept AS disease, count(*) AS n_eval, {_COUNTS} FROM pairs WHERE gt IS NOT NULL AND pred IS NOT NULL GROUP BY concept))"""


@check
def evaluable_metrics() -> str:
    return f"WITH {_predicted()} SELECT * FROM evaluable ORDER BY f1, n_eval DESC, disease"


@check
def evaluable_overall() -> str:
    sums = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("tp", "fp", "tn", "fn"))
    return f"""WITH {_predicted()}, totals AS (SELECT CAST(sum(n_eval) AS BIGINT) AS total_eval, {sums} FROM evaluable)
    SELECT *, {_ratio('tp', 'tp + fp')} AS precision_ppv, {_ratio('tp', 'tp + fn')} AS recall_sensitivity, {_ratio('2 * tp', '2 * tp + fp + fn')} AS f1,
    {_ratio('tp + tn', 'tp + tn + fp + fn')} AS accuracy, (SELECT count(DISTINCT case_id) FROM pairs) AS matched_cases FROM totals"""


@check
def catalog_drift() -> str:
    return """WITH said AS (SELECT role || ' ' || conv_id AS concept, conv_id, text FROM conversations),
    asked AS (SELECT CASE WHEN conv_id % 5 = 0 THEN 'new: ' ELSE '' END || text AS question FROM said),
    mapped AS (SELECT CASE WHEN conv_id % 7 = 0 THEN 'old ' ELSE '' END || concept AS concept, text AS question FROM said),
    labelled AS (SELECT CASE WHEN conv_id % 11 = 0 THEN 'extra ' ELSE '' END || concept AS concept FROM said)
    SELECT 'question not in catalog' AS kind, question AS name FROM (SELECT question FROM mapped EXCEPT SELECT question FROM asked)
    UNION ALL SELECT 'question not mapped', question FROM (SELECT question FROM asked EXCEPT SELECT question FROM mapped)
    UNION ALL SELECT 'concept not mapped', concept FROM (SELECT concept FROM labelled EXCEPT SELECT concept FROM mapped)
    UNION ALL SELECT 'concept without labels', concept FROM (SELECT concept FROM mapped EXCEPT SELECT concept FROM labelled)"""


@check
def qc_typed_answers() -> str:
    labels = {"2": 1, "0.0": 0, "-3": 0, "0": 0, "1e-3": 1, "true": 1, "false": 0, '"yes"': 1, '" No "': 0, '"0"': 0}
    first = " ".join(f"WHEN {i} THEN {labels[v]}" for i, v in enumerate(queries.TYPED_VALUES) if v in labels)
    number = "CAST(report_id AS BIGINT)"
    return f"""WITH {REPORTS}, every AS (SELECT report_id, 'A' AS category, 0 AS ord, 'first' AS question, CASE {number} % 15 {first} END AS label FROM reports
    UNION ALL SELECT report_id, 'A', 1, 'second', CASE {number} % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END FROM reports
    UNION ALL SELECT report_id, 'B', 0, 'first', CASE {number} % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END FROM reports)
    SELECT * FROM every WHERE label IS NOT NULL"""


# --- sources -----------------------------------------------------------------------------------------


@check
def reports_last_wins() -> str:
    return f"""WITH {REPORTS}, files AS (SELECT 0 AS ord, report_id, report_text FROM reports
        UNION ALL SELECT 1, report_id, 'newer ' || report_text FROM reports WHERE CAST(report_id AS BIGINT) % 3 = 0
        UNION ALL SELECT 2, CAST(item_id AS VARCHAR), text FROM benchmark)
    SELECT report_id, report_text FROM files QUALIFY row_number() OVER (PARTITION BY report_id ORDER BY ord DESC) = 1"""


@check
def json_reports() -> str:
    layout = "CAST(report_id AS BIGINT) % 6"
    return f"""WITH {REPORTS} SELECT report_id AS path, 0 AS pos, report_id, CASE {layout} WHEN 5 THEN '' ELSE report_text END AS report_text
        FROM reports WHERE {layout} <> 4
    UNION ALL SELECT report_id, 1, 'y' || report_id, 'second' FROM reports WHERE {layout} = 0
    UNION ALL SELECT report_id, 1, 'b' || report_id, 'other' FROM reports WHERE {layout} = 1"""


@check
def results_documents() -> str:
    kind = "CAST(report_id AS BIGINT) % 3"
    return f"""WITH {REPORTS} SELECT report_id, CASE WHEN {kind} > 0 THEN report_text END AS raw_text, CASE {kind} WHEN 1 THEN 'b' || report_id END AS bones,
    CASE {kind} WHEN 1 THEN 1 WHEN 2 THEN 2 END AS n_categories, CASE {kind} WHEN 0 THEN 'failed' END AS error FROM reports
    UNION ALL SELECT 'z' || report_id, 'z', NULL, NULL, NULL FROM reports WHERE {kind} = 2"""
