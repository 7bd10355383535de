"""Check SQL of the queries that go through files."""

from __future__ import annotations

from ..functions import fixed_values as fixed
from . import checks, derived, file_queries
from .checks import check, text


@check
def csv_and_json_reports() -> str:
    return f"""WITH {checks.REPORTS} SELECT report_id, CASE WHEN CAST(report_id AS BIGINT) % 3 = 0 THEN 'newer ' || report_text ELSE report_text END AS report_text FROM reports"""


@check
def stage_files() -> str:
    return f"""WITH {checks.STORED} SELECT 'findings' AS part, report_id, findings AS value FROM findings
    UNION ALL SELECT 'category_findings', report_id, findings FROM category_findings
    UNION ALL SELECT 'no_comparisons', report_id, no_comparison_text FROM no_comparisons"""


@check
def catalog_file_requests() -> str:
    return f"SELECT report_id, category, question_id, question, request_id FROM ({checks.requests_questions()})"


@check
def response_files() -> str:
    again = """repeated AS (SELECT * FROM lines UNION ALL SELECT replace(value, '"content": "', '"content": "Again: '),
        ord + 1000000000000 FROM lines WHERE ord % 3 > 0)"""
    return f"WITH {checks.LINES}, {again}, {checks._read_lines('repeated')} SELECT request_id, content FROM answers"


@check
def results_file() -> str:
    shown = ", ".join(f"CASE WHEN failed THEN '' ELSE {c} END AS {c}" for c in ("raw_text", "no_comparison_text", "findings_text", "categories", "answers"))
    return f"""SELECT report_id, {shown}, CASE WHEN failed THEN 'failed' END AS error, 0.0::DOUBLE AS processing_time
    FROM (SELECT *, CAST(report_id AS BIGINT) % 10 = 0 AS failed FROM ({checks.final_results()}))"""


@check
def wide_label_file() -> str:
    return checks._with_labels(f"SELECT COLUMNS(*)::VARCHAR FROM ({checks._wide()})")


@check
def nested_label_file() -> str:
    return checks.concept_labels()


@check
def label_lines_file() -> str:
    return checks._with_labels(
        """SELECT l.report_id, concept, label, evidence, '{"n": ' || length(report_text) || '}' AS raw_payload
        FROM labels l JOIN reports r ON r.report_id = l.report_id WHERE concept IN ('fracture', 'ascites')"""
    )


@check
def label_file_metrics() -> str:
    return f"""WITH {checks._predicted()} SELECT disease, n_eval, f1, CAST(row_number() OVER (ORDER BY f1, n_eval DESC, disease) AS INTEGER) AS pos FROM evaluable"""


@check
def case_file() -> str:
    return checks.case_accuracy()


def _mixed(*columns: str) -> str:
    return f"md5(concat_ws(':', '42', 'mix', {', '.join(columns)})), {', '.join(columns)}"


@check
def review_files() -> str:
    parts = {
        "combined_findings": (checks.qc_findings(), "''", ("query_id",)),
        "categories": (checks.qc_categories(), "category", ("query_id", "category")),
        "questions": (checks.qc_questions(), "question", ("query_id", "question")),
    }
    shown = [
        f"""SELECT '{name}' AS sheet, CAST(row_number() OVER (ORDER BY {_mixed(*keys)}) AS INTEGER) AS pos, query_id, {key} AS key,
        CAST(length(raw_text) AS INTEGER) AS raw_chars FROM ({sql})"""
        for name, (sql, key, keys) in parts.items()
    ]
    return " UNION ALL ".join(shown)


@check
def task_files() -> str:
    return f"""WITH {checks._tasks()} SELECT 'imperfect' AS part, qc_type, task_name, accuracy, n_annotated, TRUE AS in_order FROM zeroed WHERE accuracy < 0.6
    UNION ALL SELECT 'all', qc_type, task_name, accuracy, n_annotated, TRUE FROM tasks"""


@check
def own_concepts() -> str:
    rows = " UNION ALL ".join(row for rule in file_queries.OWN_RULES for row in checks._rule_rows(rule))
    names = ", ".join(f"('{r.name}')" for r in file_queries.OWN_RULES)
    return f"""WITH {checks.SENTENCES}, kinds AS MATERIALIZED (SELECT DISTINCT * FROM ({rows})),
    resolved AS (SELECT report_id, concept, CASE WHEN bool_or(kind = 'P') THEN 1
        WHEN bool_or(kind = 'U') AND NOT bool_or(kind = 'A') THEN -1 ELSE 0 END AS label FROM kinds GROUP BY report_id, concept),
    firsts AS (SELECT k.report_id, k.concept, min(idx) AS idx, arg_min(sent, idx) AS sent FROM kinds k JOIN resolved r
        ON k.report_id = r.report_id AND k.concept = r.concept AND k.kind = CASE r.label WHEN 1 THEN 'P' WHEN -1 THEN 'U' ELSE 'A' END
        GROUP BY k.report_id, k.concept, lower(sent)),
    quoted AS (SELECT report_id, concept, string_agg(sent, {text(fixed.EVIDENCE_SEPARATOR)} ORDER BY idx) AS evidence FROM
        (SELECT * FROM firsts QUALIFY row_number() OVER (PARTITION BY report_id, concept ORDER BY idx) <= 3) GROUP BY report_id, concept)
    SELECT r.report_id, c.concept, CAST(coalesce(x.label, 0) AS INTEGER) AS label, coalesce(q.evidence, '') AS evidence
    FROM reports r CROSS JOIN (VALUES {names}) c(concept)
    LEFT JOIN resolved x ON x.report_id = r.report_id AND x.concept = c.concept
    LEFT JOIN quoted q ON q.report_id = r.report_id AND q.concept = c.concept"""
