"""Registered queries: each operator over the whole given tables.

Lists and maps are shown as joined text, so a row compares as plain values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.answers import annotation, question_key, qc_answer, yes_no
from ..functions.completions import completion_or_reasoning, completion_text
from ..functions.fixed_values import CONCEPT_QUESTIONS, EVIDENCE_SEPARATOR
from ..functions.text import eligible_text, sentences
from ..operators import combine, enforce, labels, metrics, requests, responses, sampling
from ..operators.lexicon import default_lexicon
from ..session import partitions, shared_folder, spread
from ..sources.reports import last_wins, parse_json_reports
from ..sources.store import StageStore
from ..sources.tables import parse_results_documents, parse_typed_answers
from ..streaming import incremental
from . import derived
from .completion import complete
from .stages import retry_stage, run_stages

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    from . import file_queries  # noqa: F401 - registers its queries

    return dict(_QUERIES)


def _joined(column: str = "evidence") -> Column:
    return F.array_join(column, EVIDENCE_SEPARATOR).alias(column)


# --- text and labels -----------------------------------------------------------------


@query
def report_regions(spark, sf_dir):
    """The text that may support a label, for whole reports and for direct rule calls."""
    return derived.reports(spark, sf_dir).select(
        "report_id",
        eligible_text(F.col("report_text")).alias("eligible"),
        eligible_text(F.col("report_text"), "direct").alias("eligible_direct"),
    )


@query
def report_sentences(spark, sf_dir):
    text = eligible_text(F.col("report_text"))
    return derived.reports(spark, sf_dir).select("report_id", F.posexplode(sentences(text)).alias("idx", "sent"))


@query
def concept_mentions(spark, sf_dir):
    return labels.mentions(derived.reports(spark, sf_dir))


@query
def concept_labels(spark, sf_dir):
    return labels.label_concepts(derived.reports(spark, sf_dir)).select("report_id", "concept", "label", _joined())


@query
def concept_labels_wide(spark, sf_dir):
    return labels.to_wide(labels.label_results(derived.reports(spark, sf_dir)), labels.names_of(None))


@query
def concept_labels_pivoted(spark, sf_dir):
    """The long table put back to one row per report."""
    long = labels.label_concepts(derived.reports(spark, sf_dir))
    return labels.pivot_labels(long, labels.names_of(None))


@query
def concept_labels_nested(spark, sf_dir):
    """Label and evidence maps, shown entry by entry."""
    nested = labels.to_nested(labels.label_results(derived.reports(spark, sf_dir)), labels.names_of(None))
    shown = nested.select("report_id", "evidence", F.explode("labels").alias("concept", "label"))
    return shown.select(
        "report_id", "concept", "label", F.array_join(F.try_element_at("evidence", "concept"), EVIDENCE_SEPARATOR).alias("evidence")
    )


@query
def concept_counts(spark, sf_dir):
    return labels.label_concepts(derived.reports(spark, sf_dir)).groupBy("concept", "label").agg(
        F.count(F.lit(1)).alias("n")
    )


def _rules(*names: str) -> tuple[labels.Rule, ...]:
    """The rules of some concepts, and of those whose labels bear on them."""
    wanted = {*names, *({"renal_cyst", "renal_hypodensities"} if {"renal_cyst", "renal_hypodensities"} & set(names) else ())}
    return tuple(r for r in default_lexicon() if r.name in wanted)


def _labels_of(spark, sf_dir, *names: str) -> DataFrame:
    found = labels.label_concepts(derived.reports(spark, sf_dir), _rules(*names))
    return found.filter(F.col("concept").isin(*names)).select("report_id", "concept", "label", _joined())


@query
def renal_gates(spark, sf_dir):
    return _labels_of(spark, sf_dir, "renal_cyst", "renal_hypodensities")


@query
def hydronephrosis_special(spark, sf_dir):
    return _labels_of(spark, sf_dir, "hydronephrosis")


# --- prompts and requests --------------------------------------------------------------


@query
def requests_simple(spark, sf_dir):
    """Prompts of both stages that ask once per report."""
    reports = derived.reports(spark, sf_dir)
    first = requests.build_requests("no_comparisons", reports).withColumn("stage", F.lit("no_comparisons"))
    second = requests.build_requests("findings", derived.no_comparisons(reports)).withColumn("stage", F.lit("findings"))
    return first.unionByName(second)


@query
def requests_categories(spark, sf_dir):
    findings = derived.findings(derived.reports(spark, sf_dir))
    return requests.build_requests("category_findings", findings, derived.catalog())


@query
def requests_questions(spark, sf_dir):
    return requests.build_requests("questions", derived.reports(spark, sf_dir), derived.catalog())


@query
def requests_resumed(spark, sf_dir):
    """Only the questions that have no valid stored answer yet."""
    reports = derived.reports(spark, sf_dir)
    done = derived.stage_tables(reports)["questions"].filter(F.col("answer") != "true")
    todo = requests.build_requests("questions", reports, derived.catalog(), done)
    return todo.select("report_id", "category", "question_id", "request_id")


@query
def label_prompts(spark, sf_dir):
    return requests.label_requests(derived.reports(spark, sf_dir))


# --- responses -------------------------------------------------------------------------


def _lines(spark, sf_dir):
    return derived.turns(spark, sf_dir).selectExpr(
        f"{derived.LINE_SQL} AS value", "conv_id * 1000 + turn AS ord"
    )


@query
def response_lines(spark, sf_dir):
    """Answers read from a batch response file."""
    return responses.parse_response_lines(_lines(spark, sf_dir), "ord")


@query
def response_last_line(spark, sf_dir):
    """Repeated ids in a response file: the last line counts."""
    lines = _lines(spark, sf_dir)
    again = lines.select(F.replace("value", F.lit('"content": "'), F.lit('"content": "Again: ')).alias("value"), F.expr("ord + 1000000000 * (ord % 3)").alias("ord"))
    return responses.parse_response_lines(lines.unionByName(again.filter("ord >= 1000000000")), "ord")


@query
def chat_bodies(spark, sf_dir):
    """Answers read from chat bodies, with and without the reasoning fallback."""
    bodies = derived.turns(spark, sf_dir).selectExpr("request_id", f"parse_json({derived.BODY_SQL}) AS body")
    return bodies.select(
        "request_id",
        completion_text(F.col("body")).alias("content"),
        completion_or_reasoning(F.col("body")).alias("content_or_reasoning"),
    )


def _answered(spark, sf_dir):
    return derived.turns(spark, sf_dir).select("request_id", "content")


@query
def responses_valid(spark, sf_dir):
    """Which stages would keep a response."""
    answered = _answered(spark, sf_dir)
    kept = [
        responses.valid_results(answered, stage).select(F.lit(stage).alias("stage"), "request_id", "content")
        for stage in ("no_comparisons", "findings", "category_findings", "questions")
    ]
    return kept[0].unionByName(kept[1]).unionByName(kept[2]).unionByName(kept[3])


@query
def rejected_patterns(spark, sf_dir):
    answered = _answered(spark, sf_dir)
    parts = [
        responses.invalid_patterns(answered, stage).withColumn("stage", F.lit(stage))
        for stage in ("findings", "category_findings")
    ]
    return parts[0].unionByName(parts[1])


@query
def response_patterns(spark, sf_dir):
    return responses.response_patterns(_answered(spark, sf_dir))


@query
def response_counts(spark, sf_dir):
    return responses.empty_counts(_answered(spark, sf_dir))


@query
def response_samples(spark, sf_dir):
    """A few responses and a few empty ones, for a look."""
    answered = _answered(spark, sf_dir)
    return responses.first_samples(answered, 5).withColumn("kind", F.lit("any")).unionByName(
        responses.first_samples(answered, 3, only_empty=True).withColumn("kind", F.lit("empty"))
    )


@query
def rejected_samples(spark, sf_dir):
    """The first ten responses that each checking stage rejects."""
    answered = _answered(spark, sf_dir)
    parts = [
        responses.first_samples(answered, 10, rejected_by=stage).withColumn("stage", F.lit(stage))
        for stage in ("findings", "category_findings")
    ]
    return parts[0].unionByName(parts[1])


def _asked_and_answered(spark, sf_dir):
    turns = derived.turns(spark, sf_dir)
    return turns.select("request_id"), turns.filter("(conv_id + turn) % 4 <> 1").select("request_id", "content")


@query
def missing_results(spark, sf_dir):
    return responses.missing_requests(*_asked_and_answered(spark, sf_dir))


@query
def filled_results(spark, sf_dir):
    return responses.fill_missing(*_asked_and_answered(spark, sf_dir))


@query
def matched_results(spark, sf_dir):
    """Requests of a stage with the responses that came back, as stage rows."""
    reports = derived.reports(spark, sf_dir)
    asked = requests.build_requests("category_findings", derived.findings(reports), derived.catalog())
    answered = derived.category_answers(reports)
    return responses.to_stage_rows(responses.match_responses(asked, answered, ["report_id", "category"]), "category_findings")


@query
def udf_answers(spark, sf_dir):
    """A user function answering every prompt."""
    asked = requests.build_requests("no_comparisons", derived.reports(spark, sf_dir))
    return complete(asked, word_counter()).select("report_id", "request_id", "content")


def word_counter() -> Callable[[Sequence[str]], list[str]]:
    """Made here, so that it travels to the executors with the query."""

    def answer(prompts: Sequence[str]) -> list[str]:
        return [str(prompt.count(" ")) for prompt in prompts]

    return answer


# --- stage tables and final results ------------------------------------------------------


def _run_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/scanledger/{name}-{uuid4().hex}"


def _stored_turns(spark, sf_dir):
    return derived.turns(spark, sf_dir).selectExpr(
        "CAST(conv_id AS STRING) AS report_id", "role || ' ' || turn % 3 AS category", "content AS findings"
    )


@query
def stage_append(spark, sf_dir):
    """Two overlapping appends: stored keys stay, new keys come once."""
    rows = _stored_turns(spark, sf_dir)
    store = StageStore(_run_folder(spark, "append"))
    store.append("category_findings", rows.filter("CAST(report_id AS BIGINT) % 3 <> 0"))
    again = rows.withColumn("findings", F.concat(F.lit("again "), "findings"))
    store.append("category_findings", again)
    return store.load(spark, "category_findings")


@query
def nest_flatten(spark, sf_dir):
    """Category rows and answers nested per report and flattened again."""
    tables = derived.stage_tables(derived.reports(spark, sf_dir))
    categories = combine.flatten_categories(combine.nest_categories(tables["category_findings"]))
    answers = combine.flatten_questions(combine.nest_questions(tables["questions"]))
    return categories.selectExpr("report_id", "category", "-1 AS ord", "'' AS question", "findings AS value").unionByName(
        answers.selectExpr("report_id", "category", "ord", "question", "answer AS value")
    )


@query
def valid_category_maps(spark, sf_dir):
    """Category maps without failed entries, reports without any left out."""
    answers = derived.category_answers(derived.reports(spark, sf_dir))
    nested = combine.nest_categories(answers.withColumnRenamed("content", "findings"))
    return combine.flatten_categories(responses.valid_category_map(nested))


def _shown(results: DataFrame, *extra: str) -> DataFrame:
    categories = F.transform(
        F.array_sort(F.map_entries("category_findings")), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    answers = F.transform(
        F.array_sort(F.map_keys("qa_results")),
        lambda c: F.concat(
            c,
            F.lit(":"),
            F.array_join(
                F.transform(
                    F.try_element_at(F.col("qa_results"), c),
                    lambda qa: F.concat(F.get(F.map_keys(qa), F.lit(0)), F.lit("="), F.get(F.map_values(qa), F.lit(0))),
                ),
                ";",
            ),
        ),
    )
    return results.select(
        "report_id", "raw_text", "no_comparison_text", "findings_text",
        F.array_join(categories, "|").alias("categories"), F.array_join(answers, "|").alias("answers"), *extra,
    )


@query
def final_results(spark, sf_dir):
    return _shown(derived.results(spark, sf_dir))


@query
def final_results_without_reports(spark, sf_dir):
    """Stage tables that hold ids no other has: the reports are the union of all ids."""
    tables = derived.stage_tables(derived.reports(spark, sf_dir))
    for place, (name, table) in enumerate(tables.items()):
        tables[name] = table.withColumn("report_id", F.expr(derived.own_id_sql(place)))
    return _shown(combine.combine_stages(None, **tables))


@query
def integrity_reports(spark, sf_dir):
    """Missing columns, empty rows and repeated ids of two tables."""
    turns = derived.turns(spark, sf_dir)
    thin = turns.selectExpr(
        "CASE WHEN conv_id % 5 <> 0 THEN CAST(conv_id AS STRING) END AS report_id",
        "CASE WHEN conv_id % 5 <> 0 THEN content END AS findings",
    )
    parts = [("rows", _stored_turns(spark, sf_dir)), ("thin", thin)]
    reports = [
        responses.integrity_report(df, ("report_id", "category", "findings")).withColumn("part", F.lit(name))
        for name, df in parts
    ]
    return reports[0].unionByName(reports[1])


@query
def all_stages_run(spark, sf_dir):
    """All four stages over every report with a function that answers from the prompt."""
    store = StageStore(_run_folder(spark, "stages"))
    done = run_stages(spark, ["all"], store, echo_stage(), derived.reports(spark, sf_dir), derived.catalog())
    return _shown(done)


def echo_stage() -> Callable[[Sequence[str]], list[str]]:
    """Stands in for a model: tells the stages apart by their prompts."""

    def one(prompt: str) -> str:
        if prompt.startswith("The following report"):
            return "Plain: " + prompt.split("\n\n", 1)[1].strip()
        if prompt.startswith("This is a radiology report"):
            return "No such section" if "Solid renal mass" in prompt else "FINDINGS " + str(prompt.count("."))
        if prompt.startswith("Given the following findings"):
            return "error" if "kidneys" in prompt and "1" in prompt else "No relevant findings"
        return "" if "Is there a fracture?" in prompt and "No fracture" in prompt else "Yes"

    return lambda prompts: [one(prompt) for prompt in prompts]


# --- labels that came from a model --------------------------------------------------------

PAYLOAD_CONCEPTS = ("fracture", "renal_cyst", "renal_hypodensities", "coronary_calcification", "splenomegaly", "ascites")


def _label_responses(spark, sf_dir):
    """Reports joined with the replies that came back for them."""
    reports = derived.reports(spark, sf_dir)
    replies = reports.selectExpr("report_id", f"{LABEL_RESPONSE_SQL} AS content")
    return responses.match_responses(reports, replies, ["report_id"])


# A model's reply per report: labels of several JSON kinds, quotes that fit or do not,
# prose around the JSON, and replies without usable JSON.
LABEL_RESPONSE_SQL = (
    "CASE CAST(report_id AS BIGINT) % 7 WHEN 0 THEN 'no json here' WHEN 1 THEN 'empty {}' WHEN 2 THEN '{bad' ELSE "
    "'Here you are: {\"labels\": {' || '\"fracture\": ' || CASE CAST(report_id AS BIGINT) % 5 WHEN 0 THEN '1' WHEN 1 THEN '\"1\"' "
    "WHEN 2 THEN '\"1.0\"' WHEN 3 THEN '1.9' ELSE 'true' END || ', \"renal_cyst\": ' || CASE CAST(report_id AS BIGINT) % 3 WHEN 0 THEN '0' "
    "WHEN 1 THEN '1' ELSE '-1' END || ', \"renal_hypodensities\": 1, \"coronary_calcification\": ' || "
    "CASE CAST(report_id AS BIGINT) % 2 WHEN 0 THEN '1' ELSE '[1]' END || ', \"splenomegaly\": ' || "
    "CASE CAST(report_id AS BIGINT) % 4 WHEN 0 THEN 'null' WHEN 1 THEN '2' WHEN 2 THEN '-1.5' ELSE '1' END || "
    "', \"ascites\": 1}, \"evidence\": {' || "
    "'\"fracture\": [\"Rib   FRACTURE\", \"\", \"no fracture.\"], \"renal_cyst\": [\"' || "
    "CASE CAST(report_id AS BIGINT) % 6 WHEN 0 THEN 'Simple renal cyst' WHEN 1 THEN 'consistent with cysts' WHEN 2 THEN 'a cyst' ELSE 'kidney' END || "
    "'\"], \"renal_hypodensities\": [\"' || CASE CAST(report_id AS BIGINT) % 6 WHEN 2 THEN 'Renal hypodensities, likely cysts' "
    "WHEN 4 THEN 'solid renal mass' ELSE 'lesion' END || '\"], \"coronary_calcification\": [\"' || "
    "CASE CAST(report_id AS BIGINT) % 5 WHEN 0 THEN 'Coronary calcification is' WHEN 1 THEN 'calcifications are likely' ELSE 'Coronary' END || "
    "'\"], \"splenomegaly\": \"Splenomegaly\", \"ascites\": 5}} Done.' END"
)


def _results_shown(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return labels.to_long(df, names).select("report_id", "concept", "label", _joined())


@query
def response_labels(spark, sf_dir):
    """Labels read from replies, checked against the report, rules where a reply is unusable."""
    return _results_shown(enforce.parse_label_responses(_label_responses(spark, sf_dir)), labels.names_of(None))


@query
def quote_checks(spark, sf_dir):
    """The checks alone, on labels that are given as columns."""
    reports = derived.reports(spark, sf_dir)
    given = reports.withColumns({name: F.expr(sql) for name, sql in QUOTED_SQL.items()})
    return _results_shown(enforce.enforce_labels(given, "report_text", tuple(QUOTED_SQL)), tuple(QUOTED_SQL))


def _quoted_sql(label: str, *quotes: str) -> str:
    listed = ", ".join(quotes)
    return f"named_struct('label', CAST({label} AS INT), 'evidence', array({listed}))"


_ID = "CAST(report_id AS BIGINT)"
QUOTED_PARTS = {
    "fracture": ("1", ("'rib  fracture'", "'hip fracture'", "'FRACTURE'", "'no'", "'.'", "substring(report_text, 1, 9)")),
    "coronary_calcification": (f"{_ID} % 3 - 1", (f"CASE {_ID} % 2 WHEN 0 THEN 'coronary' ELSE 'Coronary calcification' END",)),
    "renal_cyst": (f"{_ID} % 2", (f"CASE {_ID} % 6 WHEN 0 THEN 'renal cyst' WHEN 1 THEN 'a cyst' ELSE 'kidney' END",)),
    "renal_hypodensities": ("1", (f"CASE {_ID} % 6 WHEN 2 THEN 'likely cysts' ELSE 'renal' END",)),
}
QUOTED_SQL = {name: _quoted_sql(label, *quotes) for name, (label, quotes) in QUOTED_PARTS.items()}


# --- samples for review ---------------------------------------------------------------------


def _stored_results(spark, sf_dir) -> DataFrame:
    """Final results written once and read back, as reviews start from stored results."""
    folder = _run_folder(spark, "results")
    derived.results(spark, sf_dir).write.parquet(folder)
    return spark.read.parquet(folder)


@query
def sampled_reports(spark, sf_dir):
    return sampling.sample_reports(derived.reports(spark, sf_dir), 100, seed=42)


@query
def sampled_catalog(spark, sf_dir):
    """A catalog taken from the conversations, cut to some categories and questions."""
    questions = derived.table(spark, sf_dir, "conversations").selectExpr("'topic ' || conv_id % 9 AS category", "text AS question").distinct()
    return sampling.sample_questions(questions, 4, 10, seed=42)


@query
def qc_findings(spark, sf_dir):
    return sampling.qc_findings(_stored_results(spark, sf_dir), 40, seed=42)


@query
def qc_categories(spark, sf_dir):
    return sampling.qc_categories(_stored_results(spark, sf_dir), 10, seed=42)


@query
def qc_questions(spark, sf_dir):
    return sampling.qc_questions(_stored_results(spark, sf_dir), 50, seed=42)


@query
def qc_typed_answers(spark, sf_dir):
    """Answers that are numbers, truth values and text in results documents, as yes and no."""
    documents = derived.reports(spark, sf_dir).selectExpr("report_id AS path", f"{TYPED_DOCUMENT_SQL} AS value")
    return sampling.question_examples(parse_typed_answers(documents))


# One results document per report, with an answer of each JSON kind.
TYPED_VALUES = ("2", "0.0", "-3", "0", "1e-3", "true", "false", "null", '"yes"', '"2"', '" No "', '"0"', '"maybe"', "[1]", '{"a": 1}')
TYPED_DOCUMENT_SQL = derived._json(
    "{'<n>': {'raw_text': <t>, 'qa_results': {'A': [{'first': <v>}, {'second': <w>}], 'B': [{'first': <w>}]}}}",
    n="report_id",
    t=derived.json_text_sql("report_text"),
    v="CASE CAST(report_id AS BIGINT) % 15 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(TYPED_VALUES)) + " END",
    w="CASE CAST(report_id AS BIGINT) % 3 WHEN 0 THEN '2' WHEN 1 THEN '0.0' ELSE '\"2\"' END",
)


@query
def qc_statistics(spark, sf_dir):
    results = _stored_results(spark, sf_dir)
    return sampling.qc_statistics(sampling.qc_questions(results, 50, seed=42), sampling.question_examples(results))


# --- evaluation --------------------------------------------------------------------------------

NOTES = ("yes", "No", "1", "0", "TRUE", "wrong", "maybe", "")


@query
def answer_readings(spark, sf_dir):
    """Every way an answer is read, over notes and whole turns."""
    turns = derived.turns(spark, sf_dir)
    notes = turns.withColumn("note", derived.hashed((*NOTES, "2", "No - none seen", "Unsure, yes", "yesterday", " good "), "request_id"))
    note = F.col("note")
    return notes.select(
        "request_id",
        yes_no(note).alias("as_yes_no"),
        yes_no(F.col("text")).alias("text_as_yes_no"),
        qc_answer(note).alias("as_qc"),
        annotation(note, F.lit(False)).alias("as_annotation"),
        annotation(note, F.lit(True)).alias("as_number"),
        question_key(F.col("text")).alias("question_key"),
    )


def _findings_sheet(spark, sf_dir):
    """Filled sheet: one column of words, one of numbers only."""
    ids = derived.table(spark, sf_dir, "labels").selectExpr("CAST(doc_id AS STRING) AS query_id", "quality", "toxic")
    return ids.select(
        "query_id",
        derived.hashed(NOTES, "query_id").alias("no_comparison_correct"),
        F.expr("CASE WHEN CAST(query_id AS BIGINT) % 4 <> 0 THEN CAST(quality + 2 * toxic AS STRING) END").alias("findings_correct"),
    )


def _category_sheet(spark, sf_dir):
    rows = derived.turns(spark, sf_dir).selectExpr("request_id", "role || ' ' || turn AS category", "turn")
    note = derived.hashed(NOTES, "request_id")
    return rows.select("category", F.when(F.col("turn") == 3, "maybe").otherwise(note).alias("correct"))


def _question_sheet(spark, sf_dir):
    rows = derived.turns(spark, sf_dir).selectExpr("request_id", "role || ' asks / turn ' || turn || '?' AS question", "turn")
    human = F.when(F.col("turn") == 2, "maybe").otherwise(derived.hashed(NOTES, "request_id"))
    predicted = derived.hashed(("0", "1", "1"), "request_id", "question")
    return rows.select(F.col("request_id").alias("query_id"), "question", predicted.alias("predicted_label"), human.alias("human_label"))


@query
def eval_correctness(spark, sf_dir):
    return metrics.eval_findings_sheet(_findings_sheet(spark, sf_dir))


@query
def eval_categories(spark, sf_dir):
    return metrics.eval_categories(_category_sheet(spark, sf_dir))


@query
def eval_questions(spark, sf_dir):
    return metrics.eval_questions(_question_sheet(spark, sf_dir))


def _tasks(spark, sf_dir):
    return metrics.evaluation_tasks(
        eval_correctness(spark, sf_dir), eval_categories(spark, sf_dir), eval_questions(spark, sf_dir)
    )


@query
def imperfect_tasks(spark, sf_dir):
    return metrics.imperfect_tasks(_tasks(spark, sf_dir), 0.6).orderBy("accuracy")


@query
def imperfect_by_type(spark, sf_dir):
    return metrics.tasks_by_type(metrics.imperfect_tasks(_tasks(spark, sf_dir)))


def _ground_truth(spark, sf_dir):
    """A wide label table: 0, 1 and other values, some under ids that no report has."""
    return derived.table(spark, sf_dir, "labels").selectExpr(
        "CASE WHEN doc_id % 8 = 7 THEN 'gone ' ELSE '' END || doc_id AS case_id",
        "CAST(quality AS STRING) AS fracture",
        "CASE WHEN doc_id % 6 = 5 THEN 'unknown' ELSE CAST(toxic AS STRING) END AS renal_cyst",
        "CASE WHEN doc_id % 4 = 3 THEN '-1' ELSE CAST(1 - quality AS STRING) END AS pleural_effusion",
        "CASE WHEN doc_id % 5 = 0 THEN '1.0' WHEN doc_id % 5 = 1 THEN '0' END AS osteopenia",
        "'2' AS ascites",
    )


TRUTH = ("fracture", "renal_cyst", "pleural_effusion", "osteopenia", "ascites")


def _answered_cases(spark, sf_dir):
    return metrics.answered_cases(_ground_truth(spark, sf_dir), derived.results(spark, sf_dir), TRUTH)


def _predicted_cases(spark, sf_dir):
    rules = _rules(*TRUTH)
    predictions = labels.to_wide(labels.label_results(derived.reports(spark, sf_dir), rules), labels.names_of(rules))
    return metrics.predicted_cases(_ground_truth(spark, sf_dir), predictions, TRUTH)


@query
def labels_unpivoted(spark, sf_dir):
    return labels.unpivot_labels(_ground_truth(spark, sf_dir), TRUTH, "case_id")


@query
def coverage_metrics(spark, sf_dir):
    found = metrics.coverage_metrics(_answered_cases(spark, sf_dir), TRUTH)
    return metrics.worst_first(found, "n_labeled")


@query
def coverage_overall(spark, sf_dir):
    cases = _answered_cases(spark, sf_dir)
    return metrics.coverage_overall(cases)


@query
def case_accuracy(spark, sf_dir):
    return metrics.case_accuracy(_answered_cases(spark, sf_dir))


@query
def evaluable_metrics(spark, sf_dir):
    return metrics.worst_first(metrics.evaluable_metrics(_predicted_cases(spark, sf_dir)), "n_eval")


@query
def evaluable_overall(spark, sf_dir):
    cases = _predicted_cases(spark, sf_dir)
    return metrics.evaluable_overall(cases)


@query
def catalog_drift(spark, sf_dir):
    """Catalog questions, a mapping of concepts to questions, and label columns held against each other.

    Every conversation is a topic of the catalog that asks its texts; the mapping
    and the labels come from the same texts, each with some that the others lack.
    """
    said = derived.table(spark, sf_dir, "conversations").selectExpr("role || ' ' || conv_id AS concept", "conv_id", "turn", "text")
    catalog = said.selectExpr("CASE WHEN conv_id % 5 = 0 THEN 'new: ' ELSE '' END || text AS question")
    mapping = said.selectExpr("CASE WHEN conv_id % 7 = 0 THEN 'old ' ELSE '' END || concept AS concept", "text AS question")
    labelled = said.selectExpr("CASE WHEN conv_id % 11 = 0 THEN 'extra ' ELSE '' END || concept AS concept")
    return metrics.drift(catalog, mapping, labelled)


# --- sources -----------------------------------------------------------------------------------


@query
def reports_last_wins(spark, sf_dir):
    """Three report files that repeat ids: the last text of each id."""
    reports = derived.reports(spark, sf_dir)
    newer = reports.filter(f"{_ID} % 3 = 0").withColumn("report_text", F.concat(F.lit("newer "), "report_text"))
    other = derived.table(spark, sf_dir, "benchmark").selectExpr(
        "CAST(item_id AS STRING) AS report_id", "text AS report_text"
    )
    parts = [df.withColumn("ord", F.lit(i)) for i, df in enumerate((reports, newer, other))]
    return last_wins(parts[0].unionByName(parts[1]).unionByName(parts[2]), "ord")


@query
def json_reports(spark, sf_dir):
    """Reports read from JSON documents of each layout."""
    documents = derived.reports(spark, sf_dir).selectExpr("report_id AS path", f"{JSON_DOCUMENT_SQL} AS value")
    return parse_json_reports(documents, "id", "text").select("path", "pos", "report_id", "report_text")


_TEXT_JSON = derived.json_text_sql("report_text")
# One JSON document per report: a list, a map, lists under a key, items without a key.
JSON_DOCUMENT_SQL = (
    f"CASE {_ID} % 6 "
    f"""WHEN 0 THEN {derived._json("[{'id': <n>, 'text': <t>}, {'id': 'x'}, {'id': 'y<n>', 'text': 'second'}]", n="report_id", t=_TEXT_JSON)} """
    f"""WHEN 1 THEN {derived._json("{'<n>': <t>, 'b<n>': 'other'}", n="report_id", t=_TEXT_JSON)} """
    f"""WHEN 2 THEN {derived._json("{'reports': [{'id': '<n>', 'text': <t>, 'extra': [1]}], 'data': 5}", n="report_id", t=_TEXT_JSON)} """
    f"""WHEN 3 THEN {derived._json("{'data': [{'text': <t>, 'id': <n>}, {'text': 'no id'}], 'n': 1}", n="report_id", t=_TEXT_JSON)} """
    f"""WHEN 4 THEN {derived._json("{'n': <n>, 'other': []}", n="report_id")} """
    f"""ELSE {derived._json("[{'id': '<n>', 'text': null}]", n="report_id")} END"""
)


@query
def results_documents(spark, sf_dir):
    """Final results read from JSON documents keyed by report id."""
    documents = derived.reports(spark, sf_dir).selectExpr("report_id AS path", f"{RESULT_DOCUMENT_SQL} AS value")
    read = parse_results_documents(documents)
    return read.select(
        "report_id",
        "raw_text",
        F.try_element_at("category_findings", F.lit("Bones")).alias("bones"),
        F.size("qa_results").alias("n_categories"),
        "error",
    )


RESULT_DOCUMENT_SQL = (
    f"CASE {_ID} % 3 "
    f"""WHEN 0 THEN {derived._json("{'<n>': {'error': 'failed', 'processing_time': 1.5}}", n="report_id")} """
    f"""WHEN 1 THEN {derived._json("{'<n>': {'raw_text': <t>, 'category_findings': {'Bones': 'b<n>'}, 'qa_results': {'Bones': [{'q': 'Yes'}]}}}", n="report_id", t=_TEXT_JSON)} """
    f"""ELSE {derived._json("{'<n>': {'raw_text': <t>, 'answers': {'A': [], 'B': [{'q': 'No'}]}}, 'z<n>': {'raw_text': 'z'}}", n="report_id", t=_TEXT_JSON)} END"""
)


# --- streams ----------------------------------------------------------------------------------


@query
def stream_labels(spark, sf_dir):
    """Labels of a stream of documents, written as they arrive."""
    folder = _run_folder(spark, "labels")
    arriving = incremental.stream_table(spark, f"{sf_dir}/documents.parquet", "doc_id BIGINT, text STRING")
    # A single file is read in few pieces; labelling is dealt to as many tasks as a batch run has.
    arriving = spread(arriving, partitions(spark))
    reports = arriving.selectExpr("CAST(doc_id AS STRING) AS report_id", f"{derived.REPORT_TEXT_SQL} AS report_text")
    incremental.label_stream(reports, f"{folder}/labels", f"{folder}/checkpoint").awaitTermination()
    written = spark.read.schema("report_id STRING, concept STRING, label INT, evidence ARRAY<STRING>")
    return written.parquet(f"{folder}/labels").select("report_id", "concept", "label", _joined())


@query
def stream_append(spark, sf_dir):
    """Stage rows appended from a stream, run twice: the second adds nothing."""
    folder = _run_folder(spark, "rows")
    store = StageStore(f"{folder}/store")
    for attempt in ("first", "second"):
        arriving = incremental.stream_table(
            spark, f"{sf_dir}/conversations.parquet", "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
        )
        rows = arriving.selectExpr(
            "CAST(conv_id AS STRING) AS report_id", "role || ' ' || turn % 3 AS category", f"{derived.CONTENT_SQL} AS findings"
        )
        incremental.append_stream(rows, "category_findings", store, f"{folder}/{attempt}").awaitTermination()
    return store.load(spark, "category_findings")


@query
def stream_distinct(spark, sf_dir):
    """Stage rows by stateful keys: a replayed file and a late one, after a restart, add only new keys."""
    folder = _run_folder(spark, "distinct")
    rows = derived.turns(spark, sf_dir).selectExpr(
        "CAST(conv_id AS STRING) AS report_id", "role || ' ' || turn AS category", "content AS findings"
    )
    early = rows.filter(f"{_ID} % 3 <> 0")
    late = rows.filter(f"{_ID} % 2 = 0").withColumn("findings", F.concat(F.lit("again "), "findings"))
    schema = "report_id STRING, category STRING, findings STRING"
    for arrival in ([early], [early, late]):
        for part in arrival:
            part.write.mode("append").parquet(f"{folder}/in")
        arriving = incremental.stream_table(spark, f"{folder}/in", schema)
        incremental.distinct_stream(arriving, "category_findings", f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(schema).parquet(f"{folder}/out")


@dataclass(frozen=True)
class _BreaksOnce(StageStore):
    """A store whose third append fails, as if the driver were lost in the middle of a batch."""

    calls: list[str] = field(default_factory=list)

    def append(self, stage: str, rows: DataFrame) -> None:
        self.calls.append(stage)
        if len(self.calls) == 3:
            raise RuntimeError("lost in the middle of a batch")
        super().append(stage, rows)


def later_answers() -> Callable[[Sequence[str]], list[str]]:
    """Answers to what was asked before without use."""
    return lambda prompts: ["Unsure"] * len(prompts)


@query
def stream_batches(spark, sf_dir):
    """Four batches of a stage, one of which breaks off and is repeated; then what was rejected is asked again."""
    folder = _run_folder(spark, "batches")
    store = _BreaksOnce(f"{folder}/store", buckets=16)
    reports = derived.reports(spark, sf_dir)
    for part in range(4):
        reports.filter(f"pmod(xxhash64(report_id), 4) = {part}").write.mode("append").parquet(f"{folder}/in")
        for _ in range(2):
            arriving = incremental.stream_table(spark, f"{folder}/in", "report_id STRING, report_text STRING")
            running = incremental.stage_stream(arriving, "questions", store, echo_stage(), f"{folder}/checkpoint", derived.catalog())
            try:
                running.awaitTermination()
            except StreamingQueryException:
                continue
            break
    retry_stage(spark, "questions", spark.read.parquet(f"{folder}/in"), store, later_answers(), derived.catalog())
    stored = store.load(spark, "questions").select("report_id", "category", "question_id", "answer", F.lit("stored").alias("kind"))
    refused = store.rejected(spark, "questions").select("report_id", "category", "question_id", F.col("content").alias("answer"), F.lit("rejected").alias("kind"))
    return stored.unionByName(refused)


@query
def stream_stage(spark, sf_dir):
    """A stage answered for a stream of reports; failed answers stay open."""
    folder = _run_folder(spark, "stage")
    store = StageStore(f"{folder}/store")
    arriving = incremental.stream_table(spark, f"{sf_dir}/documents.parquet", "doc_id BIGINT, text STRING")
    reports = arriving.selectExpr("CAST(doc_id AS STRING) AS report_id", f"{derived.REPORT_TEXT_SQL} AS report_text")
    incremental.stage_stream(
        reports, "questions", store, echo_stage(), f"{folder}/checkpoint", derived.catalog()
    ).awaitTermination()
    return store.load(spark, "questions")


FLAGSHIP = concept_labels
CONCEPTS = tuple(CONCEPT_QUESTIONS)
