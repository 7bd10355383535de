"""Clinical tables derived from the given ones by plain expressions.

The given ``documents`` hold prose without clinical findings.  A derived report
is the whole document text set between report sentences chosen by its id, so the
work grows with the texts and every label value occurs.  The expressions are
SQL both Spark and DuckDB read, and the check SQL uses them as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import CONCEPT_QUESTIONS
from ..operators.combine import combine_stages
from ..operators.requests import fan_out_categories, fan_out_questions
from ..operators.responses import to_stage_rows, valid_findings
from ..session import partitions, spread
from ..sources.catalog import Catalog, Category

# Report sentences, picked by doc_id modulo the length of each pool ("|" ends a line).
POOLS = {
    "head": (
        "HISTORY:|No acute pain.|FINDINGS: ",
        "TECHNIQUE: CT.|Findings: ",
        "",
        "Indication:|Rule out fracture.|Findings:|",
    ),
    "effusion": (
        "No pleural effusion. ",
        "Small right effusion. ",
        "Possible pleural effusion. ",
        "Small pericardial effusion. ",
        "There is a pleural effusion. ",
        "Lungs are clear. ",
        "No atelectasis. Trace left effusion is absent. ",
    ),
    "coronary": (
        "Coronary calcification is present. ",
        "Coronary artery calcifications are likely. ",
        "Mitral annular calcification. ",
        "No coronary calcification. ",
        "Heart size is normal. ",
    ),
    "renal": (
        "Simple renal cyst in the left kidney. ",
        "Hypodense liver lesion, consistent with cysts. ",
        "Renal hypodensities, likely cysts. ",
        "Renal lesion too small to characterize. ",
        "Solid renal mass. ",
        "Indeterminate renal lesion. ",
    ),
    "misc": (
        "Mild pelviectasis. ",
        "No hydronephrosis. ",
        "Hydronephrosis on the left. ",
        "Gallbladder is surgically absent. ",
        "Status post cholecystectomy. ",
        "Metastatic disease. ",
        "Cannot exclude metastases. ",
        "Free air. No free air. ",
        "Ascites may represent malignancy. ",
    ),
    "skeletal": (
        "No fracture. ",
        "Rib fracture. ",
        "Possible fracture. No fracture. ",
        "Splenomegaly. ",
        "Hepatic steatosis. ",
        "Gallstones! ",
        "SBO? ",
        "AAA. ",
        "Osteopenia. ",
        "Hiatal hernia. ",
        "Diffuse edema. ",
    ),
    "tail": ("|INDICATION:|Possible appendicitis.|IMPRESSION:|Stable exam.", "", "", "", ""),
}
READS = ("head", "effusion", "coronary", "renal", "text", "misc", "skeletal", "tail")


def sql_text(value: str) -> str:
    """A text as SQL, line ends written as chr(10)."""
    return " || chr(10) || ".join("'" + piece.replace("'", "''") + "'" for piece in value.split("|"))


def pool_sql(name: str, key: str = "doc_id") -> str:
    items = POOLS[name]
    cases = " ".join(f"WHEN {i} THEN {sql_text(item)}" for i, item in enumerate(items))
    return f"CASE {key} % {len(items)} {cases} END"


REPORT_TEXT_SQL = " || ".join("text || ' '" if part == "text" else f"({pool_sql(part)})" for part in READS)
REPORTS_SQL = f"SELECT CAST(doc_id AS STRING) AS report_id, {REPORT_TEXT_SQL} AS report_text FROM documents"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """report_id, report_text for every document, whole texts."""
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), partitions(spark))
    return documents.selectExpr("CAST(doc_id AS STRING) AS report_id", f"{REPORT_TEXT_SQL} AS report_text")


# --- responses of a model, made of whole conversation turns --------------------------

# What came back for a turn, by (conv_id + turn) % 9; the text itself twice.
CONTENT_SQL = (
    "CASE (conv_id + turn) % 9 WHEN 0 THEN text WHEN 1 THEN 'Yes' WHEN 2 THEN ' No ' WHEN 3 THEN 'yes.' "
    "WHEN 4 THEN 'No relevant findings: ' || text WHEN 5 THEN 'Error' WHEN 6 THEN '' "
    "WHEN 7 THEN 'thinking</think> ' || text ELSE 'No such section' END"
)


def json_text_sql(column: str) -> str:
    """A text as a JSON string, in SQL both engines read."""
    back, quote, feed = "chr(92)", "chr(34)", "chr(10)"
    escaped = f"replace(replace(replace({column}, {back}, {back} || {back}), {quote}, {back} || {quote}), {feed}, {back} || 'n')"
    return f"{quote} || {escaped} || {quote}"


def _json(template: str, **pieces: str) -> str:
    """JSON written with single quotes and <name> places, as a SQL text expression."""
    out = "'" + template.replace("'", '"') + "'"
    for name, sql in pieces.items():
        out = out.replace(f"<{name}>", f"' || {sql} || '")
    return out


_CONTENT_JSON = json_text_sql("content")
_REQUEST_JSON = "conv_id || '_' || turn"
# One line of a response file per turn: lists, objects, errors, nulls, broken and blank lines.
LINE_SQL = (
    "CASE "
    f"""WHEN conv_id % 17 = 3 THEN {_json("{'custom_id': '<id>', 'response'", id=_REQUEST_JSON)} """
    "WHEN conv_id % 19 = 4 THEN '  ' "
    f"""WHEN conv_id % 13 = 0 THEN {_json("{'custom_id': '<id>', 'error': {'code': 500}}", id=_REQUEST_JSON)} """
    f"""WHEN conv_id % 11 = 5 THEN {_json("{'custom_id': '<id>', 'response': {'body': {'choices': [{'message': {'content': null}}]}}}", id=_REQUEST_JSON)} """
    f"""WHEN conv_id % 23 = 6 THEN {_json("{'custom_id': '<id>', 'response': {'body': {'choices': []}}}", id=_REQUEST_JSON)} """
    f"""WHEN conv_id % 2 = 0 THEN {_json("{'custom_id': '<id>', 'response': {'body': {'choices': [{'message': {'content': <content>}}]}}}", id=_REQUEST_JSON, content=_CONTENT_JSON)} """
    f"""ELSE {_json("{'custom_id': '<id>', 'response': {'body': {'choices': {'message': {'content': <content>}}}}}", id=_REQUEST_JSON, content=_CONTENT_JSON)} END"""
)
# A chat body per turn in the layouts servers use.
BODY_SQL = (
    "CASE (conv_id * 3 + turn) % 8 "
    f"""WHEN 0 THEN {_json("{'choices': [{'message': {'content': <content>, 'reasoning_content': 'why'}}]}", content=_CONTENT_JSON)} """
    f"""WHEN 1 THEN {_json("{'choices': [{'text': <content>}]}", content=_CONTENT_JSON)} """
    f"""WHEN 2 THEN {_json("{'choices': [{'delta': {'content': <content>}}]}", content=_CONTENT_JSON)} """
    f"""WHEN 3 THEN {_json("{'choices': {'message': {'content': <content>}}}", content=_CONTENT_JSON)} """
    f"""WHEN 4 THEN {_json("{'content': <content>}", content=_CONTENT_JSON)} """
    f"""WHEN 5 THEN {_json("{'choices': [], 'text': <content>}", content=_CONTENT_JSON)} """
    f"""WHEN 6 THEN {_json("{'error': {'message': <content>}, 'content': 'x'}", content=_CONTENT_JSON)} """
    f"""ELSE {_json("{'choices': [{'message': {'content': null, 'reasoning_content': <content>}, 'text': 't'}]}", content=_CONTENT_JSON)} END"""
)
TURNS_SQL = f"SELECT conv_id, turn, role, text, conv_id || '_' || turn AS request_id, {CONTENT_SQL} AS content FROM conversations"


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, turn, role, text, request_id, content"""
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn", "role", "text", "conv_id || '_' || turn AS request_id", f"{CONTENT_SQL} AS content"
    )


# --- stage tables, made of whole reports ------------------------------------------------

ANSWERS = ("Yes", "No", "yes.", "No - none seen", "Yes and no", "Unsure, yes", "", "true")
# The catalog the derived stages ask about.
CATEGORIES = {
    "Pleura": ("Findings of the pleura", ("pleural_effusion", "atelectasis")),
    "Renal system": ("Findings of the kidneys", ("renal_cyst", "renal_hypodensities", "hydronephrosis")),
    "Bones": ("Findings of the skeleton", ("fracture", "osteopenia", "renal_cyst")),
}
NO_COMPARISON_SQL = "CASE WHEN length(report_id) % 2 = 1 THEN report_text ELSE 'Rewritten. ' || report_text END"
FINDINGS_SQL = (
    "CASE CAST(report_id AS BIGINT) % 5 WHEN 0 THEN 'No such section' WHEN 1 THEN ' ' "
    "ELSE 'FINDINGS: ' || report_text END"
)


def catalog() -> Catalog:
    return Catalog(
        "derived",
        tuple(
            Category(name, text, tuple(CONCEPT_QUESTIONS[c] for c in concepts))
            for name, (text, concepts) in CATEGORIES.items()
        ),
    )


def hashed(pool: Sequence[str], *columns: str) -> Column:
    """An item of a pool picked by the md5 of some columns."""
    digits = F.left(F.md5(F.concat_ws(":", *columns)), F.lit(4))
    place = F.pmod(F.conv(digits, 16, 10).cast("int"), F.lit(len(pool)))
    return F.get(F.array(*[F.lit(p) for p in pool]), place)


def own_id_sql(place: int) -> str:
    """Ids of a stage table: one in four reports has an id there that no other table knows."""
    return f"CASE WHEN CAST(report_id AS BIGINT) % 4 = {place} THEN 'only {place} ' ELSE '' END || report_id"


def no_comparisons(reports_df: DataFrame) -> DataFrame:
    return reports_df.selectExpr("report_id", f"{NO_COMPARISON_SQL} AS no_comparison_text")


def findings(reports_df: DataFrame) -> DataFrame:
    return reports_df.selectExpr("report_id", f"{FINDINGS_SQL} AS findings")


def category_answers(reports_df: DataFrame) -> DataFrame:
    """report_id, category, content for every finding and category."""
    rows = fan_out_categories(findings(reports_df), catalog())
    kinds = hashed(("No relevant findings", "error", "seen", "seen", "No relevant findings."), "report_id", "category")
    seen = F.concat(F.col("category"), F.lit(": "), F.col("findings"))
    return rows.select("report_id", "category", F.when(kinds == "seen", seen).otherwise(kinds).alias("content"))


def question_answers(reports_df: DataFrame) -> DataFrame:
    """report_id, category, question_id, question, content for every report and question."""
    rows = fan_out_questions(reports_df, catalog())
    content = hashed(ANSWERS, "report_id", "category", "question_id")
    return rows.select("report_id", "category", "question_id", "question", content.alias("content"))


def stage_tables(reports_df: DataFrame) -> dict[str, DataFrame]:
    return {
        "no_comparisons": no_comparisons(reports_df),
        "findings": valid_findings(findings(reports_df)),
        "category_findings": to_stage_rows(category_answers(reports_df), "category_findings"),
        "questions": to_stage_rows(question_answers(reports_df), "questions"),
    }


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final results of every report."""
    base = reports(spark, sf_dir)
    return combine_stages(base, **stage_tables(base))
