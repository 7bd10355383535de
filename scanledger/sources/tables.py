"""Other tables the work reads: results, labels, annotation sheets, response files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import STAGE_COLUMNS
from .reports import json_documents, read_csv_texts

RESULT_FIELDS = {
    "raw_text": "string",
    "no_comparison_text": "string",
    "findings_text": "string",
    "category_findings": "map<string,string>",
    "qa_results": "map<string,array<map<string,string>>>",
    "answers": "map<string,array<map<string,string>>>",
    "processing_time": "double",
    "error": "string",
}
_FIELDS = ", ".join(f"{name}: {kind}" for name, kind in RESULT_FIELDS.items())


def require_columns(df: DataFrame, columns: Sequence[str], where: str) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{where} lacks columns {missing}; it has {df.columns}")
    return df


def read_stage_table(spark: SparkSession, stage: str, path: str) -> DataFrame:
    """A stage table from Parquet or CSV, checked for its columns, all text."""
    if stage not in STAGE_COLUMNS:
        raise ValueError(f"unknown stage {stage!r}")
    raw = read_csv_texts(spark, path) if path.lower().endswith(".csv") else spark.read.parquet(path)
    columns = STAGE_COLUMNS[stage]
    return require_columns(raw, columns, path).select(*[F.col(c).cast("string") for c in columns])


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Final results, one JSON object per line with its report_id."""
    fields = ", ".join(f"{name} {kind}" for name, kind in RESULT_FIELDS.items())
    return _with_answers(spark.read.schema(f"report_id string, {fields}").json(path))


def read_results_document(spark: SparkSession, path: str) -> DataFrame:
    """Final results as one JSON document per file, keyed by report id."""
    return parse_results_documents(json_documents(spark, path))


def parse_results_documents(documents: DataFrame) -> DataFrame:
    entries = F.from_json(F.col("value"), f"map<string,struct<{_FIELDS}>>")
    rows = documents.select(F.explode(entries).alias("report_id", "r"))
    return _with_answers(rows.select("report_id", "r.*"))


def parse_typed_answers(documents: DataFrame) -> DataFrame:
    """report_id, raw_text, typed_answers: the answers as the JSON values they are, so that 2 is not "2"."""
    kind = "map<string,array<map<string,variant>>>"
    entries = F.from_json(F.col("value"), f"map<string,struct<raw_text: string, qa_results: {kind}, answers: {kind}>>")
    rows = documents.select(F.explode(entries).alias("report_id", "r"))
    answers = F.when(F.size("r.qa_results") > 0, F.col("r.qa_results")).otherwise(F.col("r.answers"))
    return rows.select("report_id", F.col("r.raw_text").alias("raw_text"), answers.alias("typed_answers"))


def _with_answers(results: DataFrame) -> DataFrame:
    """``answers`` stands in for an absent or empty ``qa_results``."""
    filled = F.when(F.size("qa_results") > 0, F.col("qa_results")).otherwise(F.col("answers"))
    return results.withColumn("qa_results", filled).drop("answers")


def read_label_table(spark: SparkSession, path: str, id_col: str = "case_id") -> tuple[DataFrame, list[str]]:
    """A wide label table as text, and its concepts: all columns but the id."""
    raw = require_columns(read_csv_texts(spark, path), [id_col], path)
    return raw, [c for c in raw.columns if c != id_col]


def read_response_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """value and ord (position over files and lines) of JSON-lines response files."""
    position = F.struct(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return spark.read.text(path if isinstance(path, str) else list(path)).select("value", position.alias("ord"))


def read_annotation_sheet(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A sheet that people filled in, all cells as text."""
    return require_columns(read_csv_texts(spark, path), columns, path)
