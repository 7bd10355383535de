"""Where results go.

Large results are written as folders of files by all tasks.  Only samples and
metric tables, which are bounded by a budget or the catalog, are put in one file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import IMPERFECT_COLUMNS
from ..operators.labels import to_nested, to_wide


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV files with a header.  Blanks around a text stay: without these options Spark cuts them off."""
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).options(escape='"', **kept).csv(path, header=True)


def write_final_results(combined: DataFrame, path: str, compression: str = "none") -> None:
    """One JSON object per line; rows with an error keep only it and the time.

    A result says a report's text several times, so ``compression="gzip"`` makes the files a fraction as large.
    """
    failed = F.col("error").isNotNull()
    columns = [c for c in combined.columns if c not in ("report_id", "error", "processing_time")]
    shown = [F.when(~failed, F.col(c)).alias(c) for c in columns]
    combined.select("report_id", "error", *shown, "processing_time").write.mode("overwrite").json(path, compression=compression)


def write_wide_labels(results: DataFrame, names: Sequence[str], path: str) -> None:
    write_csv(to_wide(results, names), path)


def write_nested_labels(results: DataFrame, names: Sequence[str], path: str) -> None:
    to_nested(results, names).write.mode("overwrite").json(path)


def write_label_lines(results: DataFrame, names: Sequence[str], path: str, mode: str = "append") -> None:
    """Labels from a model with the raw payload, one JSON object per line."""
    to_nested(results, names, extra=["raw_payload"]).write.mode(mode).json(path)


def _one_file(bounded: DataFrame, order: Sequence[Column | str] = ()) -> DataFrame:
    """All rows in one partition, by a shuffle of these few rows.

    ``coalesce`` would instead run the whole stage that makes them in one task.
    """
    single = bounded.repartition(1)
    return single.sortWithinPartitions(*order) if order else single


def write_sheet(sample: DataFrame, path: str, order: Sequence[Column | str] = ()) -> None:
    """A bounded sample for people to fill in, as one CSV file."""
    write_csv(_one_file(sample, order), path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    _one_file(metrics).write.mode("overwrite").json(path)


def write_metric_table(metrics: DataFrame, support: str, path: str) -> None:
    """Metrics per concept, worst first, as one CSV file."""
    write_csv(_one_file(metrics, [F.asc("f1"), F.desc(support), "disease"]), path)


def write_case_table(cases: DataFrame, path: str) -> None:
    """Metrics per case: as many rows as cases, so as many files as tasks."""
    write_csv(cases, path)


def write_imperfect(tasks: DataFrame, path: str) -> None:
    """Tasks below the threshold, worst first, fixed column order."""
    write_csv(_one_file(tasks.select(*IMPERFECT_COLUMNS), ["accuracy"]), path)
