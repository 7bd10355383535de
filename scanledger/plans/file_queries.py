"""Registered queries that go through files: whole tables written, read back and shown."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import labels, metrics, requests, responses, sampling
from ..operators.lexicon import ConceptRule
from ..session import written
from ..sources import sinks
from ..sources.catalog import read_catalog
from ..sources.reports import read_csv_texts, read_reports
from ..sources.store import StageStore
from ..sources.tables import read_annotation_sheet, read_label_table, read_response_lines, read_results, read_stage_table
from . import derived, queries
from .queries import query

#: Reports that one JSON file of the derived tables holds.
FILE_REPORTS = 500


def _placed(df: DataFrame) -> DataFrame:
    """Rows of one file with their place in it."""
    return df.withColumn("pos", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())))


@query
def csv_and_json_reports(spark, sf_dir):
    """Reports from CSV files and, for some, newer texts from JSON files: the last file wins."""
    folder = queries._run_folder(spark, "reports")
    reports = derived.reports(spark, sf_dir)
    named = reports.select(F.col("report_id").alias("Accession"), F.col("report_text").alias("Report Text"), F.lit("x").alias("other"))
    sinks.write_csv(named, f"{folder}/old.csv")
    newer = reports.filter(f"{queries._ID} % 3 = 0").selectExpr(
        f"floor({queries._ID} / {FILE_REPORTS}) AS file", "named_struct('Accession', report_id, 'Report Text', 'newer ' || report_text) AS item"
    )
    # A list of some reports for each file, one file for each row.
    lists = newer.groupBy("file").agg(F.to_json(F.collect_list("item")).alias("value")).select("value")
    lists.write.option("maxRecordsPerFile", 1).text(f"{folder}/new.json")
    return read_reports(spark, [f"{folder}/old.csv", f"{folder}/new.json"])


@query
def stage_files(spark, sf_dir):
    """Stage tables from CSV and Parquet files, and one that was written over."""
    folder = queries._run_folder(spark, "stage-files")
    tables = derived.stage_tables(derived.reports(spark, sf_dir))
    sinks.write_csv(tables["findings"].withColumn("more", F.lit(1)), f"{folder}/findings.csv")
    tables["category_findings"].write.parquet(f"{folder}/category_findings")
    store = StageStore(f"{folder}/store")
    store.append("no_comparisons", tables["no_comparisons"].withColumn("no_comparison_text", F.lit("old")))
    store.overwrite("no_comparisons", tables["no_comparisons"])
    parts = {
        "findings": read_stage_table(spark, "findings", f"{folder}/findings.csv"),
        "category_findings": read_stage_table(spark, "category_findings", f"{folder}/category_findings"),
        "no_comparisons": store.load(spark, "no_comparisons"),
    }
    shown = [df.select(F.lit(name).alias("part"), "report_id", F.col(df.columns[-1]).alias("value")) for name, df in parts.items()]
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


@query
def catalog_file_requests(spark, sf_dir):
    """Questions of a catalog that is read from a YAML file."""
    folder = queries._run_folder(spark, "catalog")
    listed = {
        c.name: {"description": c.description, "questions": [{"question": q} for q in c.questions]} for c in derived.catalog().categories
    }
    # JSON is YAML too; one line, so one file.
    text = json.dumps({"modality": "derived", "categories": listed})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(folder)
    asked = requests.build_requests("questions", derived.reports(spark, sf_dir), read_catalog(folder, spark))
    return asked.select("report_id", "category", "question_id", "question", "request_id")


@query
def response_files(spark, sf_dir):
    """Answers from response files; of repeated ids the last line of the last file counts."""
    folder = queries._run_folder(spark, "responses")
    lines = queries._lines(spark, sf_dir)
    lines.repartitionByRange(4, "ord").sortWithinPartitions("ord").select("value").write.text(f"{folder}/a")
    again = lines.filter("ord % 3 > 0").select(F.replace("value", F.lit('"content": "'), F.lit('"content": "Again: ')).alias("value"))
    again.write.text(f"{folder}/b")
    return responses.parse_response_lines(read_response_lines(spark, [f"{folder}/a", f"{folder}/b"]), "ord")


@query
def results_file(spark, sf_dir):
    """Final results as JSON lines, some with an error, written and read back."""
    folder = queries._run_folder(spark, "results-file")
    results = derived.results(spark, sf_dir).withColumn("error", F.when(F.expr(f"{queries._ID} % 10 = 0"), F.lit("failed")))
    sinks.write_final_results(results, folder, compression="gzip")
    back = read_results(spark, folder)
    empty = back.fillna("", ["raw_text", "no_comparison_text", "findings_text"]).withColumns(
        {
            "category_findings": F.coalesce("category_findings", F.create_map().cast("map<string,string>")),
            "qa_results": F.coalesce("qa_results", F.create_map().cast("map<string,array<map<string,string>>>")),
        }
    )
    # Each row is shown once for every row of its id.  Few ids repeat, so texts are not moved for that.
    twice = written(back.where("report_id IS NOT NULL").groupBy("report_id").count().where("count > 1"), "twice")
    shown = queries._shown(empty, "error", "processing_time").where("report_id IS NOT NULL")
    times = F.explode(F.array_repeat(F.lit(1), F.coalesce(F.col("count").cast("int"), F.lit(1))))
    return shown.join(twice, "report_id", "left").select("*", times.alias("time")).drop("count", "time")


@query
def wide_label_file(spark, sf_dir):
    """Labels and evidence as a wide CSV table, written and read back as text."""
    folder = queries._run_folder(spark, "wide")
    sinks.write_wide_labels(labels.label_results(derived.reports(spark, sf_dir)), labels.names_of(None), folder)
    return read_csv_texts(spark, folder).fillna("")


_MAPS = "labels map<string,int>, evidence map<string,array<string>>"


def _entries(nested: DataFrame, *extra: str) -> DataFrame:
    shown = nested.select("report_id", "evidence", *extra, F.explode("labels").alias("concept", "label"))
    said = F.array_join(F.try_element_at("evidence", "concept"), queries.EVIDENCE_SEPARATOR)
    return shown.select("report_id", "concept", "label", said.alias("evidence"), *extra)


@query
def nested_label_file(spark, sf_dir):
    """Label and evidence maps as JSON lines, written and read back."""
    folder = queries._run_folder(spark, "nested")
    sinks.write_nested_labels(labels.label_results(derived.reports(spark, sf_dir)), labels.names_of(None), folder)
    return _entries(spark.read.schema(f"report_id string, {_MAPS}").json(folder))


@query
def label_lines_file(spark, sf_dir):
    """Labels with the payload they were read from, appended in two runs."""
    folder = queries._run_folder(spark, "lines")
    rules = queries._rules("fracture", "ascites")
    reports = derived.reports(spark, sf_dir).withColumn("raw_payload", F.expr("'{\"n\": ' || length(report_text) || '}'"))
    for part in (f"{queries._ID} % 2 = 0", f"{queries._ID} % 2 <> 0"):
        sinks.write_label_lines(labels.label_results(reports.filter(part), rules), labels.names_of(rules), folder)
    return _entries(spark.read.schema(f"report_id string, {_MAPS}, raw_payload string").json(folder), "raw_payload")


@query
def label_file_metrics(spark, sf_dir):
    """Metrics of predicted labels beside a label file, written worst first and read back with their places."""
    folder = queries._run_folder(spark, "metrics")
    sinks.write_csv(queries._ground_truth(spark, sf_dir), f"{folder}/labels.csv")
    truth, concepts = read_label_table(spark, f"{folder}/labels.csv")
    rules = queries._rules(*concepts)
    predictions = labels.to_wide(labels.label_results(derived.reports(spark, sf_dir), rules), labels.names_of(rules))
    cases = metrics.predicted_cases(truth, predictions, concepts)
    sinks.write_metric_table(metrics.evaluable_metrics(cases), "n_eval", f"{folder}/metrics")
    return _placed(read_csv_texts(spark, f"{folder}/metrics").select("disease", F.col("n_eval").cast("long").alias("n_eval"), F.col("f1").cast("double").alias("f1")))


@query
def case_file(spark, sf_dir):
    """Accuracy of each case as CSV files, written and read back."""
    folder = queries._run_folder(spark, "cases")
    sinks.write_case_table(metrics.case_accuracy(queries._answered_cases(spark, sf_dir)), folder)
    back = read_csv_texts(spark, folder)
    return back.select("case_id", *[F.col(c).cast("int").alias(c) for c in ("n_labeled", "n_correct")], F.col("accuracy").cast("double").alias("accuracy"))


@query
def review_files(spark, sf_dir):
    """The three review sheets as people get them, one CSV file each in mixed order, read back with their places."""
    folder = queries._run_folder(spark, "sheets")
    keys = {"combined_findings": ["query_id"], "categories": ["query_id", "category"], "questions": ["query_id", "question"]}
    parts = []
    for name, sheet in sampling.qc_sheets(queries._stored_results(spark, sf_dir)).items():
        order = sampling.mixed_order(42, keys[name])
        sinks.write_sheet(sheet, f"{folder}/{name}", order)
        back = _placed(read_annotation_sheet(spark, f"{folder}/{name}", keys[name]))
        other = F.col(keys[name][1]) if len(keys[name]) > 1 else F.lit("")
        parts.append(back.select(F.lit(name).alias("sheet"), "pos", "query_id", other.alias("key"), F.length("raw_text").alias("raw_chars")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def task_files(spark, sf_dir):
    """Task metrics as JSON lines and the imperfect ones as CSV, worst first, written and read back."""
    folder = queries._run_folder(spark, "tasks")
    tasks = queries._tasks(spark, sf_dir)
    sinks.write_metrics(tasks, f"{folder}/metrics")
    sinks.write_imperfect(metrics.imperfect_tasks(tasks, 0.6), f"{folder}/imperfect")
    every = spark.read.schema("qc_type string, task_name string, accuracy double, n_annotated long").json(f"{folder}/metrics")
    worst = _placed(read_csv_texts(spark, f"{folder}/imperfect")).select("pos", "qc_type", "task_name", F.col("accuracy").cast("double").alias("accuracy"), F.col("n_annotated").cast("long").alias("n_annotated"))
    before = F.coalesce(F.lag("accuracy").over(Window.orderBy("pos")), F.lit(0.0))
    shown = worst.select(F.lit("imperfect").alias("part"), "qc_type", "task_name", "accuracy", "n_annotated", (F.col("accuracy") >= before).alias("in_order"))
    return shown.unionByName(every.select(F.lit("all").alias("part"), "qc_type", "task_name", "accuracy", "n_annotated", F.lit(True).alias("in_order")))


#: Concepts that a user adds to the built-in ones.
OWN_RULES = (
    ConceptRule("stable", (r"\bstable\b",), forbid=(r"\bunstable\b",), anchors=("stable",)),
    ConceptRule("pain", (r"\bpain\b", r"\bache\b"), always_present=(r"\bacute pain\b",)),
    ConceptRule("clear_lungs", (r"\blungs\b",), require=(r"\bclear\b",), special_uncertain=(r"\bperhaps\b",)),
)


@query
def own_concepts(spark, sf_dir):
    """Labels of concepts that a user wrote down as rules."""
    found = labels.label_concepts(derived.reports(spark, sf_dir), OWN_RULES)
    return found.select("report_id", "concept", "label", queries._joined())
