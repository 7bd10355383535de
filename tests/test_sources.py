import csv
import json
from pathlib import Path

import pytest

from scanledger.functions.fixed_values import CONCEPT_QUESTIONS
from scanledger.operators.labels import label_results, names_of
from scanledger.operators.responses import parse_response_lines
from scanledger.plans.file_queries import results_file
from scanledger.sources import sinks
from scanledger.sources.catalog import (
    catalog_from_mapping,
    categories_frame,
    concept_catalog,
    missing_questions,
    questions_frame,
    read_catalog,
    read_templates,
)
from scanledger.sources.reports import read_reports
from scanledger.sources.tables import (
    read_annotation_sheet,
    read_label_table,
    read_response_lines,
    read_results_document,
    read_stage_table,
)


def got(df):
    return {(r.report_id, r.report_text) for r in df.collect()}


def test_csv_with_line_breaks_and_quotes(spark, tmp_path):
    path = tmp_path / "a.csv"
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerows([["Accession", "x", "Report Text"], ["001", 1, 'He said "no",\nthen left.'], ["2", 2, ""]])
    assert got(read_reports(spark, [str(path)])) == {("001", 'He said "no",\nthen left.'), ("2", "")}
    with pytest.raises(ValueError):
        read_reports(spark, [str(path)], id_col="other")


JSON = {
    "list.json": ([{"id": 7, "text": "a"}, {"id": "x"}, {"text": "b"}, {"id": None, "text": "c"}, {"id": "n", "text": None}],
                  {("7", "a"), (None, "c"), ("n", "")}),
    "map.json": ({"1": "a", "reports": "b", "1é": 'c "q"\n'}, {("1", "a"), ("reports", "b"), ("1é", 'c "q"\n')}),
    "wrapped.json": ({"reports": [{"id": 1, "text": "a", "z": {}}], "data": [{"id": 2, "text": "b"}]}, {("1", "a")}),
    "data.json": ({"n": 1, "data": [{"id": 2, "text": "b"}]}, {("2", "b")}),
    "empty.json": ({}, set()),
    "none.json": ({"n": 1, "m": []}, set()),
    "emptylist.json": ([], set()),
}


@pytest.mark.parametrize("name", JSON)
def test_json_layouts(spark, tmp_path, name):
    content, expected = JSON[name]
    (tmp_path / name).write_text(" " + json.dumps(content, ensure_ascii=False) + "\n", encoding="utf-8")
    assert got(read_reports(spark, [str(tmp_path / name)], "id", "text")) == expected


@pytest.mark.parametrize("content", ["5", '"text"', "{bad", " ", '{"reports": "x", "data": [{"id": 1, "text": "a"}]}', '{"reports": {"a": 1}}', "[1, 2"])
def test_json_that_is_refused(spark, tmp_path, content):
    (tmp_path / "x.json").write_text(content)
    with pytest.raises(Exception, match="unsupported JSON structure"):
        read_reports(spark, [str(tmp_path / "x.json")], "id", "text").collect()


def test_last_file_and_row_win(spark, tmp_path):
    (tmp_path / "b.csv").write_text("id,text\n1,old\n2,first\n2,second\n")
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1, "text": "mid"}, {"id": 1, "text": "new"}, {"id": 3, "text": "c"}]))
    paths = [str(tmp_path / "b.csv"), str(tmp_path / "a.json")]
    assert got(read_reports(spark, paths, "id", "text")) == {("1", "new"), ("2", "second"), ("3", "c")}
    assert got(read_reports(spark, paths[::-1], "id", "text")) == {("1", "old"), ("2", "second"), ("3", "c")}


def test_other_files_are_refused(spark, tmp_path):
    for path in ("reports.txt", "reports", "a.parquet"):
        with pytest.raises(ValueError):
            read_reports(spark, [path])
    with pytest.raises(ValueError):
        read_reports(spark, [])


def test_catalogs(spark, tmp_path):
    (tmp_path / "c.yaml").write_text(
        'modality: "m"\ncategories:\n  A:\n    description: "about"\n    questions:\n      - question: "Q1?"\n      - question: "Q2?"\n  B:\n    description: b\n'
    )
    catalog = read_catalog(tmp_path / "c.yaml")
    assert catalog.modality == "m" and catalog.questions == ("Q1?", "Q2?")
    assert [tuple(r) for r in categories_frame(spark, catalog).orderBy("ord").collect()] == [("A", "about", 0), ("B", "b", 1)]
    assert [r.question for r in questions_frame(spark, catalog).orderBy("ord").collect()] == ["Q1?", "Q2?"]
    with pytest.raises(ValueError):
        catalog_from_mapping({"modality": "m"})
    assert missing_questions(CONCEPT_QUESTIONS.values(), concept_catalog()) == []
    assert missing_questions(["Q1?", "Q9?"], catalog) == ["Q9?"]


def test_templates_of_a_configuration(tmp_path):
    (tmp_path / "c.yaml").write_text('prompt_templates:\n  findings_question: "{report} {question}"\n')
    templates = read_templates(tmp_path / "c.yaml")
    assert templates["findings_question"] == "{report} {question}" and "{findings}" in templates["map_category_findings"]


def test_stage_tables_and_sheets(spark, tmp_path):
    (tmp_path / "f.csv").write_text('report_id,extra,findings\n01,x,"a\nb"\n')
    assert read_stage_table(spark, "findings", str(tmp_path / "f.csv")).collect() == [("01", "a\nb")]
    with pytest.raises(ValueError):
        read_stage_table(spark, "questions", str(tmp_path / "f.csv"))
    with pytest.raises(ValueError):
        read_stage_table(spark, "other", str(tmp_path / "f.csv"))
    assert read_annotation_sheet(spark, str(tmp_path / "f.csv"), ["extra"]).count() == 1
    (tmp_path / "l.csv").write_text("case_id,fracture,ascites\n1,0,1\n")
    table, concepts = read_label_table(spark, str(tmp_path / "l.csv"))
    assert concepts == ["fracture", "ascites"] and table.first().fracture == "0"
    with pytest.raises(ValueError):
        read_label_table(spark, str(tmp_path / "l.csv"), "other")


def test_response_files_keep_line_order(spark, tmp_path):
    def line(i, text):
        return json.dumps({"custom_id": i, "response": {"body": {"choices": [{"message": {"content": text}}]}}})

    (tmp_path / "r.jsonl").write_text("\n".join([line("a", "old"), "oops", line("b", "x"), line("a", "new"), ""]))
    read = parse_response_lines(read_response_lines(spark, str(tmp_path / "r.jsonl")), "ord")
    assert {tuple(r) for r in read.collect()} == {("a", "new"), ("b", "x")}


def test_results_document(spark, tmp_path):
    content = {"1": {"raw_text": "a", "qa_results": {"A": [{"Q": "Yes"}]}, "processing_time": 2}, "2": {"error": "e", "processing_time": 1.0},
               "3": {"raw_text": "c", "answers": {"A": [{"Q": "No"}]}}}
    (tmp_path / "r.json").write_text(json.dumps(content, indent=2))
    rows = {r.report_id: r for r in read_results_document(spark, str(tmp_path / "r.json")).collect()}
    assert rows["1"].qa_results == {"A": [{"Q": "Yes"}]} and rows["2"].error == "e" and rows["3"].qa_results == {"A": [{"Q": "No"}]}


def test_label_files(spark, tmp_path):
    df = spark.createDataFrame([("1", "Rib fracture. A fracture, \"old\".", "{}")], "report_id string, report_text string, raw_payload string")
    results, names = label_results(df), names_of(None)
    sinks.write_wide_labels(results, names, str(tmp_path / "wide"))
    back = spark.read.csv(str(tmp_path / "wide"), header=True, quote='"', escape='"').first()
    assert back.fracture == "1" and back.evidence_fracture == 'Rib fracture. ||| A fracture, "old".' and len(back) == 61
    sinks.write_nested_labels(results, names, str(tmp_path / "nested"))
    sinks.write_label_lines(results, names, str(tmp_path / "lines"))
    sinks.write_label_lines(results, names, str(tmp_path / "lines"))
    rows = [json.loads(x) for f in (tmp_path / "lines").glob("*.json") for x in f.read_text().splitlines()]
    assert len(rows) == 2 and rows[0]["labels"]["fracture"] == 1 and rows[0]["raw_payload"] == "{}"
    assert rows[0]["evidence"]["fracture"][0] == "Rib fracture." and rows[0]["evidence"]["ascites"] == []


def test_results_file_is_no_larger_than_its_texts(spark, tmp_path):
    """A report's text stands in a result several times; the files are packed, and all of it is read back."""
    texts = [" ".join(f"word{(i * j * 7919) % 9973}" for j in range(1, 400)) for i in range(1, 61)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    folders = set((Path(spark.conf.get("spark.checkpoint.dir")) / "scanledger").glob("results-file-*"))
    rows = results_file(spark, str(tmp_path)).collect()
    (folder,) = set((Path(spark.conf.get("spark.checkpoint.dir")) / "scanledger").glob("results-file-*")) - folders
    assert sum(f.stat().st_size for f in folder.glob("part-*")) < sum(map(len, texts))
    assert {r.report_id: texts[int(r.report_id)] in r.raw_text for r in rows} == {str(i): i % 10 > 0 for i in range(60)}


def test_results_file_moves_no_text_when_read_back(spark, tmp_path):
    """Each row comes once for every row of its id; rows without an id are left out; the texts lie where they were read."""
    rows = [(1, "a b"), (1, "c d"), (20, "e"), (3, None), (None, "f")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = results_file(spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan json") == 1 and "Exchange hashpartitioning" not in plan
    rows = found.collect()
    assert sorted(r.report_id for r in rows) == ["1"] * 4 + ["20", "3"]
    assert {(r.report_id, r.error, r.processing_time is None) for r in rows} == {("1", None, False), ("20", "failed", False), ("3", None, False)}
    assert len({r.raw_text for r in rows if r.report_id == "1"}) == 2
