import math
import random

import pytest
from pyspark.sql import functions as F

from scanledger.operators import metrics
from scanledger.plans import queries
from scanledger.sources import sinks
from scanledger.sources.catalog import questions_frame, read_catalog
from scanledger.sources.tables import read_label_table
from tests.brute import same

NAN = float("nan")
NOTES = ["yes", "No", "1", "0", "TRUE", "wrong", "maybe", "", None, "2"]


def pairs_frame(spark, rows):
    """(case, concept, gt, pred) rows as cases with pairs."""
    df = spark.createDataFrame(rows, "case_id string, concept string, gt int, pred int")
    return df.groupBy("case_id").agg(F.collect_list(F.struct("concept", "gt", "pred")).alias("pairs"))


def counted(tp, fp, tn, fn, extra=()):
    rows = [("c", 1, 1)] * tp + [("c", 0, 1)] * fp + [("c", 0, 0)] * tn + [("c", 1, 0)] * fn + [("c", *e) for e in extra]
    return [(str(i), *r) for i, r in enumerate(rows)]


@pytest.mark.parametrize(
    "counts, coverage, evaluable",
    [
        ((0, 1, 0, 1), {"precision_ppv": 0.0, "recall_sensitivity": 0.0, "f1": NAN}, {"precision_ppv": 0.0, "f1": 0.0}),
        ((0, 0, 2, 0), {"precision_ppv": NAN, "recall_sensitivity": NAN, "f1": NAN, "accuracy": 1.0}, {"f1": NAN, "accuracy": 1.0}),
        ((2, 1, 1, 0), {"precision_ppv": 2 / 3, "accuracy": 3 / 5, "coverage": 4 / 5, "n_no_pred": 1}, {"n_eval": 4, "accuracy": 3 / 4}),
    ],
)
def test_concept_conventions(spark, counts, coverage, evaluable):
    extra = [(1, None)] if sum(counts) == 4 else []
    cases = pairs_frame(spark, counted(*counts, extra=extra))
    row = metrics.coverage_metrics(cases, ["c", "never"]).filter("disease = 'c'").first().asDict()
    assert all(same(row[k], v) for k, v in coverage.items()), row
    none = metrics.coverage_metrics(cases, ["c", "never"]).filter("disease = 'never'").first()
    assert none.n_labeled == 0 and math.isnan(none.accuracy) and math.isnan(none.coverage)
    row = metrics.evaluable_metrics(cases).first().asDict()
    assert all(same(row[k], v) for k, v in evaluable.items()), row


def test_against_counting(spark):
    rng = random.Random(3)
    rows = [
        (str(case), c, rng.choice([0, 1, 1, None]), rng.choice([0, 1, None]))
        for case in range(300)
        for c in ("a", "b", "hot")
        for _ in range(1)
    ]
    cases = pairs_frame(spark, rows)
    got = {r.disease: r for r in metrics.coverage_metrics(cases, ["a", "b", "hot"]).collect()}
    for c in ("a", "b", "hot"):
        labeled = [r for r in rows if r[1] == c and r[2] is not None]
        assert got[c].n_labeled == len(labeled)
        assert got[c].n_predicted_yesno == sum(r[3] is not None for r in labeled)
        assert same(got[c].accuracy, sum(r[2] == r[3] for r in labeled) / len(labeled))
    overall = metrics.coverage_overall(cases).first()
    every = [r for r in rows if r[2] is not None]
    assert overall.total_labeled == len(every) and same(overall.accuracy, sum(r[2] == r[3] for r in every) / len(every))
    per_case = {r.case_id: r for r in metrics.case_accuracy(cases).collect()}
    assert overall.cases_with_predictions == len(per_case) == len({r[0] for r in every})
    assert per_case["7"].n_correct == sum(r[2] is not None and r[2] == r[3] for r in rows if r[0] == "7")
    both = [r for r in rows if r[2] is not None and r[3] is not None]
    total = metrics.evaluable_overall(cases).first()
    assert total.total_eval == len(both) and same(total.accuracy, sum(r[2] == r[3] for r in both) / len(both))
    assert total.matched_cases == 300


def test_labels_beside_answers(spark):
    labels = spark.createDataFrame(
        [("1", "1", "0"), ("2", "x", "1.0"), ("3", "1", "1"), ("4", "0", None)], "case_id string, fracture string, ascites string"
    )
    results = spark.createDataFrame(
        [
            ("1", {"A": [{"Is there a fracture?": "No"}], "B": [{"Is there a fracture?": "Yes."}, {"Is there ascites?": "Yes and no"}]}),
            ("2", {"A": [{"Is there ascites?": "yes"}]}),
            ("4", None),
        ],
        "report_id string, qa_results map<string,array<map<string,string>>>",
    )
    cases = metrics.answered_cases(labels, results, ["fracture", "ascites"])
    got = {r.case_id: [(p.concept, p.gt, p.pred) for p in r.pairs] for r in cases.collect()}
    assert got == {
        "1": [("fracture", 1, 1), ("ascites", 0, None)],
        "2": [("fracture", None, None), ("ascites", 1, 1)],
        "4": [("fracture", 0, None), ("ascites", None, None)],
    }
    with pytest.raises(ValueError):
        metrics.answered_cases(labels, results, ["unknown"])


def test_labels_beside_predictions(spark):
    labels = spark.createDataFrame([("1", 1.0), ("2", -1.0), ("9", 0.0)], "case_id string, fracture double")
    predictions = spark.createDataFrame([("1", 1), ("2", 0)], "report_id string, fracture int")
    cases = metrics.predicted_cases(labels, predictions, ["fracture"])
    assert {r.case_id: tuple(r.pairs[0]) for r in cases.collect()} == {"1": ("fracture", 1, 1), "2": ("fracture", None, 0)}
    metrics.require_matches(cases)
    with pytest.raises(ValueError):
        metrics.require_matches(cases.filter("case_id = 'none'"))
    with pytest.raises(ValueError):
        metrics.predicted_cases(labels, predictions, ["ascites"])


def binary(value, numbers):
    if value is None or value == "":
        return None
    if numbers:
        return int(float(value) > 0)
    return {"yes": 1, "true": 1, "1": 1, "no": 0, "0": 0, "wrong": 0}.get(value.lower())


def test_question_sheet_against_counting(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["q a/b?", "hot?", "hot?", "solo"]), rng.choice(["0", "1"]), rng.choice(NOTES)) for _ in range(400)]
    rows = [(q, p, "maybe" if q == "solo" else h) for q, p, h in rows]
    sheet = spark.createDataFrame(rows, "question string, predicted_label string, human_label string")
    got = {(r.question if not r.is_total else "TOTAL"): r for r in metrics.eval_questions(sheet).collect()}
    filled = [r for r in rows if r[2]]
    for name in ("q a/b?", "hot?", "solo", "TOTAL"):
        mine = [r for r in filled if name in ("TOTAL", r[0])]
        pairs = [(binary(h, False), int(p)) for _, p, h in mine if binary(h, False) is not None]
        tp, fp = pairs.count((1, 1)), pairs.count((0, 1))
        tn, fn = pairs.count((0, 0)), pairs.count((1, 0))
        r = got[name]
        assert (r.tp, r.fp, r.tn, r.fn, r.n_samples) == (tp, fp, tn, fn, len(mine))
        if not pairs:
            assert math.isnan(r.accuracy) and math.isnan(r.f1_score) and r.npv is None
            continue
        p = tp / (tp + fp) if tp + fp else 0
        q = tp / (tp + fn) if tp + fn else 0
        assert same(r.accuracy, (tp + tn) / len(pairs)) and same(r.precision, float(p)) and same(r.recall, float(q))
        assert same(r.f1_score, float(2 * p * q / (p + q)) if p + q else 0.0)
    assert got["TOTAL"].n_unique_questions == 3


def test_a_column_of_numbers_is_read_by_sign(spark):
    rows = [("0.5",), ("0",), ("-2",), ("3",), ("",), ("NA",)]
    numbers = spark.createDataFrame(rows, "no_comparison_correct string").withColumn("findings_correct", F.lit(None).cast("string"))
    got = {r.task: r for r in metrics.eval_findings_sheet(numbers).collect()}
    assert (got["no_comparisons"].accuracy, got["no_comparisons"].n_annotated, got["no_comparisons"].n_samples) == (0.5, 4, 6)
    assert got["findings"].accuracy is None and got["findings"].n_annotated == 0
    mixed = spark.createDataFrame([*rows, ("maybe",)], "c string")
    row = metrics.eval_correctness(mixed, "c", "t").first()
    assert (row.accuracy, row.n_annotated) == (0.0, 1)


def test_tasks_below_a_threshold(spark, tmp_path):
    sheet = spark.createDataFrame([("A", "yes"), ("A", "no"), ("B", "yes"), ("C", "")], "category string, correct string")
    findings = spark.createDataFrame([("yes", "")], "no_comparison_correct string, findings_correct string")
    questions = spark.createDataFrame(
        [("Q a/b?", "1", "1"), ("Q a/b?", "1", "maybe"), ("R?", "0", "yes"), ("S?", "0", "maybe")], "question string, predicted_label string, human_label string"
    )
    tasks = metrics.evaluation_tasks(
        metrics.eval_findings_sheet(findings), metrics.eval_categories(sheet), metrics.eval_questions(questions)
    )
    low = {(r.qc_type, r.task_name): r for r in metrics.imperfect_tasks(tasks).collect()}
    # No accuracy counts as 0, NaN is not below, a perfect task is not listed.
    assert set(low) == {
        ("findings", "findings"), ("categories", "A"), ("categories", "C"), ("questions_consolidated", "All Questions Combined"), ("questions_individual", "R"),
    }
    assert low[("findings", "findings")].evaluation_type == "unknown" and low[("findings", "findings")].n_samples == 0
    assert low[("categories", "A")].accuracy_percent == 50.0 and low[("questions_individual", "R")].question_text == "R?"
    assert low[("questions_consolidated", "All Questions Combined")].question_text == "ALL_QUESTIONS_COMBINED"
    assert {r.qc_type: r.n for r in metrics.tasks_by_type(metrics.imperfect_tasks(tasks)).collect()}["categories"] == 2
    sinks.write_imperfect(metrics.imperfect_tasks(tasks), str(tmp_path / "low"))
    written = spark.read.csv(str(tmp_path / "low"), header=True)
    assert written.columns == list(sinks.IMPERFECT_COLUMNS)
    shares = [float(r.accuracy) for r in written.collect()]
    assert shares == sorted(shares)


def test_metric_files(spark, tmp_path):
    cases = pairs_frame(spark, counted(1, 1, 1, 1))
    sinks.write_case_table(metrics.case_accuracy(cases), str(tmp_path / "cases"))
    sinks.write_metric_table(metrics.evaluable_metrics(cases), "n_eval", str(tmp_path / "table"))
    sinks.write_metrics(metrics.coverage_metrics(cases, ["c"]), str(tmp_path / "metrics"))
    sinks.write_sheet(cases.select("case_id"), str(tmp_path / "sheet"))
    assert spark.read.csv(str(tmp_path / "cases"), header=True).count() == 4
    assert spark.read.json(str(tmp_path / "metrics")).first().tp == 1


def test_worst_first(spark):
    df = spark.createDataFrame([("a", NAN, 9), ("b", 0.5, 1), ("c", 0.5, 3), ("d", 0.0, 1)], "disease string, f1 double, n int")
    assert [r.disease for r in metrics.worst_first(df, "n").collect()] == ["d", "c", "b", "a"]


def test_unmatched_keys(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",)], "q string")
    right = spark.createDataFrame([("b",)], "q string")
    assert [r.q for r in metrics.unmatched(left, right, ["q"]).collect()] == ["a"]


def test_repeated_cases_count_once(spark):
    rows = [("1", "a", 1, 1), ("1", "b", None, 0), ("2", "a", None, 1), ("2", "b", None, None), ("3", "a", 0, 1), ("3", "b", 1, 1)]
    cases = pairs_frame(spark, rows)
    twice = cases.unionByName(cases.filter("case_id = '1'")).unionByName(cases.filter("case_id = '1'"))
    total = metrics.evaluable_overall(twice).first()
    assert (total.total_eval, total.tp, total.fp, total.matched_cases) == (5, 4, 1, 3)
    covered = metrics.coverage_overall(twice).first()
    assert (covered.total_labeled, covered.total_predicted_yesno, covered.cases_with_predictions) == (5, 5, 2)
    none = metrics.evaluable_overall(cases.filter("false")).first()
    assert none.matched_cases == 0 and none.total_eval is None and metrics.coverage_overall(cases.filter("false")).first().cases_with_predictions == 0


def document_scans(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum("Relation" in line and "text#" in line for line in plan.splitlines())


def test_totals_read_the_documents_once(spark, sf_dir):
    assert document_scans(queries._predicted_cases(spark, sf_dir)) == document_scans(queries.evaluable_overall(spark, sf_dir)) == 1
    assert document_scans(queries._answered_cases(spark, sf_dir)) == document_scans(queries.coverage_overall(spark, sf_dir))


def test_drift_of_each_kind(spark, tmp_path):
    (tmp_path / "c.yaml").write_text(
        'modality: m\ncategories:\n  A:\n    description: a\n    questions:\n      - question: "Q1?"\n      - question: "Q2?"\n      - question: "Unmapped?"\n'
    )
    (tmp_path / "labels.csv").write_text("case_id,one,two,unknown\n1,0,1,1\n")
    catalog = questions_frame(spark, read_catalog(tmp_path / "c.yaml"))
    mapping = metrics.question_mapping(spark, {"one": "Q1?", "two": "Q2?", "three": "Q9?"})
    labelled = metrics.label_columns(read_label_table(spark, str(tmp_path / "labels.csv"))[0])
    found = {tuple(r) for r in metrics.drift(catalog, mapping, labelled).collect()}
    assert found == {
        ("question not in catalog", "Q9?"),
        ("question not mapped", "Unmapped?"),
        ("concept not mapped", "unknown"),
        ("concept without labels", "three"),
    }
    assert metrics.drift(catalog.limit(0), mapping.limit(0), labelled.limit(0)).count() == 0
    assert metrics.question_mapping(spark).count() == len(metrics.CONCEPT_QUESTIONS)
