import json

import pytest
from pyspark.sql import functions as F

from scanledger.operators import combine
from scanledger.operators.requests import build_requests
from scanledger.plans.completion import PROMPT_BYTES, complete
from scanledger.plans.stages import check_stage_inputs, ordered_stages, run_stages
from scanledger.sources import sinks
from scanledger.sources.catalog import Catalog, Category
from scanledger.sources.store import StageStore
from scanledger.sources.tables import read_results

CATALOG = Catalog("t", (Category("A b", "about a", ("Q1?", "Q2?")), Category("C", "about c", ("Q1?",))))


def reports_of(spark, *texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "report_id string, report_text string")


def test_requests_and_resume(spark):
    reports = reports_of(spark, "text {question}", "other")
    asked = build_requests("questions", reports, CATALOG)
    assert asked.count() == 6
    done = asked.filter("report_id = '0' AND category = 'C'").select("report_id", "category", "question_id")
    rest = build_requests("questions", reports, CATALOG, done)
    keys = {(r.report_id, r.category, r.question) for r in rest.collect()}
    assert keys == {("0", "A b", "Q1?"), ("0", "A b", "Q2?"), ("1", "A b", "Q1?"), ("1", "A b", "Q2?"), ("1", "C", "Q1?")}
    first = asked.filter("report_id = '0' AND category = 'C'").first()
    assert "text {question}" in first.prompt and first.prompt.rstrip().endswith("Q1? Answer Yes or No only.")


def test_resume_moves_texts_once_per_report(spark):
    reports = reports_of(spark, "a", "b")
    done = build_requests("questions", reports, CATALOG).select("report_id", "category", "question_id").limit(2)
    plan = build_requests("questions", reports, CATALOG, done)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate inline") < plan.index("Join LeftOuter") and "LeftAnti" not in plan


def test_resume_with_a_large_catalog(spark):
    """Every finished entry is left out, one that the catalog lacks does no harm."""
    catalog = Catalog("big", tuple(Category(f"c{i}", "d", tuple(f"q{j}?" for j in range(20))) for i in range(12)))
    reports = reports_of(spark, "a", "b", "c")
    asked = build_requests("questions", reports, catalog).select("report_id", "category", "question_id")
    done = asked.filter("hash(report_id, category, question_id) % 3 = 0 OR report_id = '2'")
    gone = spark.createDataFrame([("0", "other", "x"), ("9", "c1", None)], "report_id string, category string, question_id string")
    rest = build_requests("questions", reports, catalog, done.unionByName(done).unionByName(gone)).select(*asked.columns)
    want = {tuple(r) for r in asked.subtract(done).collect()}
    got = [tuple(r) for r in rest.collect()]
    assert len(got) == len(want) < 480 and set(got) == want


def test_empty_findings_are_not_asked(spark):
    rows = [("1", "No such section"), ("2", " "), ("3", None), ("4", "NO FINDINGS SECTION "), ("5", "text")]
    findings = spark.createDataFrame(rows, "report_id string, findings string")
    assert {r.report_id for r in build_requests("category_findings", findings, CATALOG).collect()} == {"5"}


def test_stage_names_and_inputs():
    assert ordered_stages(["map-categories", "remove-comparisons"]) == ["remove-comparisons", "map-categories"]
    assert len(ordered_stages(["all"])) == 4
    with pytest.raises(ValueError):
        ordered_stages(["other"])
    check_stage_inputs(["all"], {"reports"})
    check_stage_inputs(["map-categories"], {"findings"})
    for stages, available in (
        (["all"], ()), (["extract-findings"], {"reports"}), (["map-categories"], ()), (["process-questions"], {"findings"}),
    ):
        with pytest.raises(ValueError):
            check_stage_inputs(stages, available)
    with pytest.raises(ValueError):
        build_requests("questions", None, None)


def test_store_appends_each_key_once(spark, tmp_path):
    store = StageStore(str(tmp_path))
    assert store.load(spark, "findings") is None
    rows = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c")], "report_id string, findings string")
    store.append("findings", rows)
    store.append("findings", rows)
    store.append("findings", spark.createDataFrame([("2", "new"), ("3", "d")], "report_id string, findings string"))
    assert {tuple(r) for r in store.load(spark, "findings").collect()} == {("1", "b"), ("2", "c"), ("3", "d")}
    assert store.load(spark, "findings").count() == 3
    assert store.integrity(spark, "findings").first().n_duplicate_ids == 0
    store.overwrite("findings", rows.filter("report_id = '2'"))
    assert store.load(spark, "findings").count() == 1
    with pytest.raises(ValueError):
        store.load(spark, "other")


def test_keys_that_look_alike_when_joined(spark, tmp_path):
    """a_b + c and a + b_c are different rows."""
    store = StageStore(str(tmp_path))
    kind = "report_id string, category string, findings string"
    store.append("category_findings", spark.createDataFrame([("a_b", "c", "x")], kind))
    store.append("category_findings", spark.createDataFrame([("a", "b_c", "y")], kind))
    assert store.load(spark, "category_findings").count() == 2


def test_nesting_there_and_back(spark):
    rows = [("1", "A", "q2", "Two?", "yes"), ("1", "A", "q1", "One?", "no"), ("1", "B", "q1", "One?", ""), ("2", "A", "q1", "One?", "x")]
    df = spark.createDataFrame(rows, "report_id string, category string, question_id string, question string, answer string")
    nested = combine.nest_questions(df)
    assert {r.report_id: r.qa_results for r in nested.collect()} == {
        "1": {"A": [{"One?": "no"}, {"Two?": "yes"}], "B": [{"One?": ""}]}, "2": {"A": [{"One?": "x"}]},
    }
    flat = {(r.report_id, r.category, r.question, r.answer) for r in combine.flatten_questions(nested).collect()}
    assert flat == {(r[0], r[1], r[3], r[4]) for r in rows}
    cats = df.selectExpr("report_id", "category", "max(answer) OVER (PARTITION BY report_id, category) AS findings").distinct()
    again = combine.flatten_categories(combine.nest_categories(cats))
    assert again.exceptAll(cats).count() == 0 and again.count() == cats.count()


def test_a_report_repeated_without_bound_is_reduced_before_it_is_nested(spark):
    rows = spark.range(20_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 50 AS STRING) END AS report_id", "CAST(id % 4 AS STRING) AS category",
        "CAST(id AS STRING) AS findings",
    )
    nested = {r.report_id: r.category_findings for r in combine.nest_categories(rows.repartition(8)).collect()}
    assert set(nested["hot"]) == {"0", "1", "2", "3"} and len(nested) == 51
    plan = combine.nest_categories(rows)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_combining(spark):
    reports = reports_of(spark, "a", "b")
    findings = spark.createDataFrame([("1", "f"), ("9", "g")], "report_id string, findings string")
    rows = {r.report_id: r for r in combine.combine_stages(reports, findings=findings).collect()}
    assert set(rows) == {"0", "1"} and rows["1"].findings_text == "f" and rows["0"].findings_text == ""
    assert rows["0"].category_findings == {} and rows["0"].qa_results == {} and rows["0"].raw_text == "a"
    without = {r.report_id: r for r in combine.combine_stages(None, findings=findings).collect()}
    assert set(without) == {"1", "9"} and without["9"].raw_text == ""
    with pytest.raises(ValueError):
        combine.combine_stages(None)


def test_final_results_file(spark, tmp_path):
    combined = combine.combine_stages(reports_of(spark, "a", "b"), processing_time=1.5)
    failed = combined.withColumn("error", F.when(F.col("report_id") == "1", "broken"))
    sinks.write_final_results(failed, str(tmp_path / "out"))
    lines = [json.loads(line) for f in (tmp_path / "out").glob("*.json") for line in f.read_text().splitlines()]
    by_id = {r["report_id"]: r for r in lines}
    assert by_id["1"] == {"report_id": "1", "error": "broken", "processing_time": 1.5}
    assert by_id["0"] == {
        "report_id": "0", "raw_text": "a", "no_comparison_text": "", "findings_text": "", "category_findings": {}, "qa_results": {}, "processing_time": 1.5,
    }
    back = {r.report_id: r for r in read_results(spark, str(tmp_path / "out")).collect()}
    assert back["0"].raw_text == "a" and back["1"].error == "broken"


def test_completion_survives_failures(spark):
    def fragile(prompts):
        if any("bad" in p for p in prompts):
            raise RuntimeError("no answer")
        return [p.upper() for p in prompts]

    asked = spark.createDataFrame([("1", "a"), ("2", "bad"), ("3", "c")], "request_id string, prompt string").coalesce(1)
    assert {tuple(r) for r in complete(asked, fragile).collect()} == {("1", "A"), ("2", ""), ("3", "C")}
    short = complete(asked, lambda prompts: ["only one"] if len(prompts) == 1 else [])
    assert {r.content for r in short.collect()} == {"only one"}


def test_responder_is_given_a_bounded_amount_of_text(spark):
    """However many rows an Arrow batch has, prompts come some megabytes at a time, whole and in order."""
    asked = spark.range(0, 300, 1, 1).selectExpr("id", "CASE WHEN id <> 7 THEN repeat(id, 20000) END AS prompt")

    def weigh(prompts):
        most = sum(len(p or "") for p in prompts)
        return [f"{most} {len(p)} {p[:3]}" for p in prompts]

    found = {r["id"]: r["content"] for r in complete(asked, weigh).collect()}
    assert set(found) == set(range(300)) and found[7] == ""
    rows = {i: c.split() for i, c in found.items() if i != 7}
    assert all(int(n) == 20000 * len(str(i)) and start == (str(i) * 3)[:3] for i, (_, n, start) in rows.items())
    assert max(int(most) for most, _, _ in rows.values()) <= PROMPT_BYTES


def test_running_twice_asks_only_what_is_open(spark, tmp_path):
    store = StageStore(str(tmp_path))
    reports = reports_of(spark, "first report", "second report")

    def first(prompts):
        return ["" if "Q2?" in p and "second" in p else "Yes" for p in prompts]

    def second(prompts):
        return ["Later" for _ in prompts]

    run_stages(spark, ["process-questions"], store, first, reports, CATALOG)
    assert store.load(spark, "questions").count() == 5
    final = run_stages(spark, ["process-questions"], store, second, reports, CATALOG)
    answers = {(r.report_id, r.question): r.answer for r in store.load(spark, "questions").collect()}
    assert answers[("1", "Q2?")] == "Later" and answers[("1", "Q1?")] == "Yes" and store.load(spark, "questions").count() == 6
    assert {r.report_id: len(r.qa_results["A b"]) for r in final.collect()} == {"0": 2, "1": 2}


def test_all_stages(spark, tmp_path):
    def echo(prompts):
        return ["No such section" if "This is a radiology report" in p and "second" in p else "text" for p in prompts]

    final = run_stages(spark, ["all"], StageStore(str(tmp_path)), echo, reports_of(spark, "first", "second"), CATALOG)
    rows = {r.report_id: r for r in final.collect()}
    assert rows["0"].category_findings == {"A b": "text", "C": "text"}
    # Each stage reads what the one before stored: both texts became "text".
    assert rows["1"].findings_text == "text" and rows["1"].raw_text == "second"
