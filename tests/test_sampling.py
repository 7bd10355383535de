import hashlib

import pytest
from pyspark.sql import functions as F

from scanledger.operators import sampling
from scanledger.sources import sinks
from scanledger.sources.catalog import Catalog, Category, sample_catalog
from scanledger.sources.tables import parse_typed_answers
from tests.brute import order_key


def skewed(spark, n=20_000):
    """A third of all rows in one stratum."""
    return spark.range(n).selectExpr(
        "CAST(id AS STRING) AS report_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CONCAT('s', id % 40) END AS stratum"
    )


@pytest.mark.parametrize("n", [0, 1, 37, 4999, 20_000, 30_000])
def test_lowest_is_exact(spark, n):
    df = skewed(spark).select("report_id").repartition(7)
    got = [r.report_id for r in sampling.sample_reports(df, n, seed=7).collect()]
    want = sorted(map(str, range(20_000)), key=lambda i: order_key(7, i))[:n]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("n", [1, 10, 300])
def test_lowest_per_stratum_is_exact(spark, n):
    got = sampling.take_lowest(skewed(spark).repartition(5), n, 3, ["report_id"], ["stratum"]).collect()
    groups = {}
    for i in range(20_000):
        groups.setdefault("hot" if i % 3 == 0 else f"s{i % 40}", []).append(str(i))
    want = {(i, s) for s, ids in groups.items() for i in sorted(ids, key=lambda i: order_key(3, i))[:n]}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_pieces_are_filtered_before_rows_are_dealt(spark):
    """Without automatic broadcasts the rows of a hot stratum are still cut where they lie."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        taken = sampling.take_lowest(skewed(spark), 10, 3, ["report_id"], ["stratum"])
        plan = taken._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_only_a_piece_of_the_order_is_ranked(spark):
    """The rows that reach the ranking are few, however many a stratum holds."""
    keyed = sampling._keyed(skewed(spark), 3, ["report_id"])
    histogram = sampling._histogram(keyed, ["stratum"])
    reached = histogram.filter("__before < 10").groupBy("stratum").agg(F.max("__bin").alias("cut"), F.sum("__n").alias("n"))
    assert reached.agg(F.max("n")).first()[0] < 40


def results_of(spark, n=400):
    """Reports whose answers and findings follow from their number."""
    base = spark.range(n).selectExpr("CAST(id AS STRING) AS report_id", "CONCAT('raw ', id) AS raw_text", "id")
    return base.selectExpr(
        "report_id", "raw_text", "CONCAT('nc ', id) AS no_comparison_text", "CONCAT('f ', id) AS findings_text",
        "map('A', IF(id % 4 = 0, 'lesion', 'No relevant findings here'), 'B', IF(id % 100 = 0, 'rare', 'No relevant findings'), "
        "    'C', 'always seen') AS category_findings",
        "map('A', array(map('Q1', IF(id % 5 = 0, 'Yes', 'No')), map('Q2', 'no')), 'B', array(map('Q3', 'maybe'), map('Q4', '1'))) AS qa_results",
    )


def test_findings_sheet(spark):
    rows = sampling.qc_findings(results_of(spark), 25, seed=1).collect()
    assert {r.query_id for r in rows} == set(sorted(map(str, range(400)), key=lambda i: order_key(1, i))[:25])
    assert all(r.findings == f"f {r.query_id}" and r.findings_correct == "" for r in rows)
    assert sampling.qc_findings(results_of(spark, 5), 25, seed=1).count() == 5


def test_category_sheet_quotas(spark):
    rows = sampling.qc_categories(results_of(spark), 10, seed=1).collect()
    none = "No relevant findings"
    counts = {c: [sum(r.category == c and (none in r.category_finding) == k for r in rows) for k in (False, True)] for c in "ABC"}
    # Seven relevant ones where there are as many; four of B, filled up; no refill of C.
    assert counts == {"A": [7, 3], "B": [4, 6], "C": [7, 0]}
    assert len({(r.query_id, r.category) for r in rows}) == len(rows)
    assert all(r.raw_text == f"raw {r.query_id}" for r in rows)


def test_question_sheet(spark):
    rows = sampling.qc_questions(results_of(spark), 51, seed=5).collect()
    positive = [r for r in rows if r.predicted_label == 1]
    assert len(rows) == 51 and len(positive) == 25
    assert {r.question for r in positive} == {"Q1", "Q4"} and {r.question for r in rows if not r.predicted_label} == {"Q1", "Q2"}
    for r in rows:
        yes = r.question == "Q4" or (r.question == "Q1" and int(r.query_id) % 5 == 0)
        assert yes == bool(r.predicted_label) and r.raw_text == f"raw {r.query_id}"
    stats = sampling.qc_statistics(sampling.qc_questions(results_of(spark), 51, seed=5), sampling.question_examples(results_of(spark))).first()
    assert (stats.n_samples, stats.n_positive, stats.n_questions, stats.n_questions_with_both) == (51, 25, 3, 1)


def test_draws_are_even(spark):
    """Questions are equally likely although one has far more examples; draws may repeat."""
    examples = spark.range(3000).selectExpr(
        "CAST(id AS STRING) AS report_id", "'c' AS category", "0 AS ord", "IF(id < 2990, 'big', 'small') AS question", "0 AS label"
    )
    drawn = sampling.draw_questions(examples, 2000, seed=11).groupBy("question").count().collect()
    counts = {r.question: r["count"] for r in drawn}
    # No positive examples, so the 1000 negative draws are all there is.
    assert sum(counts.values()) == 1000 and abs(counts["big"] - 500) < 80
    small = sampling.draw_questions(examples, 2000, seed=11).filter("question = 'small'").groupBy("report_id").count().collect()
    assert len(small) == 10 and min(r["count"] for r in small) > 20


def test_nothing_to_draw(spark):
    empty = results_of(spark, 3).withColumn("qa_results", F.expr("map('A', array(map('Q', 'maybe')))"))
    assert sampling.qc_questions(empty, 10).count() == 0


def test_small_catalogs(spark):
    catalog = Catalog("m", tuple(Category(f"c{i}", "", tuple(f"q{i}-{j}" for j in range(i + 1))) for i in range(6)))
    small = sample_catalog(catalog, categories=3, questions=2, seed=4)
    assert len(small.categories) == 3 and all(len(c.questions) <= 2 for c in small.categories)
    rows = [(c.name, q) for c in catalog.categories for q in c.questions]
    table = spark.createDataFrame(rows, "category string, question string")
    got = {tuple(r) for r in sampling.sample_questions(table, 3, 2, seed=4).collect()}
    assert got == {(c.name, q) for c in small.categories for q in c.questions}


def test_sheet_file_keeps_the_mixed_order(spark, tmp_path):
    sample = sampling.qc_questions(results_of(spark), 20, seed=2)
    order = sampling.mixed_order(2, ["query_id", "question"])
    sinks.write_sheet(sample, str(tmp_path / "sheet"), order)
    written = [r.query_id for r in spark.read.csv(str(tmp_path / "sheet"), header=True).collect()]
    assert written == [r.query_id for r in sampling.shuffled(sample, 2, ["query_id", "question"]).collect()]


def test_sheets_in_mixed_order(spark):
    sheets = sampling.qc_sheets(results_of(spark), 10, 4, 12, seed=2)
    assert set(sheets) == {"combined_findings", "categories", "questions"}
    labels = [r.predicted_label for r in sheets["questions"].collect()]
    assert labels != sorted(labels) and labels != sorted(labels, reverse=True)


def test_pieces_are_divided_again(spark, monkeypatch):
    """The same rows whatever the pieces: by one digit, then two, and by those in use."""
    wide = spark.range(4000).selectExpr("CAST(id AS STRING) AS report_id", "IF(id % 40 = 0, 'rare', 'hot') AS stratum")
    taken = lambda: sorted(tuple(r) for r in sampling.take_lowest(wide, 150, 9, ["report_id"], ["stratum"]).collect())
    examples = wide.selectExpr("report_id", "'c' AS category", "0 AS ord", "stratum AS question", "CAST(report_id AS INT) % 2 AS label")
    drawn = lambda: sorted(tuple(r) for r in sampling.draw_questions(examples, 60, 9).collect())
    first = taken(), drawn()
    monkeypatch.setattr(sampling, "BIN_DIGITS", 1)
    monkeypatch.setattr(sampling, "FINE_DIGITS", 2)
    assert (taken(), drawn()) == first
    keys = sorted((hashlib.md5(f"9:{i}".encode()).hexdigest(), str(i)) for i in range(4000) if i % 40)
    assert {r[0] for r in first[0] if r[1] == "hot"} == {i for _, i in keys[:150]}
    assert sum(r[1] == "rare" for r in first[0]) == 100 and len(first[1]) == 60


def test_typed_answers(spark):
    documents = spark.createDataFrame(
        [("p", '{"1": {"raw_text": "a", "qa_results": {"A": [{"Q": 2}, {"R": 0.0}, {"S": "2"}, {"T": true}, {"U": null}]}}, "2": {"raw_text": "b", "answers": {"A": [{"Q": -1}]}}, "3": {"error": "e"}}')],
        "path string, value string",
    )
    typed = parse_typed_answers(documents)
    found = {(r.report_id, r.question): r.label for r in sampling.question_examples(typed).collect()}
    assert found == {("1", "Q"): 1, ("1", "R"): 0, ("1", "T"): 1, ("2", "Q"): 0}
    sheet = sampling.qc_questions(typed, 20, seed=1).collect()
    assert len(sheet) == 20 and {(r.query_id, r.question, r.predicted_label) for r in sheet} <= {(i, q, n) for (i, q), n in found.items()}
