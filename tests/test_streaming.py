from scanledger.operators.labels import label_concepts
from scanledger.plans.derived import reports as derived_reports
from scanledger.sources.catalog import Catalog, Category
from scanledger.sources.store import StageStore
from scanledger.streaming.incremental import append_stream, label_stream, stage_stream, stream_table

SCHEMA = "report_id STRING, report_text STRING"


def test_streamed_labels_equal_the_batch(spark, sf_dir, tmp_path):
    reports = derived_reports(spark, sf_dir)
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    reports.filter("report_id % 2 = 0").repartition(3).write.parquet(folder)
    label_stream(stream_table(spark, folder, SCHEMA, files_per_trigger=1), out, mark).awaitTermination()
    reports.filter("report_id % 2 = 1").write.mode("append").parquet(folder)
    # The second run labels only what arrived since.
    query = label_stream(stream_table(spark, folder, SCHEMA, files_per_trigger=1), out, mark)
    query.awaitTermination()
    written, batch = spark.read.parquet(out), label_concepts(reports)
    assert written.exceptAll(batch).count() == 0 and written.count() == batch.count()


def test_streamed_rows_are_stored_once(spark, tmp_path):
    store = StageStore(str(tmp_path / "store"))
    rows = [("1", "a"), ("1", "a"), ("2", "b")]
    spark.createDataFrame(rows, "report_id string, findings string").write.parquet(str(tmp_path / "in"))
    for mark in ("m1", "m2"):
        stream = stream_table(spark, str(tmp_path / "in"), "report_id STRING, findings STRING", files_per_trigger=1)
        append_stream(stream, "findings", store, str(tmp_path / mark)).awaitTermination()
    assert sorted(tuple(r) for r in store.load(spark, "findings").collect()) == [("1", "a"), ("2", "b")]


def test_failed_answers_come_back(spark, tmp_path):
    catalog = Catalog("m", (Category("A", "", ("Q1?", "Q2?")),))
    store = StageStore(str(tmp_path / "store"))
    frame = spark.createDataFrame([(str(i), f"report {i}") for i in range(6)], SCHEMA)
    frame.repartition(3).write.parquet(str(tmp_path / "in"))

    def half(prompts):
        if any("Q2?" in p for p in prompts):
            raise RuntimeError("down")
        return ["Yes"] * len(prompts)

    def run(responder, mark):
        stream = stream_table(spark, str(tmp_path / "in"), SCHEMA, files_per_trigger=2)
        stage_stream(stream, "questions", store, responder, str(tmp_path / mark), catalog).awaitTermination()
        return {(r.report_id, r.question): r.answer for r in store.load(spark, "questions").collect()}

    assert run(half, "m1") == {(str(i), "Q1?"): "Yes" for i in range(6)}
    after = run(lambda prompts: ["No"] * len(prompts), "m2")
    assert after == {(str(i), q): a for i in range(6) for q, a in (("Q1?", "Yes"), ("Q2?", "No"))}
    assert store.load(spark, "questions").count() == 12
