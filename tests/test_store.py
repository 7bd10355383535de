"""Buckets of the stage store: what a batch reads, what a repeated run adds."""

import re

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from scanledger.plans.stages import answer_stage, retry_stage
from scanledger.sources.catalog import Catalog, Category
from scanledger.sources.store import BUCKET, StageStore, bucket_of
from scanledger.streaming.incremental import distinct_stream, stage_stream, stream_table

FINDINGS = "report_id string, findings string"
REPORTS = "report_id string, report_text string"
CATALOG = Catalog("m", (Category("A", "", ("Q1?", "Q2?")),))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def read_buckets(df):
    """The buckets whose files a plan reads, as its file names and its scan say."""
    files = {r[0] for r in df.select(F.input_file_name()).distinct().collect()}
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {int(re.search(rf"/{BUCKET}=(\d+)/", f).group(1)) for f in files}, plan


@pytest.fixture
def filled(spark, tmp_path):
    store = StageStore(str(tmp_path / "store"), buckets=16)
    store.append("findings", spark.createDataFrame([(str(i), f"f{i}") for i in range(400)], FINDINGS).repartition(5))
    return store


def test_a_batch_reads_its_buckets(spark, filled):
    batch = spark.createDataFrame([("7", "x"), ("8", "y"), ("7", "z")], FINDINGS)
    wanted = {r[0] for r in batch.select(bucket_of(16)).distinct().collect()}
    buckets, plan = read_buckets(filled.near(spark, "findings", batch))
    assert buckets == wanted and re.search(rf"PartitionFilters: \[.*{BUCKET}", plan)
    known = rows(filled.near(spark, "findings", batch))
    assert ("7", "f7") in known and len(known) < 100
    # An append and a resume read through it.
    new = filled.new_rows("findings", spark.createDataFrame([("7", "new"), ("new", "n")], FINDINGS))
    assert rows(new) == [("new", "n")]
    assert read_buckets(filled.load(spark, "findings"))[0] == set(range(16))


def test_rows_lie_in_their_bucket(spark, filled):
    stored = spark.read.parquet(f"{filled.location('findings')}/rows")
    assert stored.filter(bucket_of(16) != F.col(BUCKET)).count() == 0 and stored.count() == 400


def test_the_number_of_buckets_is_kept(spark, filled):
    other = StageStore(filled.path, buckets=3)
    assert other.layout(spark, "findings") == 16
    other.append("findings", spark.createDataFrame([("7", "again"), ("new", "n")], FINDINGS))
    found = dict(rows(filled.load(spark, "findings")))
    assert len(found) == 401 and found["7"] == "f7" and found["new"] == "n"


def test_appends_of_nothing_and_of_missing_ids(spark, tmp_path):
    store = StageStore(str(tmp_path / "store"))
    assert store.load(spark, "findings") is None and store.near(spark, "findings", spark.createDataFrame([], FINDINGS)) is None
    store.append("findings", spark.createDataFrame([], FINDINGS))
    store.append("findings", spark.createDataFrame([(None, "a"), ("1", None)], FINDINGS))
    store.append("findings", spark.createDataFrame([], FINDINGS))
    assert store.load(spark, "findings").count() == 2
    store.overwrite("findings", spark.createDataFrame([("2", "b"), ("2", "b")], FINDINGS))
    assert rows(store.load(spark, "findings")) == [("2", "b")]
    with pytest.raises(ValueError):
        store.location("other")


def test_a_stage_is_resumed_from_its_buckets(spark, tmp_path):
    store = StageStore(str(tmp_path / "store"), buckets=8)
    frame = spark.createDataFrame([(str(i), f"report {i}") for i in range(6)], REPORTS)

    def yes_to_first(prompts):
        return ["Yes" if "Q1?" in p else "" for p in prompts]

    answer_stage(spark, "questions", frame, store, yes_to_first, CATALOG, run="first")
    assert store.load(spark, "questions").count() == 6
    assert {r.content for r in store.rejected(spark, "questions").collect()} == {""}
    assert store.still_open(spark, "questions").count() == 6
    retry_stage(spark, "questions", frame.filter("report_id < '3'"), store, lambda prompts: ["No"] * len(prompts), CATALOG)
    answers = {(r.report_id, r.question): r.answer for r in store.load(spark, "questions").collect()}
    assert answers == {(str(i), "Q1?"): "Yes" for i in range(6)} | {(str(i), "Q2?"): "No" for i in range(3)}
    assert store.still_open(spark, "questions").count() == 3
    # The same run again replaces its rejections and adds nothing.
    answer_stage(spark, "questions", frame, store, yes_to_first, CATALOG, run="first")
    assert store.rejected(spark, "questions").count() == 3 and store.load(spark, "questions").count() == 9


def test_batches_break_off_and_go_on(spark, tmp_path):
    class Breaks(StageStore):
        left = [True]

        def append(self, stage, new):
            if self.left and self.load(self_spark, stage) is not None:
                self.left.pop()
                raise RuntimeError("lost")
            super().append(stage, new)

    self_spark = spark
    store = Breaks(str(tmp_path / "store"), buckets=4)
    spark.createDataFrame([(str(i), f"report {i}") for i in range(40)], REPORTS).repartition(4).write.parquet(str(tmp_path / "in"))

    def run():
        arriving = stream_table(spark, str(tmp_path / "in"), REPORTS, files_per_trigger=1)
        answered = lambda prompts: ["Yes" if "Q1?" in p else " " for p in prompts]
        stage_stream(arriving, "questions", store, answered, str(tmp_path / "mark"), CATALOG).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    before = store.load(spark, "questions").count()
    run()
    assert 0 < before < 40 and store.load(spark, "questions").count() == 40
    refused = store.rejected(spark, "questions")
    assert refused.count() == 40 and refused.select("run").distinct().count() == 4


def test_keys_are_remembered_over_restarts(spark, tmp_path):
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    first = spark.createDataFrame([("1", "a"), ("2", "b"), ("1", "a")], FINDINGS)
    late = spark.createDataFrame([("2", "late"), ("3", "c")], FINDINGS)

    def run():
        distinct_stream(stream_table(spark, folder, FINDINGS), "findings", out, mark).awaitTermination()
        return rows(spark.read.schema(FINDINGS).parquet(out))

    first.write.parquet(folder)
    assert run() == [("1", "a"), ("2", "b")]
    first.write.mode("append").parquet(folder)
    late.write.mode("append").parquet(folder)
    assert run() == [("1", "a"), ("2", "b"), ("3", "c")]
    assert run() == [("1", "a"), ("2", "b"), ("3", "c")]


def test_late_keys_within_a_bound(spark, tmp_path):
    timed = spark.createDataFrame([("1", "a", "2024-01-01 00:00:00"), ("1", "b", "2024-01-01 00:01:00"), ("2", "c", "2024-01-01 00:02:00")], "report_id string, findings string, at string")
    timed.selectExpr("report_id", "findings", "to_timestamp(at) AS at").coalesce(1).write.parquet(str(tmp_path / "in"))
    arriving = stream_table(spark, str(tmp_path / "in"), "report_id string, findings string, at timestamp")
    distinct_stream(arriving, "findings", str(tmp_path / "out"), str(tmp_path / "mark"), "at", "1 hour").awaitTermination()
    assert [r.report_id for r in spark.read.parquet(str(tmp_path / "out")).orderBy("report_id").collect()] == ["1", "2"]


@pytest.mark.parametrize("name", ["plain", "a]", "b[1", "c{d,e}", "x^", "sp ace"])
def test_any_folder_name_is_a_stream(spark, tmp_path, name):
    path = str(tmp_path / name)
    spark.createDataFrame([("1", "a")], FINDINGS).write.parquet(path)
    distinct_stream(stream_table(spark, path, FINDINGS), "findings", str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [("1", "a")]
