import json

import pytest
from pyspark.sql import functions as F

from scanledger.functions.completions import completion_or_reasoning, completion_text
from scanledger.operators import responses
from scanledger.operators.enforce import enforce_labels, parse_label_responses, parse_labels
from scanledger.operators.labels import label_results
from scanledger.operators.labels import to_long
from scanledger.operators.lexicon import default_lexicon
from tests import checker

BODIES = [
    ({"choices": [{"message": {"content": "a"}}]}, "a"),
    ({"choices": [{"message": {"content": None}, "text": "t"}]}, ""),
    ({"choices": [{"message": {}, "text": "t"}]}, "t"),
    ({"choices": [{"text": None, "delta": {"content": "d"}}]}, ""),
    ({"choices": [{"delta": {"content": "d"}}]}, "d"),
    ({"choices": [{}], "content": "c"}, ""),
    ({"choices": [], "content": "c"}, "c"),
    ({"choices": {"message": {"content": "o"}}}, "o"),
    ({"choices": {"text": "t"}}, "t"),
    ({"choices": {}, "content": "c"}, ""),
    ({"content": None, "text": "t"}, ""),
    ({"text": "t"}, "t"),
    ({"error": {"code": 1}, "content": "c"}, ""),
    ({"error": "text", "content": "c"}, "c"),
    ({"choices": [{"message": {"content": 5}}]}, "5"),
    ({"choices": [{"message": {"content": 0}}]}, ""),
    ({"choices": [{"message": "odd", "text": "t"}]}, "t"),
    ({}, ""),
]


def test_completion_layouts(spark):
    rows = [(i, json.dumps(b)) for i, (b, _) in enumerate(BODIES)]
    df = spark.createDataFrame(rows, "i int, b string").withColumn("b", F.parse_json("b"))
    got = [r.c for r in df.select("i", completion_text(F.col("b")).alias("c")).orderBy("i").collect()]
    assert got == [expected for _, expected in BODIES]


def test_reasoning_fallback(spark):
    bodies = [
        ({"choices": [{"message": {"content": "a", "reasoning_content": "r"}}]}, "a"),
        ({"choices": [{"message": {"content": "", "reasoning_content": "r"}}]}, "r"),
        ({"choices": [{"message": {"content": None, "reasoning_content": None}}]}, ""),
        ({"choices": []}, ""),
        ({}, ""),
    ]
    df = spark.createDataFrame([(i, json.dumps(b)) for i, (b, _) in enumerate(bodies)], "i int, b string")
    read = df.select("i", completion_or_reasoning(F.parse_json("b")).alias("c")).orderBy("i")
    assert [r.c for r in read.collect()] == [expected for _, expected in bodies]


def line(custom_id, choices):
    return json.dumps({"custom_id": custom_id, "response": {"body": {"choices": choices}}})


LINES = [
    (line("a", [{"message": {"content": "first"}}]), None),
    (line("b", {"message": {"content": "<think>x</think> y</think>  last "}}), ("b", "last")),
    ("not json", None),
    ("", None),
    ('{"response": {}}', None),
    (json.dumps({"custom_id": "c", "error": {"code": 1}}), ("c", "")),
    (line("d", []), ("d", "")),
    (line("e", [{"text": "ignored"}]), ("e", "")),
    (line("f", [{"message": {"content": None}}]), ("f", "")),
    (line("g", [{"message": {"content": ["list"]}}]), None),
    (json.dumps({"custom_id": "h", "response": None}), None),
    (line("a", [{"message": {"content": "second"}}]), ("a", "second")),
    ("[1]", None),
]


def test_response_lines_last_wins(spark):
    df = spark.createDataFrame([(v, i) for i, (v, _) in enumerate(LINES)], "value string, ord int")
    got = {tuple(r) for r in responses.parse_response_lines(df, "ord").collect()}
    assert got == {e for _, e in LINES if e}


def test_one_id_holding_most_lines(spark):
    """The last line wins whatever the order of arrival and the size of a group."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 500)).alias("request_id"),
        F.col("id").cast("string").alias("content"),
        F.col("id").alias("ord"),
    )
    got = {r.request_id: int(r.content) for r in responses.last_per_key(df.repartition(9), ["request_id"], "ord").collect()}
    want = {}
    for i in range(30_000):
        want["hot" if i % 3 == 0 else f"r{i % 500}"] = i
    assert got == want


def test_partial_aggregate_before_the_shuffle(spark):
    df = spark.range(100).select(F.lit("hot").alias("request_id"), F.col("id").cast("string").alias("content"), "id")
    plan = responses.last_per_key(df, ["request_id"], "id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_missing_and_filled(spark):
    asked = spark.createDataFrame([("a",), ("b",)], "request_id string")
    came = spark.createDataFrame([("a", "x")], "request_id string, content string")
    assert [r.request_id for r in responses.missing_requests(asked, came).collect()] == ["b"]
    assert {tuple(r) for r in responses.fill_missing(asked, came).collect()} == {("a", "x"), ("b", "")}
    assert tuple(responses.empty_counts(responses.fill_missing(asked, came)).first()) == (1, 1)


def test_category_maps(spark):
    df = spark.createDataFrame(
        [("1", {"A": "x", "B": "Error"}), ("2", {"A": " ", "B": "failed"}), ("3", {"A": "No findings"})],
        "report_id string, category_findings map<string,string>",
    )
    got = {r.report_id: r.category_findings for r in responses.valid_category_map(df).collect()}
    assert got == {"1": {"A": "x"}, "3": {"A": "No findings"}}


def test_integrity(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "b"), (None, None), (None, None), ("2", None)], "report_id string, x string")
    row = responses.integrity_report(df, ("report_id", "x", "y", "z")).first()
    # A repeated missing id counts as a repeat, as in a pandas duplicate check.
    assert (row.missing_columns, row.n_empty_rows, row.n_duplicate_ids) == ("y,z", 2, 2)
    empty = responses.integrity_report(df.limit(0), ("report_id",)).first()
    assert (empty.n_empty_rows, empty.n_duplicate_ids) == (0, 0)


# --- labels in responses ------------------------------------------------------------------


def read_labels(spark, payloads, concepts=("fracture",)):
    df = spark.createDataFrame([(str(i), json.dumps(p)) for i, p in enumerate(payloads)], "report_id string, p string")
    parsed = to_long(parse_labels(df.withColumn("p", F.parse_json("p")), "p", concepts), concepts)
    return {(int(r.report_id), r.concept): (r.label, r.evidence) for r in parsed.collect()}


LABEL_VALUES = [
    ("1", 1), (2, 0), ("1.0", 0), (None, 0), (1.9, 1), (True, 1), (False, 0), (-1, -1), (-1.5, -1), (-2, 0), (" -1 ", -1),
    ("+1", 1), ("01", 1), ("0_1", 1), ("yes", 0), ([1], 0), ({"a": 1}, 0), (0.5, 0), (1e300, 0), ("", 0), (1, 1), ("11", 0),
]


def test_label_values(spark):
    got = read_labels(spark, [{"labels": {"fracture": v}} for v, _ in LABEL_VALUES])
    assert [got[(i, "fracture")][0] for i in range(len(LABEL_VALUES))] == [e for _, e in LABEL_VALUES]


def test_evidence_values(spark):
    values = [("x", ["x"]), (5, []), (["a", "", " ", "b"], ["a", "b"]), (None, []), ({"a": "b"}, []), ([1, None, True, "q"], ["1", "None", "True", "q"]), (" ", [])]
    got = read_labels(spark, [{"evidence": {"fracture": v}} for v, _ in values])
    assert [got[(i, "fracture")][1] for i in range(len(values))] == [e for _, e in values]


def test_payload_parts_of_another_shape(spark):
    got = read_labels(spark, [{"labels": [1], "evidence": "x"}, {"other": 1}, {"labels": {"fracture": 1}, "evidence": None}])
    assert got == {(0, "fracture"): (0, []), (1, "fracture"): (0, []), (2, "fracture"): (1, [])}


ENFORCED = [
    # text, {concept: (label, evidence)}, expected
    ("Rib fracture.", {"fracture": (1, ["Rib  FRACTURE"])}, {"fracture": (1, ["Rib  FRACTURE"])}),
    ("Rib fracture.", {"fracture": (1, ["hip fracture"])}, {"fracture": (-1, [])}),
    ("Rib fracture.", {"fracture": (1, ["", "r", "i", "b", "f"])}, {"fracture": (1, ["r", "i", "b"])}),
    ("Rib fracture.", {"fracture": (0, ["not there"])}, {"fracture": (0, ["not there"])}),
    ("Calcification noted.", {"coronary_calcification": (1, ["calcification noted"])}, {"coronary_calcification": (-1, [])}),
    ("Coronary calcification.", {"coronary_calcification": (1, ["coronary calcif"])}, {"coronary_calcification": (1, ["coronary calcif"])}),
    ("Coronary calcification.", {"coronary_calcification": (1, [" "])}, {"coronary_calcification": (-1, [])}),
    ("Nothing.", {"renal_cyst": (0, ["a cyst"])}, {"renal_cyst": (1, ["a cyst"])}),
    (
        "Cyst. Likely cyst.",
        {"renal_cyst": (1, ["cyst"]), "renal_hypodensities": (1, ["likely cyst"])},
        {"renal_cyst": (1, ["cyst"]), "renal_hypodensities": (0, [])},
    ),
    (
        "x",
        {"renal_cyst": (0, []), "renal_hypodensities": (-1, ["likely a cyst"])},
        {"renal_cyst": (1, []), "renal_hypodensities": (0, [])},
    ),
    ("History:\nRib fracture.\nImpression:\nClear.", {"fracture": (1, ["rib fracture"])}, {"fracture": (-1, [])}),
]


def test_enforcement(spark):
    concepts = ("fracture", "coronary_calcification", "renal_cyst", "renal_hypodensities")
    kind = "struct<label:int,evidence:array<string>>"
    rows = [(str(i), t, *[given.get(c, (0, [])) for c in concepts]) for i, (t, given, _) in enumerate(ENFORCED)]
    df = spark.createDataFrame(rows, "report_id string, report_text string, " + ", ".join(f"{c} {kind}" for c in concepts))
    got = {(int(r.report_id), r.concept): (r.label, r.evidence) for r in to_long(enforce_labels(df, "report_text", concepts), concepts).collect()}
    for i, (_, _, expected) in enumerate(ENFORCED):
        for concept, result in expected.items():
            assert got[(i, concept)] == result, (i, concept)


@pytest.mark.parametrize("reply", ["{}", "no json", "{bad", "", "text { } more"])
def test_unusable_replies_fall_back_to_the_rules(spark, reply):
    text = "Rib fracture. No ascites."
    df = spark.createDataFrame([("1", text, reply)], "report_id string, report_text string, content string")
    parsed = parse_label_responses(df)
    want = checker.label_report(text, default_lexicon())
    got = {r.concept: (r.label, r.evidence) for r in to_long(parsed, list(want)).collect()}
    assert got == want and parsed.first().raw_payload == "{}"


def test_usable_reply_is_not_overruled(spark):
    reply = 'Sure: {"labels": {"ascites": 1}, "evidence": {"ascites": ["ascites"]}, "note": "}"} bye'
    df = spark.createDataFrame([("1", "Rib fracture. Ascites.", reply)], "report_id string, report_text string, content string")
    row = parse_label_responses(df).first()
    assert row.fracture.label == 0 and row.ascites == (1, ["ascites"]) and "note" in row.raw_payload


def test_filter_on_a_result_column_stays_cheap(spark):
    """A filter on labels must not copy the labelling into itself."""
    df = spark.createDataFrame([("1", "Rib fracture.", "{}")], "report_id string, report_text string, content string")
    parsed = parse_label_responses(df).filter("fracture.label = 1 AND renal_cyst.label = 0 AND ascites.label < 1")
    assert parsed.count() == 1
    assert len(parsed._jdf.queryExecution().optimizedPlan().toString()) < 400_000


def test_replies_with_nan_and_repeated_keys(spark):
    """NaN is no label, the last of repeated keys counts, single quotes are no JSON."""
    text = "Findings: Simple ascites is seen. No fracture."
    replies = [
        '{"labels": {"ascites": NaN, "fracture": 0}, "evidence": {}}',
        '{"labels": {"ascites": 0, "ascites": -1}, "evidence": {}}',
        "{'labels': {'ascites': -1}}",
    ]
    df = spark.createDataFrame([(str(i), text, r) for i, r in enumerate(replies)], "report_id string, report_text string, content string")
    got = {r.report_id: r for r in parse_label_responses(df).collect()}
    assert got["0"].ascites.label == 0 and got["1"].ascites.label == -1
    assert got["2"].raw_payload == "{}" and got["2"].ascites.label == 1


def test_replies_fall_back_in_the_wanted_mode(spark):
    """Without usable JSON the result is that of the rules in the same mode."""
    df = spark.createDataFrame([("1", "Impression: Ascites is seen.", "none"), ("2", "Ascites. History: fracture.", "")], "report_id string, report_text string, content string")
    for mode in ("report", "direct"):
        ruled = label_results(df, mode=mode).orderBy("report_id").select("ascites", "fracture").collect()
        assert parse_label_responses(df, mode=mode).orderBy("report_id").select("ascites", "fracture").collect() == ruled
