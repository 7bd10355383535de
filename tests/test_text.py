import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scanledger.functions import fixed_values as fixed
from scanledger.functions.answers import (
    annotation,
    invalid_pattern,
    is_valid_result,
    percent,
    qc_answer,
    qc_value,
    question_id,
    question_key,
    response_pattern,
    yes_no,
)
from scanledger.functions.prompts import DEFAULT_TEMPLATES, label_prompt, render
from scanledger.functions.text import (
    eligible_text,
    findings_region,
    fold,
    sentences,
    squeeze,
    strip,
    without_headed_blocks,
    without_upper_case_blocks,
)
from tests import checker

PIECES = [
    "Findings:", "FINDINGS", "history", "History:", " clinical history ", "INDICATION :", "Impression:", "TECHNIQUE", "FOO BAR:", "AB:",
    "x", "no. Yes! ", "a ?  b", "\n", "\n\n", "\r\n", "\x0b", "\x1c", " ", "\xa0", "\t", " ", "\x1f", "　", ".\x85", "ı", "ſ", "İ", "😀", "é.",
]


def column(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), min_size=60, max_size=120))
def test_regions_and_sentences_equal_the_definition(spark, texts):
    assert column(spark, texts, strip) == [t.strip() for t in texts]
    assert column(spark, texts, squeeze) == [re.sub(r"\s+", " ", t).strip() for t in texts]
    assert column(spark, texts, findings_region) == [checker.region(t) for t in texts]
    assert column(spark, texts, without_headed_blocks) == [checker.drop_blocks(t, checker.known_heading).strip() for t in texts]
    assert column(spark, texts, without_upper_case_blocks) == [checker.drop_blocks(t, checker.upper_heading) for t in texts]
    for mode in ("report", "direct"):
        assert column(spark, texts, lambda c: eligible_text(c, mode)) == [checker.eligible(t, mode) for t in texts]
    assert column(spark, texts, sentences) == [checker.split_sentences(t) for t in texts]
    assert column(spark, texts, lambda c: fold(c).contains("findings")) == [bool(re.search("findings", t, re.I)) for t in texts]


def test_report_path_twice_is_once(spark):
    """Cutting a report and then treating it as direct text changes nothing more."""
    texts = ["Findings:\nA\nHISTORY:\nb\nImpression:\nC", "history\nx", "A\n\nINDICATION\nFOO:\nx\nfindings\n: y", ""]
    once = column(spark, texts, eligible_text)
    assert once == column(spark, once, lambda c: eligible_text(c, "direct")) == column(spark, once, eligible_text)


def test_a_block_of_many_lines_is_no_problem(spark):
    text = "History:\n" + "line of text\n" * 60_000 + "Impression:\nSplenomegaly."
    assert column(spark, [text], eligible_text) == ["Impression:\nSplenomegaly."]


def test_missing_text_and_bad_mode(spark):
    assert column(spark, [None], eligible_text) == [""]
    with pytest.raises(ValueError):
        eligible_text(F.col("t"), "other")


ANSWERS = [
    # text, yes/no, review answer, annotation of a word column, of a number column
    ("Yes", 1, 1, 1, 0), ("No - none seen", 0, None, None, 0), ("Yes and no", None, None, None, 0),
    ("Unsure, yes", None, None, None, 0), ("yesterday", None, None, None, 0), ("TRUE ", None, 1, 1, 0),
    ("wrong", None, None, 0, 0), ("", None, None, None, None), (None, None, None, None, None),
    ("2", None, None, None, 1), ("1", None, 1, 1, 1), ("0", None, 0, 0, 0), ("-1", None, None, None, 0),
    ("NaN", None, None, None, None), ("No.", 0, None, None, 0), ("can't determine. no", None, None, None, 0),
    (" Good", None, None, 1, 0), ("incorrect", None, None, 0, 0),
]


def test_answers(spark):
    texts = [a[0] for a in ANSWERS]
    assert column(spark, texts, yes_no) == [a[1] for a in ANSWERS]
    assert column(spark, texts, qc_answer) == [a[2] for a in ANSWERS]
    assert column(spark, texts, lambda c: annotation(c, F.lit(False))) == [a[3] for a in ANSWERS]
    assert column(spark, texts, lambda c: annotation(c, F.lit(True))) == [a[4] for a in ANSWERS]
    values = ["2", "-3", "0", "0.0", "1e-3", "true", "false", "null", '"yes"', '"2"', '"0"', "[1]", "{}"]
    assert column(spark, values, lambda c: qc_value(F.parse_json(c))) == [1, 0, 0, 0, 1, 1, 0, None, 1, None, 0, None, None]


def test_names_and_patterns(spark):
    assert column(spark, ["Is it a/b? Yes?"], question_key) == ["Is_it_a_b_Yes"]
    digest = hashlib.md5(b"Is there a fracture?").hexdigest()[:8]
    assert column(spark, ["Is there a fracture?"], question_id) == [digest]
    contents = ["", " \xa0", "No relevant findings.", "no findings", "Normal", "ok", "A long answer", None]
    assert column(spark, contents, response_pattern) == [
        "EMPTY", "EMPTY", "no_relevant_findings", "no_findings", "normal", "very_short", "substantial", "EMPTY",
    ]
    assert column(spark, ["", "Error ", "A" * 40], invalid_pattern) == ["EMPTY", "SHORT: 'error'", f"LONG: '{'a' * 30}...'"]
    shares = [0.5, 0.8125, 0.0625, 1 / 3, None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(shares)], "i int, s double")
    got = [r.p for r in df.select("i", percent(F.col("s")).alias("p")).orderBy("i").collect()]
    assert got == [round(s * 100, 1) if s is not None else None for s in shares]


def test_validity_per_stage(spark):
    contents = ["", " ", "No such section ", "ERROR", "No findings", "text", None]
    expected = {
        "no_comparisons": [0, 0, 1, 1, 1, 1, 0],
        "findings": [0, 0, 0, 1, 1, 1, 0],
        "category_findings": [0, 0, 1, 0, 1, 1, 0],
        "questions": [0, 0, 1, 1, 1, 1, 0],
    }
    for stage, flags in expected.items():
        assert column(spark, contents, lambda c: is_valid_result(c, stage)) == [bool(f) for f in flags]


def test_rendering_never_reads_a_report_as_a_template(spark):
    df = spark.createDataFrame([("has {question} and {report}", "Q?")], "r string, q string")
    template = "A {report} B {{x}} {question}!"
    got = df.select(render(template, report=F.col("r"), question=F.col("q")).alias("p")).first().p
    assert got == "A has {question} and {report} B {x} Q?!"
    with pytest.raises(ValueError):
        render("{other}", report=F.col("r"))
    for name, body in DEFAULT_TEMPLATES.items():
        assert body.endswith("\n") and "{" in body, name


def test_label_prompt_lists_every_concept(spark):
    got = column(spark, ["Spleen.", None], label_prompt)
    assert all(f'"{c}": 0' in got[0] and f'"{c}": []' in got[0] for c in fixed.CONCEPT_QUESTIONS)
    assert got[0].endswith("FINDINGS TEXT:\n-----\nSpleen.\n-----\n") and got[1].endswith("-----\n\n-----\n")


def test_long_runs_of_blanks_are_linear(spark):
    import time

    run = " " * 1_000_000
    rows = [(f"a{run}b",), (f"a{run}\nb",), (f"history{run}b",), (f"history{run}\nFINDINGS:\nc",)]
    df = spark.createDataFrame(rows, "text string").coalesce(1)
    start = time.perf_counter()
    out = [r[0] for r in df.select(sentences(F.col("text"))).collect()]
    df.select(eligible_text(F.col("text"))).collect()
    assert time.perf_counter() - start < 20
    assert out[0] == [f"a{run}b"] and out[1] == ["a", "b"]
