from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from scanledger.operators.labels import (
    label_concepts,
    label_results,
    mentions,
    names_of,
    pivot_labels,
    to_nested,
    to_wide,
    unpivot_labels,
)
from scanledger.operators.lexicon import ConceptRule, default_lexicon
from scanledger.plans.derived import reports as derived_reports
from tests import checker

GOLDEN = [
    ("No pleural effusion.", {"pleural_effusion": (0, ["No pleural effusion."])}),
    ("Small right effusion.", {"pleural_effusion": (1, ["Small right effusion."])}),
    ("Small pericardial effusion with right effusion.", {"pleural_effusion": (0, [])}),
    ("Possible fracture. No fracture.", {"fracture": (0, ["No fracture."])}),
    ("Possible fracture.", {"fracture": (-1, ["Possible fracture."])}),
    ("No rib fracture. Rib fracture on the left.", {"fracture": (1, ["Rib fracture on the left."])}),
    ("SBO. sbo. SBO again. SBO here. SBO there.", {"bowel_obstruction": (1, ["SBO.", "SBO again.", "SBO here."])}),
    ("Fracture is absent.", {"fracture": (0, ["Fracture is absent."])}),
    ("No" + " x" * 45 + " fracture.", {"fracture": (1, ["No" + " x" * 45 + " fracture."])}),
    ("Coronary artery calcification.", {"coronary_calcification": (1, ["Coronary artery calcification."])}),
    ("Coronary artery disease.", {"coronary_calcification": (0, [])}),
    ("Aortic and coronary calcification.", {"coronary_calcification": (0, [])}),
    ("Coronary calcifications are likely.", {"coronary_calcification": (-1, ["Coronary calcifications are likely."])}),
    ("Hypodense liver lesion, consistent with cysts.", {"renal_cyst": (0, [])}),
    (
        "Renal hypodensities, likely cysts.",
        {"renal_cyst": (1, ["Renal hypodensities, likely cysts."]), "renal_hypodensities": (0, [])},
    ),
    ("No renal cyst.", {"renal_cyst": (0, ["No renal cyst."])}),
    ("Solid renal mass.", {"renal_hypodensities": (1, ["Solid renal mass."])}),
    ("Indeterminate renal lesion.", {"renal_hypodensities": (-1, ["Indeterminate renal lesion."])}),
    (
        "Renal lesion too small to characterize.",
        {"renal_hypodensities": (-1, ["Renal lesion too small to characterize."])},
    ),
    (
        "Indeterminate renal lesion. Simple renal cyst.",
        {"renal_cyst": (1, ["Simple renal cyst."]), "renal_hypodensities": (0, [])},
    ),
    ("No renal mass.", {"renal_hypodensities": (0, [])}),
    ("Mild pelviectasis.", {"hydronephrosis": (-1, ["Mild pelviectasis."])}),
    ("Left hydronephrosis.", {"hydronephrosis": (1, ["Left hydronephrosis."])}),
    ("Indication:\nFracture.\nFINDINGS:\nClear.", {"fracture": (0, [])}),
    ("Splenomegaly. History: rib fracture.", {"fracture": (1, ["History: rib fracture."])}),
    (
        "Findings:\nClear.\nHistory:\nRib fracture.\nImpression:\nSplenomegaly.",
        {"splenomegaly": (1, ["Splenomegaly."]), "fracture": (0, [])},
    ),
    ("Spleen is normal.", {}),
    ("", {}),
    (None, {}),
    # Blanks, breaks and letters outside ASCII.
    ("Fracıture. ſplenomegaly noted.  Next", {"splenomegaly": (1, ["ſplenomegaly noted."])}),
    ("😀" * 79 + " no fracture 😀.", {"fracture": (0, ["😀" * 79 + " no fracture 😀."])}),
    ("No " + "😀" * 40 + " " * 38 + "fracture.", {"fracture": (1, ["No " + "😀" * 40 + " " * 38 + "fracture."])}),
    ("Éno fracture.", {"fracture": (1, ["Éno fracture."])}),
    ("HISTORY\r\nRib fracture.\x0cTechnique :\x85Ascites.", {"fracture": (0, []), "ascites": (1, ["Ascites."])}),
    ("hi\nClinical History :\nhistory\nAscites\nFOO:\nComparison\nAAA", {"ascites": (0, []), "abdominal_aortic_aneurysm": (1, ["AAA"])}),
]


def as_dict(rows):
    out = {}
    for r in rows:
        out.setdefault(r.report_id, {})[r.concept] = (r.label, r.evidence)
    return out


@pytest.mark.parametrize("mode", ["report", "direct"])
def test_golden_rows_and_checker(spark, mode):
    rules = default_lexicon()
    df = spark.createDataFrame([(str(i), t) for i, (t, _) in enumerate(GOLDEN)], "report_id string, report_text string")
    got = as_dict(label_concepts(df, mode=mode).collect())
    assert len(got) == len(GOLDEN)
    for i, (text, expected) in enumerate(GOLDEN):
        assert len(got[str(i)]) == 30
        assert got[str(i)] == checker.label_report(text, rules, mode), text
        if mode == "report":
            for concept, result in expected.items():
                assert got[str(i)][concept] == result, text


def test_mode_decides_which_heading_ends_a_block(spark):
    text = "Findings:\nClear.\nHistory:\nRib fracture.\nImpression:\nSplenomegaly."
    df = spark.createDataFrame([("a", text)], "report_id string, report_text string")
    for mode, expected in (("report", 1), ("direct", 0)):
        row = label_concepts(df, mode=mode).filter("concept = 'splenomegaly'").first()
        assert row.label == expected


def test_labels_of_whole_table_equal_checker(spark, sf_dir):
    rules = default_lexicon()
    reports = derived_reports(spark, sf_dir)
    got = as_dict(label_concepts(reports).collect())
    texts = {r.report_id: r.report_text for r in reports.collect()}
    assert got.keys() == texts.keys()
    for rid, text in texts.items():
        assert got[rid] == checker.label_report(text, rules), rid


def test_anchors_only_save_work(spark, sf_dir):
    bare = [replace(r, anchors=()) for r in default_lexicon()]
    reports = derived_reports(spark, sf_dir)
    assert label_concepts(reports, bare).exceptAll(label_concepts(reports)).count() == 0
    golden = spark.createDataFrame([(str(i), t) for i, (t, _) in enumerate(GOLDEN)], "report_id string, report_text string")
    assert label_concepts(golden, bare).exceptAll(label_concepts(golden)).count() == 0


def test_no_shuffle(spark, sf_dir):
    plan = label_concepts(derived_reports(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    # Only the spreading of a one-file table over the cores, before any work.
    assert plan.count("Exchange") == plan.count("Exchange RoundRobinPartitioning") <= 1


def test_partitioning_does_not_change_labels(spark, sf_dir):
    reports = derived_reports(spark, sf_dir)
    a, b = label_concepts(reports), label_concepts(reports.repartition(7, F.rand(1)))
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_own_rules(spark):
    rules = [
        ConceptRule("stone", (r"\bstones?\b",), forbid=(r"\bgall",)),
        ConceptRule("gas", (r"\bgas\b",), always_present=(r"\bfree gas\b",)),
    ]
    df = spark.createDataFrame([("1", "A stone. Gall stones. No free gas.")], "report_id string, report_text string")
    assert as_dict(label_concepts(df, rules).collect())["1"] == {"stone": (1, ["A stone."]), "gas": (1, ["No free gas."])}
    with pytest.raises(ValueError):
        label_concepts(df, [rules[0], rules[0]])


def test_wide_nested_and_back(spark, sf_dir):
    names = names_of(None)
    reports = derived_reports(spark, sf_dir)
    results = label_results(reports)
    wide = to_wide(results, names)
    long = label_concepts(reports)
    assert pivot_labels(long, names).exceptAll(wide).count() == 0
    back = unpivot_labels(wide, names).selectExpr("case_id report_id", "concept", "cast(label as int) label")
    assert back.exceptAll(long.select("report_id", "concept", "label")).count() == 0
    nested = to_nested(results, names).filter("report_id = '1'").first()
    row = wide.filter("report_id = '1'").first()
    assert nested.labels["fracture"] == row.fracture and set(nested.labels) == set(names)


def test_mentions_equal_checker(spark, sf_dir):
    rules = [r for r in default_lexicon() if isinstance(r, ConceptRule)]
    reports = derived_reports(spark, sf_dir)
    got = {tuple(r) for r in mentions(reports).collect()}
    want = set()
    for r in reports.collect():
        for idx, s in enumerate(checker.split_sentences(checker.eligible(r.report_text, "report"))):
            for rule in rules:
                want |= {(r.report_id, idx, s, rule.name, k) for k in checker.judge(rule, s)}
    assert got == want
