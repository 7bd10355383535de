"""Agreement between labels, predictions and annotations.

Counts are conditional sums with a map-side part, so a concept or question that
holds most rows is no bottleneck.  Wide tables are joined as they are, once per
case, and taken apart after the join.

Three conventions for an empty denominator are in use: review sheets give 0,
both concept reports give NaN.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.answers import all_numbers, annotation, is_blank_cell, percent, question_key, yes_no
from ..functions.fixed_values import CONCEPT_QUESTIONS
from ..functions.text import strip

NAN = float("nan")
CLASS_METRICS = ("precision", "recall", "f1_score", "specificity", "npv")


def share(part: Column, whole: Column, empty: float) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(empty))


def _counts(gt: Column, pred: Column) -> list[Column]:
    return [
        F.count_if((gt == 1) & (pred == 1)).alias("tp"),
        F.count_if((gt == 0) & (pred == 1)).alias("fp"),
        F.count_if((gt == 0) & (pred == 0)).alias("tn"),
        F.count_if((gt == 1) & (pred == 0)).alias("fn"),
    ]


# --- review sheets ------------------------------------------------------------------


def _numbers_only(sheet: DataFrame, column: str) -> Column:
    """Is a whole sheet column made of numbers?  Decides how its cells are read."""
    return sheet.agg(all_numbers(F.col(column))).scalar()


def _correctness(correct: Column) -> list[Column]:
    return [
        F.avg(correct).alias("accuracy"),
        F.count(F.lit(1)).alias("n_samples"),
        F.count(correct).alias("n_annotated"),
    ]


def eval_correctness(sheet: DataFrame, column: str, task: str) -> DataFrame:
    """task, accuracy, n_samples, n_annotated; no accuracy without annotations."""
    correct = annotation(F.col(column), _numbers_only(sheet, column))
    judged = sheet.select(correct.alias("correct")).agg(*_correctness(F.col("correct")))
    return judged.select(F.lit(task).alias("task"), "accuracy", "n_samples", "n_annotated")


def eval_findings_sheet(sheet: DataFrame) -> DataFrame:
    """Both judgements of the combined findings sheet."""
    return eval_correctness(sheet, "no_comparison_correct", "no_comparisons").unionByName(
        eval_correctness(sheet, "findings_correct", "findings")
    )


def eval_categories(sheet: DataFrame) -> DataFrame:
    """task (the category), accuracy, n_samples, n_annotated."""
    judged = sheet.select("category", annotation(F.col("correct"), _numbers_only(sheet, "correct")).alias("correct"))
    return judged.groupBy(F.col("category").alias("task")).agg(*_correctness(F.col("correct"))).filter(
        F.col("task").isNotNull()
    )


def eval_questions(sheet: DataFrame) -> DataFrame:
    """Binary metrics per question and over all of them (question null).

    Rows without an annotation are left out first.  Counts are made per
    question once; the total is rolled up from those few rows.
    """
    annotated = sheet.filter(~is_blank_cell(F.col("human_label")) & (strip(F.col("human_label")) != ""))
    pairs = annotated.select(
        "question",
        annotation(F.col("human_label"), _numbers_only(sheet, "human_label")).alias("gt"),
        annotation(F.col("predicted_label").cast("string"), _numbers_only(
            sheet.select(F.col("predicted_label").cast("string")), "predicted_label")).alias("pred"),
    )
    per_question = pairs.groupBy("question").agg(*_counts(F.col("gt"), F.col("pred")), F.count(F.lit(1)).alias("n"))
    rolled = per_question.rollup("question").agg(
        *[F.sum(c).alias(c) for c in ("tp", "fp", "tn", "fn")],
        F.sum("n").alias("n_samples"),
        F.count(F.lit(1)).alias("n_unique_questions"),
        F.grouping("question").alias("is_total"),
    )
    counted = rolled.filter((F.col("is_total") == 1) | F.col("question").isNotNull())
    return _binary_metrics(counted).select(
        "question", (F.col("is_total") == 1).alias("is_total"), "tp", "fp", "tn", "fn",
        "accuracy", *CLASS_METRICS, "n_samples", F.col("n_samples").alias("n_annotated"), "n_unique_questions",
    )


def _binary_metrics(counted: DataFrame) -> DataFrame:
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    total = tp + fp + tn + fn
    ratios = counted.withColumns(
        {
            "accuracy": share(tp + tn, total, NAN),
            "precision": F.when(total > 0, share(tp, tp + fp, 0.0)).otherwise(NAN),
            "recall": F.when(total > 0, share(tp, tp + fn, 0.0)).otherwise(NAN),
            "specificity": F.when(total > 0, share(tn, tn + fp, 0.0)),
            "npv": F.when(total > 0, share(tn, tn + fn, 0.0)),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    f1 = F.when(F.isnan(p), NAN).when(p + r > 0, 2 * (p * r) / (p + r)).otherwise(0.0)
    return ratios.withColumn("f1_score", f1)


def _as_tasks(rows: DataFrame, qc_type: Column, name: Column, kind: Column, question: Column, classes: bool) -> DataFrame:
    judged = F.col("accuracy").isNotNull()
    return rows.select(
        qc_type.alias("qc_type"),
        name.alias("task_name"),
        F.col("accuracy"),
        F.when(judged, F.col("n_samples")).otherwise(0).alias("n_samples"),
        F.when(judged, F.col("n_annotated")).otherwise(0).alias("n_annotated"),
        F.when(judged, kind).otherwise("unknown").alias("evaluation_type"),
        question.alias("question_text"),
        *[(F.col(m) if classes else F.lit(None).cast("double")).alias(m) for m in CLASS_METRICS],
    )


def evaluation_tasks(
    correctness: DataFrame | None = None, categories: DataFrame | None = None, questions: DataFrame | None = None
) -> DataFrame:
    """All evaluations as rows of one task table."""
    parts, blank, correct = [], F.lit(""), F.lit("correctness_evaluation")
    if correctness is not None:
        parts.append(_as_tasks(correctness, F.col("task"), F.col("task"), correct, blank, False))
    if categories is not None:
        parts.append(_as_tasks(categories, F.lit("categories"), F.col("task"), correct, blank, False))
    if questions is not None:
        total = F.col("is_total")
        parts.append(
            _as_tasks(
                questions,
                F.when(total, "questions_consolidated").otherwise("questions_individual"),
                F.when(total, "All Questions Combined").otherwise(question_key(F.col("question"))),
                F.when(total, "binary_classification_consolidated").otherwise("binary_classification"),
                F.when(total, "ALL_QUESTIONS_COMBINED").otherwise(F.col("question")),
                True,
            )
        )
    if not parts:
        raise ValueError("no evaluations given")
    return reduce(DataFrame.unionByName, parts)


def imperfect_tasks(tasks: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Tasks below the threshold.  Without an accuracy a task counts as 0; NaN is not below."""
    accuracy = F.coalesce(F.col("accuracy"), F.lit(0.0))
    below = tasks.withColumn("accuracy", accuracy).filter(F.col("accuracy") < threshold)
    return below.withColumn("accuracy_percent", percent(F.col("accuracy")))


def tasks_by_type(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("qc_type").agg(F.count(F.lit(1)).alias("n"))


# --- concepts against ground truth ----------------------------------------------------


def _zero_one(value: Column) -> Column:
    """0 or 1, null for anything else."""
    number = value.cast("string").try_cast("double")
    return F.when(number.isin(0.0, 1.0), number.cast("int"))


def _pairs(concepts: Sequence[str], gt, pred) -> Column:
    return F.array(
        *[F.struct(F.lit(c).alias("concept"), gt(c).alias("gt"), pred(c).alias("pred")) for c in concepts]
    )


def answered_cases(
    labels: DataFrame,
    results: DataFrame,
    concepts: Sequence[str],
    questions: Mapping[str, str] | None = None,
    id_col: str = "case_id",
) -> DataFrame:
    """case_id, pairs: labels beside the answers to each concept's question.

    Cases without results are left out.  A question asked in several categories
    counts as answered in the last one.
    """
    questions = questions or CONCEPT_QUESTIONS
    unmapped = sorted(set(concepts) - set(questions))
    if unmapped:
        raise ValueError(f"no question for concepts {unmapped}")
    answers = results.select(
        F.col("report_id").alias("__id"),
        F.flatten(
            F.transform(
                F.flatten(F.map_values(F.coalesce("qa_results", F.create_map().cast("map<string,array<map<string,string>>>")))),
                lambda qa: F.map_entries(qa),
            )
        ).alias("__qa"),
    )
    cases = labels.join(answers, F.col(f"`{id_col}`").cast("string") == F.col("__id"))

    def pred(concept: str) -> Column:
        asked = F.filter(F.col("__qa"), lambda e: e["key"] == questions[concept])
        return yes_no(F.try_element_at(asked, F.lit(-1))["value"])

    pairs = _pairs(concepts, lambda c: _zero_one(F.col(f"`{c}`")), pred)
    return cases.select(F.col("__id").alias("case_id"), pairs.alias("pairs"))


def predicted_cases(
    labels: DataFrame,
    predictions: DataFrame,
    concepts: Sequence[str],
    labels_id: str = "case_id",
    predictions_id: str = "report_id",
) -> DataFrame:
    """case_id, pairs: labels beside predicted labels, matched on their ids."""
    missing = sorted(set(concepts) - set(predictions.columns))
    if missing:
        raise ValueError(f"predictions lack concepts {missing}")
    left = labels.select(
        F.col(f"`{labels_id}`").cast("string").alias("case_id"), *[F.col(f"`{c}`").alias(f"{c}_gt") for c in concepts]
    )
    right = predictions.select(F.col(f"`{predictions_id}`").cast("string").alias("case_id"), *concepts)
    pairs = _pairs(concepts, lambda c: _zero_one(F.col(f"`{c}_gt`")), lambda c: _zero_one(F.col(f"`{c}`")))
    return left.join(right, "case_id").select("case_id", pairs.alias("pairs"))


def coverage_metrics(cases: DataFrame, concepts: Sequence[str]) -> DataFrame:
    """Per concept, counting a missing prediction as wrong."""
    none = cases.sparkSession.createDataFrame([(c,) for c in concepts], "concept string")
    pairs = cases.select(F.inline("pairs")).unionByName(none, allowMissingColumns=True)
    gt, pred = F.col("gt"), F.col("pred")
    counted = pairs.groupBy("concept").agg(
        F.count(gt).alias("n_labeled"),
        F.count_if(gt.isNotNull() & pred.isNotNull()).alias("n_predicted_yesno"),
        *_counts(gt, pred),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    n, covered = F.col("n_labeled"), F.col("n_predicted_yesno")
    ratios = counted.withColumns(
        {
            "n_no_pred": n - covered,
            "coverage": share(covered, n, NAN),
            "accuracy": share(tp + F.col("tn"), n, NAN),
            "precision_ppv": share(tp, tp + fp, NAN),
            "recall_sensitivity": share(tp, tp + fn, NAN),
        }
    )
    p, r = F.col("precision_ppv"), F.col("recall_sensitivity")
    f1 = F.when(F.isnan(p) | F.isnan(r), NAN).otherwise(share(2 * p * r, p + r, NAN))
    return ratios.withColumn("f1", f1).select(
        F.col("concept").alias("disease"), "n_labeled", "n_predicted_yesno", "n_no_pred", "coverage", "accuracy",
        "tp", "fp", "tn", "fn", "precision_ppv", "recall_sensitivity", "f1",
    )


def _added_up(cases: DataFrame) -> DataFrame:
    """Per concept: its counts, and how many different cases there are, all and labelled ones.

    Case rows are first added up per case and concept.  Joined cases lie by case
    already, so that moves nothing, and a case that is repeated without bound is
    one row per concept afterwards.  From then on counting rows is counting
    cases: one pass gives concepts and totals.
    """
    gt, pred = F.col("gt"), F.col("pred")
    labeled = F.exists("pairs", lambda p: p["gt"].isNotNull()).alias("__labeled")
    per_case = cases.select("case_id", labeled, F.inline("pairs")).groupBy("case_id", "concept").agg(
        F.count(gt).alias("n_labeled"),
        F.count_if(gt.isNotNull() & pred.isNotNull()).alias("n_eval"),
        *_counts(gt, pred),
        F.max("__labeled").alias("__labeled"),
    )
    sums = [F.sum(c).alias(c) for c in ("n_labeled", "n_eval", "tp", "fp", "tn", "fn")]
    return per_case.groupBy("concept").agg(
        *sums, F.count(F.lit(1)).alias("n_cases"), F.count_if("__labeled").alias("n_labeled_cases")
    )


def coverage_overall(cases: DataFrame) -> DataFrame:
    """total_labeled, total_predicted_yesno, coverage, accuracy, cases_with_predictions."""
    totals = _added_up(cases).agg(
        F.sum("n_labeled").alias("total_labeled"),
        F.sum("n_eval").alias("total_predicted_yesno"),
        F.sum(F.col("tp") + F.col("tn")).alias("n_correct"),
        F.coalesce(F.max("n_labeled_cases"), F.lit(0)).alias("cases_with_predictions"),
    )
    n = F.col("total_labeled")
    return totals.select(
        "total_labeled",
        "total_predicted_yesno",
        share(F.col("total_predicted_yesno"), n, NAN).alias("coverage"),
        share(F.col("n_correct"), n, NAN).alias("accuracy"),
        "cases_with_predictions",
    )


def case_accuracy(cases: DataFrame) -> DataFrame:
    """case_id, n_labeled, n_correct, accuracy for cases with a label: no shuffle."""
    labeled = F.filter("pairs", lambda p: p["gt"].isNotNull())
    counted = cases.select(
        "case_id",
        F.size(labeled).alias("n_labeled"),
        F.size(F.filter(labeled, lambda p: p["gt"] == p["pred"])).alias("n_correct"),
    )
    return counted.filter("n_labeled > 0").withColumn("accuracy", F.col("n_correct") / F.col("n_labeled"))


def evaluable_metrics(cases: DataFrame) -> DataFrame:
    """Per concept, only where label and prediction are both 0 or 1."""
    gt, pred = F.col("gt"), F.col("pred")
    pairs = cases.select(F.inline("pairs")).filter(gt.isNotNull() & pred.isNotNull())
    counted = pairs.groupBy("concept").agg(F.count(F.lit(1)).alias("n_eval"), *_counts(gt, pred))
    return _evaluable_ratios(counted).select(
        F.col("concept").alias("disease"), "n_eval", "tp", "fp", "tn", "fn", "precision_ppv", "recall_sensitivity", "f1", "accuracy"
    )


def _evaluable_ratios(counted: DataFrame) -> DataFrame:
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return counted.withColumns(
        {
            "precision_ppv": share(tp, tp + fp, NAN),
            "recall_sensitivity": share(tp, tp + fn, NAN),
            "f1": share(2 * tp, 2 * tp + fp + fn, NAN),
            "accuracy": share(tp + tn, tp + tn + fp + fn, NAN),
        }
    )


def evaluable_overall(cases: DataFrame) -> DataFrame:
    """Ratios of the summed counts, and how many cases were matched."""
    totals = _added_up(cases).agg(
        F.sum("n_eval").alias("total_eval"),
        *[F.sum(c).alias(c) for c in ("tp", "fp", "tn", "fn")],
        F.coalesce(F.max("n_cases"), F.lit(0)).alias("matched_cases"),
    )
    ratios = _evaluable_ratios(totals)
    return ratios.select(*[c for c in ratios.columns if c != "matched_cases"], "matched_cases")


def worst_first(metrics: DataFrame, support: str) -> DataFrame:
    """Lowest f1 first (NaN last), larger support first among equals."""
    return metrics.orderBy(F.asc("f1"), F.desc(support), "disease")


def require_matches(cases: DataFrame) -> DataFrame:
    """Refuse an empty match of labels and predictions."""
    if cases.isEmpty():
        raise ValueError("no matching case ids between labels and predictions")
    return cases


def unmatched(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``left`` that ``right`` lacks, each once."""
    keys = list(keys)
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), keys, "left_anti")


def drift(catalog: DataFrame, mapping: DataFrame, labelled: DataFrame) -> DataFrame:
    """kind, name: what a catalog (question), a mapping (concept, question) and label columns (concept) lack of each other.

    ``question not in catalog`` and ``question not mapped`` hold questions of the
    mapping and of the catalog, ``concept not mapped`` and ``concept without
    labels`` label columns and mapped concepts; each once.
    """
    parts = {
        "question not in catalog": unmatched(mapping, catalog, ["question"]),
        "question not mapped": unmatched(catalog, mapping, ["question"]),
        "concept not mapped": unmatched(labelled, mapping, ["concept"]),
        "concept without labels": unmatched(mapping, labelled, ["concept"]),
    }
    shown = [found.toDF("name").select(F.lit(kind).alias("kind"), "name") for kind, found in parts.items()]
    return reduce(DataFrame.unionByName, shown)


def label_columns(table: DataFrame, id_col: str = "case_id") -> DataFrame:
    """concept: the columns of a wide label table, as rows."""
    names = [(c,) for c in table.columns if c != id_col]
    return table.sparkSession.createDataFrame(names, "concept string")


def question_mapping(spark: SparkSession, questions: Mapping[str, str] | None = None) -> DataFrame:
    """concept, question: a mapping as rows; the built-in one without an argument."""
    return spark.createDataFrame(list((questions or CONCEPT_QUESTIONS).items()), "concept string, question string")
