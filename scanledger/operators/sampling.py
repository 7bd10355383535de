"""Seeded samples of exact size.

Rows are ordered by md5(seed:id), so a seed always gives the same sample on any
number of machines.  Taking the lowest n of that order by sorting would bring
every candidate of a stratum to one task.  Instead a histogram over the first
digits of the key finds the piece of the order a sample can come from; only the
rows in that piece are ranked.  The samples are whole and exact at any size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.answers import qc_answer, qc_value
from ..functions.fixed_values import NO_RELEVANT_FINDINGS
from ..session import written

_KEY, _BIN, _FINE, _N, _BEFORE, _QUOTA, _CUT = "__key", "__bin", "__fine", "__n", "__before", "__quota", "__cut"
#: 4096 pieces of the order, and as many of each of those.
BIN_DIGITS, FINE_DIGITS = 3, 6


def order_key(seed: int, *ids: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[i.cast("string") for i in ids]))


def _keyed(df: DataFrame, seed: int, ids: Sequence[str]) -> DataFrame:
    keyed = df.withColumn(_KEY, order_key(seed, *[F.col(i) for i in ids]))
    return keyed.withColumn(_BIN, F.left(F.col(_KEY), F.lit(BIN_DIGITS)))


def _histogram(keyed: DataFrame, strata: Sequence[str], piece: str = _BIN) -> DataFrame:
    """Rows per stratum and piece, and the rows of the stratum in lower pieces; computed once."""
    lower = Window.partitionBy(*strata).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    counts = keyed.groupBy(*strata, piece).agg(F.count(F.lit(1)).alias(_N))
    return written(counts.withColumn(_BEFORE, F.coalesce(F.sum(_N).over(lower), F.lit(0))), "histogram")


def _divided(rows: DataFrame) -> DataFrame:
    """The rows near a cut, written down with the finer piece each lies in."""
    return written(rows.withColumn(_FINE, F.left(F.col(_KEY), F.lit(FINE_DIGITS))), "near")


def take_lowest(
    df: DataFrame,
    n: int | Callable[[DataFrame], DataFrame],
    seed: int,
    ids: Sequence[str],
    strata: Sequence[str] = (),
) -> DataFrame:
    """The ``n`` rows of each stratum that come first in the seed's order.

    ``n`` may be a function that adds a ``__quota`` column to the histogram.
    ``ids`` identify a row within its stratum.  ``strata`` are columns of few
    values, such as the categories of a catalog: one row of each is broadcast.
    """
    keyed, strata = _keyed(df, seed, ids), list(strata)
    if not strata:
        # Each task keeps its lowest n, and these meet.
        return keyed.orderBy(_KEY, *ids).limit(int(n)).select(*df.columns)
    histogram = _histogram(keyed, strata)
    histogram = n(histogram) if callable(n) else histogram.withColumn(_QUOTA, F.lit(int(n)))
    reached = histogram.filter(F.col(_BEFORE) < F.col(_QUOTA))
    cut = reached.groupBy(*strata).agg(
        F.max(_BIN).alias(_CUT), F.max(_QUOTA).alias(_QUOTA), F.max_by(_BEFORE, F.col(_BIN)).alias(_BEFORE)
    )
    # One row per stratum.  Strata are categories of a catalog, a few hundred: the
    # pieces are filtered where they lie, before anything is dealt by stratum.
    near = _divided(keyed.join(F.broadcast(cut), strata).filter(F.col(_BIN) <= F.col(_CUT)))
    last = near.filter(F.col(_BIN) == F.col(_CUT))
    fine = _histogram(last, strata, _FINE).withColumnRenamed(_BEFORE, "__within").join(F.broadcast(cut), strata)
    fine = fine.filter(F.col(_BEFORE) + F.col("__within") < F.col(_QUOTA)).groupBy(*strata).agg(F.max(_FINE).alias("__fine_cut"))
    left = near.join(F.broadcast(fine), strata).filter(F.col(_FINE) <= F.col("__fine_cut"))
    rank = F.row_number().over(Window.partitionBy(*strata).orderBy(_KEY, *ids))
    return left.withColumn("__rank", rank).filter(F.col("__rank") <= F.col(_QUOTA)).select(*df.columns)


def sample_reports(reports: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n reports without replacement, all of them if there are no more."""
    return take_lowest(reports, n, seed, ["report_id"])


def sample_questions(questions: DataFrame, categories: int = 4, per_category: int = 10, seed: int = 42) -> DataFrame:
    """A catalog table (category, question) cut to some categories and questions."""
    chosen = take_lowest(questions.select("category").distinct(), categories, seed, ["category"])
    kept = questions.join(chosen, "category", "left_semi")
    return take_lowest(kept, per_category, seed, ["category", "question"], strata=["category"])


def mixed_order(seed: int, ids: Sequence[str]) -> list[Column]:
    """Columns to order a sample by so that its strata are mixed."""
    return [order_key(seed, F.lit("mix"), *[F.col(i) for i in ids]), *[F.col(i) for i in ids]]


def shuffled(sample: DataFrame, seed: int, ids: Sequence[str]) -> DataFrame:
    """A bounded sample in mixed order."""
    return sample.orderBy(*mixed_order(seed, ids))


# --- sheets for human review ----------------------------------------------------


def qc_findings(results: DataFrame, budget: int = 40, seed: int = 42) -> DataFrame:
    """Reports with their cleaned text and findings, and two columns to fill in."""
    sample = take_lowest(
        results.select("report_id", "raw_text", "no_comparison_text", "findings_text"), budget, seed, ["report_id"]
    )
    return sample.select(
        F.col("report_id").alias("query_id"),
        "raw_text",
        "no_comparison_text",
        F.col("findings_text").alias("findings"),
        F.lit("").alias("no_comparison_correct"),
        F.lit("").alias("findings_correct"),
    )


def qc_categories(results: DataFrame, budget: int = 10, seed: int = 42) -> DataFrame:
    """Per category up to 70 % relevant findings, the rest of the budget without any.

    Texts of reports are joined to the sample, not carried through it.  The
    sample has at most the budget's rows for each category of the catalog, so it
    is broadcast and the texts of all other reports stay where they are.
    """
    entries = results.select("report_id", F.explode("category_findings").alias("category", "category_finding"))
    entries = entries.withColumn(
        "none", F.coalesce(F.col("category_finding").contains(NO_RELEVANT_FINDINGS), F.lit(False))
    )
    relevant_quota = int(budget * 0.7)

    def quota(histogram: DataFrame) -> DataFrame:
        relevant = F.sum(F.when(~F.col("none"), F.col(_N)).otherwise(0)).over(Window.partitionBy("category"))
        taken = F.least(F.lit(relevant_quota), relevant)
        return histogram.withColumn(_QUOTA, F.when(F.col("none"), F.lit(budget) - taken).otherwise(taken))

    sample = take_lowest(entries, quota, seed, ["report_id", "category"], strata=["category", "none"])
    return (
        results.select("report_id", "raw_text").join(F.broadcast(sample), "report_id")
        .select(
            F.col("report_id").alias("query_id"),
            "category",
            "raw_text",
            F.coalesce("category_finding", F.lit("")).alias("category_finding"),
            F.lit("").alias("correct"),
        )
    )


def question_examples(results: DataFrame) -> DataFrame:
    """report_id, category, question, label for every answer that is a yes or a no.

    Answers are text, or JSON values as results documents give them
    (``typed_answers``): then numbers count by their sign, too.
    """
    typed = "typed_answers" in results.columns
    per_category = results.select("report_id", F.explode("typed_answers" if typed else "qa_results").alias("category", "answers"))
    per_answer = per_category.select("report_id", "category", F.posexplode("answers").alias("ord", "qa"))
    answers = per_answer.select("report_id", "category", "ord", F.explode("qa").alias("question", "answer"))
    label = qc_value(F.col("answer")) if typed else qc_answer(F.col("answer"))
    return answers.withColumn("label", label).drop("answer").filter(F.col("label").isNotNull())


def _draw(seed: int, kind: str, size: Column) -> Column:
    """A whole number below ``size`` for a draw, from the draw's number alone."""
    digits = F.left(order_key(seed, F.lit(kind), F.col("draw")), F.lit(8))
    return F.pmod(F.conv(digits, 16, 10).cast("long"), size)


def draw_questions(examples: DataFrame, budget: int = 50, seed: int = 42) -> DataFrame:
    """draw, label, question, report_id, category: examples drawn with replacement.

    Half the draws are positive (the rest negative); a draw picks one of the
    questions with such examples, then one of its examples, each with equal
    chance.  An example is found by its rank: the histogram, from which sizes
    and draws are read as well, names the bin that holds it, a second one the
    piece of that bin, and only rows of such pieces are ranked.  The examples are
    read twice, once to count them and once for the rows of the drawn bins.
    """
    spark = examples.sparkSession
    ids, group = ["report_id", "category", "ord"], ["label", "question"]
    keyed = _keyed(examples, seed, ["question", *ids])
    histogram = _histogram(keyed, group)
    per_question = histogram.groupBy(*group).agg(F.sum(_N).alias("examples"))
    # As many rows as there are questions in the catalog.
    per_label = Window.partitionBy("label")
    questions = per_question.withColumn(
        "question_rank", F.row_number().over(per_label.orderBy("question")) - 1
    ).withColumn("questions", F.count(F.lit(1)).over(per_label))

    sizes = questions.groupBy("label").agg(F.max("questions").alias("questions"))
    draws = spark.range(budget).select(
        F.col("id").alias("draw"), F.when(F.col("id") < budget // 2, 1).otherwise(0).alias("label")
    )
    draws = draws.join(sizes, "label").withColumn("question_rank", _draw(seed, "question", F.col("questions")))
    draws = draws.join(questions.drop("questions"), ["label", "question_rank"])
    draws = draws.select("draw", *group, _draw(seed, "example", F.col("examples")).alias("target"))

    # A row for each draw, so at most the budget.
    located, bins = written(_locate(draws, histogram, group, _BIN), "draws"), [*group, _BIN]
    near = _divided(keyed.join(F.broadcast(located.select(*bins).distinct()), bins))
    fine = _histogram(near, bins, _FINE)
    targets = located.select("draw", *bins, (F.col("__rank") - 1).alias("target"))
    located, pieces = _locate(targets, fine, bins, _FINE), [*bins, _FINE]
    drawn = near.join(F.broadcast(located.select(*pieces).distinct()), pieces)
    rank = F.row_number().over(Window.partitionBy(*pieces).orderBy(_KEY, *ids))
    ranked = drawn.withColumn("__rank", rank.cast("long"))
    return located.join(ranked, [*pieces, "__rank"]).select("draw", *group, "report_id", "category")


def _locate(draws: DataFrame, histogram: DataFrame, group: Sequence[str], piece: str) -> DataFrame:
    """The piece that holds each draw's target, and the rank inside it.

    Bins and targets are put in one order and each target takes the bin before
    it: as many rows as bins and draws, no pairs of them.
    """
    marks = histogram.select(
        *group, F.col(_BEFORE).alias("at"), F.lit(0).alias("kind"), F.col(piece), F.lit(None).cast("long").alias("draw")
    )
    targets = draws.select(
        *group, F.col("target").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias(piece), "draw"
    )
    before = Window.partitionBy(*group).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = marks.unionByName(targets).select(
        *group,
        "draw",
        "at",
        F.last(piece, ignorenulls=True).over(before).alias(piece),
        F.last(F.when(F.col("kind") == 0, F.col("at")), ignorenulls=True).over(before).alias("start"),
    )
    drawn = placed.filter(F.col("draw").isNotNull())
    return drawn.select("draw", *group, piece, (F.col("at") - F.col("start") + 1).alias("__rank"))


def qc_questions(results: DataFrame, budget: int = 50, seed: int = 42) -> DataFrame:
    """Answers for review, half of them positive, with a column to fill in."""
    # At most ``budget`` rows: they go to the texts, not the texts to them.
    drawn = F.broadcast(draw_questions(question_examples(results), budget, seed))
    return results.select("report_id", "raw_text").join(drawn, "report_id").select(
        F.col("report_id").alias("query_id"),
        "question",
        "raw_text",
        F.col("label").alias("predicted_label"),
        F.lit("").alias("human_label"),
    )


def qc_statistics(sample: DataFrame, examples: DataFrame) -> DataFrame:
    """One row of counts about a question sample and what it was drawn from."""
    drawn = sample.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.count_if(F.col("predicted_label") == 1).alias("n_positive"),
        F.count_if(F.col("predicted_label") == 0).alias("n_negative"),
        F.countDistinct("question").alias("n_unique_questions"),
    )
    per_question = examples.groupBy("question").agg(
        F.max(F.col("label") == 1).alias("pos"), F.max(F.col("label") == 0).alias("neg")
    )
    available = per_question.agg(
        F.count(F.lit(1)).alias("n_questions"),
        F.count_if("pos").alias("n_questions_with_positives"),
        F.count_if("neg").alias("n_questions_with_negatives"),
        F.count_if(F.col("pos") & F.col("neg")).alias("n_questions_with_both"),
    )
    both = drawn.unionByName(available, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def qc_sheets(
    results: DataFrame, findings_budget: int = 40, category_budget: int = 10, question_budget: int = 50, seed: int = 42
) -> dict[str, DataFrame]:
    """The three review sheets, each on its own so one can fail without the others."""
    return {
        "combined_findings": qc_findings(results, findings_budget, seed),
        "categories": shuffled(qc_categories(results, category_budget, seed), seed, ["query_id", "category"]),
        "questions": shuffled(qc_questions(results, question_budget, seed), seed, ["query_id", "question"]),
    }
