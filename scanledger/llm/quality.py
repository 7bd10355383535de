"""Quality rules: fixed rules on counts, then robust outliers for each language and source.

The counts of a text become a vector of transformed rates.  For each language
and source the minimum covariance determinant is sought by concentration steps
over all of its rows: take the half of the rows that lie nearest by the present
center and scatter, estimate both anew from them, and repeat.  Rows far from the
final estimate in Mahalanobis distance are rejected.  The half-set holds
(n + p + 1) / 2 of n rows, so that outliers may be up to almost half of a group.

Each step is two aggregations with a map-side part, one histogram of distances
and one set of sums, so a group of any size is never gathered.  Only the
estimates, a row for each group, meet the rows in a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanledger.llm.common import PIECE_BYTES, free_name, narrow, released, staged, text_slices
from scanledger.llm.words import BLANKS, Words, mix

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
RATES = ("word_length", "symbols", "dup_lines", "repeats")
#: Spread that each rate has at least: below it a difference says nothing about quality.
FLOORS = (0.05, 0.05, 0.08, 0.08)
#: Quantiles of chi-squared with four degrees of freedom (half, and 0.975 for
#: reweighting), steps, and the distance of a reject.
MEDIAN, INNER, STEPS, CUTOFF = 3.3567, 11.1433, 4, 60.0
#: Groups with fewer rows are judged together; so few rows in all are not judged.
LEAST_ROWS = 50
#: Groups up to this number are sent to every task; more are joined by shuffle.
SENT_GROUPS = 100_000


def count_texts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text; a null text has none."""
    words = Words(texts, BLANKS, fold=False)
    data, offsets, bounds = words.data, words.offsets, words.bounds
    n_words = np.diff(bounds)
    symbol = np.zeros(256, dtype=bool)
    symbol[np.frombuffer(SYMBOLS, np.uint8)] = True
    out = {
        "n_words": n_words,
        "word_chars": words.per_text(~words.gap & ((data & 0xC0) != 0x80)),
        "n_symbols": words.per_text(symbol[data]),
    }
    # Lines lie between line feeds and the ends of texts.
    feeds = np.flatnonzero(data == 10)
    starts = np.union1d(offsets[:-1], feeds + 1) if len(data) else np.zeros(0, np.int64)
    starts = starts[starts < len(data)]
    ends = np.minimum(np.append(starts[1:], len(data)), feeds_after(feeds, starts, len(data)))
    spoken = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[spoken], ends[spoken]
    owner = np.searchsorted(offsets, starts, side="right") - 1
    key = mix(words.stretch(starts, ends) + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    out["n_lines"] = np.bincount(owner, minlength=len(words))
    out["n_dup_lines"] = out["n_lines"] - np.bincount(owner[first], minlength=len(words))
    # Windows that occur twice in their text mark all their words.
    runs, of = words.shingles(WINDOW)
    text = np.repeat(np.arange(len(words)), np.diff(of))
    _, back, times = np.unique(mix(runs + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
    twice = np.flatnonzero(times[back] > 1)
    at = twice + (bounds[:-1] - of[:-1])[text[twice]]
    marks = np.zeros(len(words.starts) + 1, dtype=np.int64)
    np.add.at(marks, at, 1)
    np.add.at(marks, at + WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(marks[:-1]) > 0)])
    out["n_repeat_words"] = np.diff(covered[bounds])
    return out


def feeds_after(feeds: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """The first line feed at or behind each place."""
    return np.append(feeds, size)[np.searchsorted(feeds, starts)]


def measure(docs: DataFrame, text_col: str, names: dict[str, str], drop_text: bool = False) -> DataFrame:
    """The same rows with the counts of their whole texts under the given names."""
    kept = [c for c in docs.columns if not (drop_text and c == text_col)]
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept] + [f"`{names[c]}` long" for c in COUNTS])

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_col, PIECE_BYTES):
            found = count_texts(batch.column(text_col))
            columns = [batch.column(c) for c in kept] + [pa.array(found[c], pa.int64()) for c in COUNTS]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *(names[c] for c in COUNTS)])

    return docs.mapInArrow(run, schema)


def base_failed(names: dict[str, str]) -> Column:
    n, repeated = F.col(names["n_words"]), F.col(names["n_repeat_words"])
    return (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n)


def rates(names: dict[str, str]) -> list[Column]:
    """The transformed vector: shrunk towards the usual for short texts, so that these stray less."""
    n, chars, symbols, dup, repeated, lines = (F.col(names[c]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"))
    root = lambda part, whole: F.asin(F.sqrt(F.least(F.lit(1.0), part / whole)))
    return [F.log((chars + 250) / (n + 50)), root(symbols, chars + 250), root(dup, lines + 10), root(repeated, n + 50)]


def group_name(lang: str, source: str) -> Column:
    """One text for a language and source; null is a value of its own."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-"))
    return F.concat(F.length(part(lang)).cast("string"), part(lang), part(source))


def joined(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Rows with what belongs to their group; few groups are sent along, many are joined by shuffle."""
    return rows.join(F.broadcast(groups) if groups.count() <= SENT_GROUPS else groups, key, "left")


def distance(vector: list[Column], center: Column, inverse: Column) -> Column:
    """Squared Mahalanobis distance; null where a group has no estimate."""
    off = [v - center[i] for i, v in enumerate(vector)]
    terms = [off[i] * off[j] * inverse[len(off) * i + j] for i in range(len(off)) for j in range(len(off))]
    return sum(terms[1:], terms[0])


def nearest(rows: DataFrame, value: Column, least: Column) -> DataFrame:
    """For each group a value that so many of its rows (of ``all``) do not pass, by a histogram in steps of half a percent."""
    bins = rows.select("grp", F.floor(F.log(value + 1e-9) * 200).alias("bin")).groupBy("grp", "bin").count()
    order = Window.partitionBy("grp").orderBy("bin")
    counted = bins.withColumns({"below": F.sum("count").over(order), "all": F.sum("count").over(Window.partitionBy("grp"))})
    return counted.where(F.col("below") >= F.least(least, F.col("all"))).groupBy("grp").agg(F.exp((F.min("bin") + 1) / 200).alias("limit"))


def estimates(rows: DataFrame) -> DataFrame:
    """Center and inverse scatter of the rows of each group, from sums alone."""
    size = len(RATES)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    sums = rows.groupBy("grp").agg(F.count("*").alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(size)], *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}_{j}") for i, j in pairs])

    def solve(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for _, r in part.iterrows():
                mean = np.array([r[f"s{i}"] for i in range(size)]) / r["n"]
                cov = np.zeros((size, size))
                for i, j in pairs:
                    cov[i, j] = cov[j, i] = r[f"p{i}_{j}"] / r["n"] - mean[i] * mean[j]
                short = np.maximum(np.square(FLOORS) - np.diag(cov), 0)
                out.append((r["grp"], mean.tolist(), np.linalg.inv(cov + np.diag(short + 1e-12)).ravel().tolist()))
            yield pd.DataFrame(out, columns=["grp", "center", "inverse"])

    return sums.mapInPandas(solve, "grp string, center array<double>, inverse array<double>")


def starts(rows: DataFrame) -> DataFrame:
    """Medians and median deviations of each rate, a first estimate that outliers cannot move."""
    spread = rows.select("grp", F.posexplode(F.array(*[F.col(f"x{i}") for i in range(len(RATES))])).alias("at", "value"))
    grid = 1e-4
    middle = _median(spread.withColumn("bin", F.floor(F.col("value") / grid)), grid)
    off = spread.join(F.broadcast(middle) if middle.count() <= SENT_GROUPS * len(RATES) else middle, ["grp", "at"])
    deviation = _median(off.withColumn("bin", F.floor(F.abs(F.col("value") - F.col("median")) / grid)).drop("median"), grid).withColumnRenamed("median", "mad")
    floors = F.array(*[F.lit(f) for f in FLOORS])
    both = middle.join(deviation, ["grp", "at"]).withColumn("sd", F.greatest(1.4826 * F.col("mad"), F.get(floors, F.col("at"))))
    listed = both.groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("at", "median", "sd"))).alias("all"))
    inverse = F.array(*[1 / F.col("all")[i].sd ** 2 if i == j else F.lit(0.0) for i in range(len(RATES)) for j in range(len(RATES))])
    return listed.select("grp", F.col("all.median").alias("center"), inverse.alias("inverse"))


def _median(binned: DataFrame, grid: float) -> DataFrame:
    counts = binned.groupBy("grp", "at", "bin").count()
    key = Window.partitionBy("grp", "at")
    below = counts.withColumns({"below": F.sum("count").over(key.orderBy("bin")), "all": F.sum("count").over(key)})
    return staged(below.where(2 * F.col("below") >= F.col("all")).groupBy("grp", "at").agg(((F.min("bin") + 0.5) * grid).alias("median")), "median")


def fit(rows: DataFrame) -> DataFrame:
    """The robust estimate of each group (grp, center, inverse) from rows (grp, x0, x1, ...)."""
    vector = [F.col(f"x{i}") for i in range(len(RATES))]
    far = distance(vector, F.col("center"), F.col("inverse"))
    half = F.floor((F.col("all") + len(RATES) + 1) / 2)
    now = staged(starts(rows), "estimate")
    for _ in range(STEPS):
        with_now = joined(rows, now, "grp").withColumn("far", far)
        limit = staged(nearest(with_now, F.col("far"), half), "limit")
        now = staged(estimates(joined(with_now, limit, "grp").where(F.col("far") <= F.col("limit"))), "estimate")
    # The half-set is too narrow by a factor that the median distance shows; then one reweighting.
    with_now = joined(rows, now, "grp").withColumn("far", far)
    limit = staged(nearest(with_now, F.col("far"), F.col("all") / 2), "limit")
    inner = joined(with_now, limit, "grp").where(F.col("far") <= INNER * F.greatest(F.col("limit") / MEDIAN, F.lit(1.0)))
    return staged(estimates(inner), "estimate")


OWN = {c: c for c in COUNTS}


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Counts and verdicts, one row for each row of ``docs``: doc_id, the counts, far, base_failed, kept.

    A null text has no words and fails the base rules.  Null languages and
    sources are groups of their own.  A row without an estimate for its group
    (too few rows in all small groups together) is kept if the base rules hold.
    """
    source = narrow(docs, doc_id=id_col, lang=lang_col, source=source_col, text=text_col)
    counted = measure(source, "text", OWN, drop_text=True).withColumns({f"x{i}": r for i, r in enumerate(rates(OWN))}).withColumn("base_failed", base_failed(OWN)).withColumn("grp", group_name("lang", "source"))
    rows = staged(counted.drop("lang", "source"), "counts")
    fitted, sizes = _fitted(rows)
    named = joined(rows, sizes, "grp").withColumn("grp", F.col("judged_as"))
    return _verdicts(named, fitted, OWN, [F.col(f"x{i}") for i in range(len(RATES))], "base_failed").drop(*[f"x{i}" for i in range(len(RATES))], "grp", "judged_as")


def _fitted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Estimates, and under which name each group was judged; rows that fail the base rules teach nothing."""
    good = rows.where(~F.col("base_failed"))
    sizes = good.groupBy("grp").agg(F.count("*").alias("rows"))
    sizes = staged(sizes.select("grp", F.when(F.col("rows") < LEAST_ROWS, "").otherwise(F.col("grp")).alias("judged_as"), "rows"), "sizes")
    teach = joined(good, sizes, "grp").withColumn("grp", F.col("judged_as")).drop("judged_as", "rows")
    enough = sizes.groupBy("judged_as").agg(F.sum("rows").alias("rows")).where(F.col("rows") >= LEAST_ROWS).select(F.col("judged_as").alias("grp"))
    return fit(teach).join(enough, "grp", "left_semi"), sizes.drop("rows")


def _verdicts(rows: DataFrame, fitted: DataFrame, names: dict[str, str], vector: list[Column], failed: str) -> DataFrame:
    with_fit = joined(rows, fitted, "grp")
    far = distance(vector, F.col("center"), F.col("inverse"))
    kept = ~F.col(failed) & (F.coalesce(far, F.lit(0.0)) <= CUTOFF)
    return with_fit.withColumn("far", far).withColumn("kept", kept).drop("center", "inverse")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns and no join on an id."""
    judged = measure(narrow(docs, lang=lang_col, source=source_col, text=text_col), "text", OWN, drop_text=True).withColumns({f"x{i}": r for i, r in enumerate(rates(OWN))}).withColumn("base_failed", base_failed(OWN)).withColumn("grp", group_name("lang", "source"))
    fitted, sizes = _fitted(staged(judged.drop("lang", "source"), "counts"))
    stem = free_name(docs, "counted")
    names = {c: f"{stem}_{c}" for c in COUNTS}
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    counted = measure(docs, text_col, names)
    rows = counted.select(row, group_name(lang_col, source_col).alias("grp"), base_failed(names).alias("base_failed"), *[r.alias(f"x{i}") for i, r in enumerate(rates(names))])
    named = joined(rows.where(~F.col("base_failed")), sizes, "grp").withColumn("grp", F.col("judged_as"))
    return _verdicts(named, fitted, names, [F.col(f"x{i}") for i in range(len(RATES))], "base_failed").where("kept").select("row.*")
