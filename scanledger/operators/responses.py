"""Response tables: read, match to requests, validate, count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.answers import invalid_pattern, is_valid_result, response_pattern
from ..functions.completions import batch_line_text
from ..functions.fixed_values import STAGE_COLUMNS
from ..functions.text import strip
from ..session import settle


def parse_response_lines(lines: DataFrame, ord_col: str | None = None) -> DataFrame:
    """JSON lines in ``value`` -> request_id, content; unreadable lines are skipped.

    The last line of a repeated id wins when ``ord_col`` gives the line order.
    That is an aggregate with a map-side part, so an id repeated without bound
    shrinks before it is shuffled.
    """
    order = [F.col(ord_col).alias("__ord")] if ord_col else []
    filled = lines.filter(strip(F.col("value")) != "").select("value", *order)
    line = settle(filled, {"line": F.try_parse_json(F.col("value"))}).filter(F.col("line").isNotNull())
    parsed = settle(
        line.drop("value"),
        {
            "request_id": F.try_variant_get(F.col("line"), "$.custom_id", "string"),
            "content": batch_line_text(F.col("line")),
        },
    ).drop("line")
    kept = parsed.filter(F.col("request_id").isNotNull() & F.col("content").isNotNull())
    if not ord_col:
        return kept
    return last_per_key(kept, ["request_id"], "__ord").drop("__ord")


def last_per_key(df: DataFrame, keys: Sequence[str], ord_col: str) -> DataFrame:
    """The row with the greatest ``ord_col`` of each key.

    ``max_by`` combines within each input partition first, so one key holding
    most rows costs no more than any other.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    latest = df.groupBy(*keys).agg(F.max_by(row, F.col(ord_col)).alias("__row"))
    return latest.select(*keys, "__row.*")


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the same on every run: the greatest of the other columns."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    latest = df.groupBy(*keys).agg(F.max(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("__row"))
    return latest.select(*keys, "__row.*").select(*df.columns)


def match_responses(requests: DataFrame, responses: DataFrame, keys: Sequence[str] = ("request_id",)) -> DataFrame:
    """Requests with the content that came back for them, one response per key."""
    return requests.join(responses, list(keys), "inner")


def fill_missing(requests: DataFrame, responses: DataFrame, keys: Sequence[str] = ("request_id",)) -> DataFrame:
    """Requests with their content, empty where none came back; one response per key."""
    return requests.join(responses, list(keys), "left").withColumn(
        "content", F.coalesce(F.col("content"), F.lit(""))
    )


def missing_requests(requests: DataFrame, responses: DataFrame, keys: Sequence[str] = ("request_id",)) -> DataFrame:
    """Keys of requests without any response."""
    return requests.select(*keys).join(responses.select(*keys).distinct(), list(keys), "left_anti")


def split_valid(answered: DataFrame, stage: str) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) rows of ``content`` for a stage."""
    ok = is_valid_result(F.col("content"), stage)
    return answered.filter(ok), answered.filter(~ok)


def valid_results(answered: DataFrame, stage: str) -> DataFrame:
    return split_valid(answered, stage)[0]


def to_stage_rows(answered: DataFrame, stage: str) -> DataFrame:
    """Valid answers in the columns of the stage table."""
    columns = STAGE_COLUMNS[stage]
    value = columns[-1]
    rows = valid_results(answered, stage).withColumnRenamed("content", value) if value != "content" else answered
    return rows.select(*columns)


def apply_responses(stage: str, requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Requests and responses -> rows of the stage table."""
    return to_stage_rows(match_responses(requests, responses), stage)


def valid_findings(findings: DataFrame) -> DataFrame:
    return findings.filter(is_valid_result(F.col("findings"), "findings"))


def valid_category_map(nested: DataFrame, map_col: str = "category_findings") -> DataFrame:
    """Drop invalid entries of a category map, then reports with none left."""
    kept = F.map_filter(F.col(map_col), lambda _, v: is_valid_result(v, "category_findings"))
    return nested.withColumn(map_col, kept).filter(F.size(map_col) > 0)


def response_patterns(responses: DataFrame) -> DataFrame:
    """pattern, n"""
    return responses.groupBy(response_pattern(F.col("content")).alias("pattern")).agg(F.count("*").alias("n"))


def invalid_patterns(answered: DataFrame, stage: str) -> DataFrame:
    """pattern, n over the rejected responses of a stage"""
    rejected = split_valid(answered, stage)[1]
    return rejected.groupBy(invalid_pattern(F.col("content")).alias("pattern")).agg(F.count("*").alias("n"))


def empty_counts(responses: DataFrame) -> DataFrame:
    """n_non_empty, n_empty"""
    filled = strip(F.coalesce(F.col("content"), F.lit(""))) != ""
    return responses.agg(F.count_if(filled).alias("n_non_empty"), F.count_if(~filled).alias("n_empty"))


def first_samples(
    responses: DataFrame, n: int = 5, only_empty: bool = False, rejected_by: str | None = None
) -> DataFrame:
    """A few responses to look at, lowest ids first: any, empty ones, or those a stage rejects."""
    rows = split_valid(responses, rejected_by)[1] if rejected_by else responses
    if only_empty:
        rows = rows.filter(strip(F.coalesce(F.col("content"), F.lit(""))) == "")
    return rows.orderBy("request_id").limit(n)


def integrity_report(df: DataFrame, columns: Sequence[str], id_col: str = "report_id") -> DataFrame:
    """missing_columns, n_empty_rows, n_duplicate_ids of a stage table."""
    missing = sorted(set(columns) - set(df.columns))
    empty = F.lit(True)
    for c in df.columns:
        empty = empty & F.col(f"`{c}`").isNull()
    found = [F.count_if(empty).alias("n_empty_rows")]
    if id_col in df.columns:
        # Rows beyond the first of each id; rows without an id form one more group.
        groups = F.countDistinct(F.col(f"`{id_col}`")) + F.max(F.col(f"`{id_col}`").isNull().cast("int"))
        found.append((F.count(F.lit(1)) - F.coalesce(groups, F.lit(0))).alias("n_duplicate_ids"))
    else:
        found.append(F.lit(0).cast("long").alias("n_duplicate_ids"))
    return df.agg(*found).select(F.array_join(F.array(*[F.lit(m) for m in missing]).cast("array<string>"), ",").alias("missing_columns"), "n_empty_rows", "n_duplicate_ids")


