"""Report sources: CSV and the JSON layouts reports come in.

Every reader returns report_id, report_text and a position; ``read_reports``
joins any number of files and keeps the last text of a repeated id.  All cells
are read as text, so an id keeps its leading zeros.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.responses import last_per_key

_ORD = "__ord"


def _position(file_index: int) -> Column:
    """Order of rows over files, pieces of a file and rows of a piece."""
    return F.struct(
        F.lit(file_index).alias("file"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_csv_texts(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A CSV file with a header, all columns as text.

    ``multi_line`` lets quoted texts run over lines; one file is then read by
    one task.  Large exports belong in many files, or set it off.
    """
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=multi_line, quote='"', escape='"')


def read_csv_reports(
    spark: SparkSession, path: str, id_col: str = "Accession", text_col: str = "Report Text", file_index: int = 0
) -> DataFrame:
    raw = read_csv_texts(spark, path)
    for name in (id_col, text_col):
        if name not in raw.columns:
            raise ValueError(f"{path} has no column {name!r}, only {raw.columns}")
    return raw.select(
        F.col(f"`{id_col}`").cast("string").alias("report_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("report_text"),
        _position(file_index).alias(_ORD),
    )


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """path, value: each JSON file as one row.  Files are read in parallel."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


def parse_json_reports(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """JSON documents (path, value) -> path, pos, report_id, report_text.

    Layouts: a list of objects; an object whose values are all texts, taken as
    id -> text; an object with a list under ``reports`` or else ``data``.
    List items without both keys are dropped.  Any other shape is an error.
    """
    items = "array<map<string,variant>>"
    start = F.left(strip(F.col("value")), F.lit(1))
    keys = F.json_object_keys(F.col("value"))
    wrapped = F.from_json(F.col("value"), f"reports {items}, data {items}")
    staged = documents.select(
        "path",
        "value",
        start.alias("__start"),
        keys.alias("__keys"),
        F.when(start == "{", wrapped).alias("__wrapped"),
    )
    has_reports = F.array_contains("__keys", "reports")
    has_list = F.coalesce(F.col("__wrapped.reports"), F.col("__wrapped.data")).isNotNull()
    mapped = F.from_json(F.col("value"), "map<string,variant>")
    staged = staged.withColumn("__map", F.when((F.col("__start") == "{") & ~has_list, mapped))
    all_texts = F.forall(F.map_values("__map"), lambda v: F.schema_of_variant(v) == "STRING")
    unsupported = F.raise_error(F.concat(F.lit("unsupported JSON structure in "), F.col("path")))

    def of_items(column: Column) -> Column:
        complete = F.filter(column, lambda m: F.map_contains_key(m, F.lit(id_col)) & F.map_contains_key(m, F.lit(text_col)))
        return F.transform(
            complete,
            lambda m: F.struct(
                _as_text(F.try_element_at(m, F.lit(id_col))).alias("report_id"),
                _as_text(F.try_element_at(m, F.lit(text_col))).alias("report_text"),
            ),
        )

    def of_entries(column: Column) -> Column:
        return F.transform(
            F.map_entries(column),
            lambda e: F.struct(e["key"].alias("report_id"), _as_text(e["value"]).alias("report_text")),
        )

    nothing = F.array().cast("array<struct<report_id:string,report_text:string>>")
    rows = (
        F.when(F.col("__start") == "[", F.coalesce(of_items(F.from_json(F.col("value"), items)), unsupported))
        .when((F.col("__start") != "{") | F.col("__keys").isNull(), unsupported)
        .when(has_reports & F.col("__wrapped.reports").isNotNull(), of_items(F.col("__wrapped.reports")))
        .when(~has_reports & F.col("__wrapped.data").isNotNull(), of_items(F.col("__wrapped.data")))
        .when(F.col("__map").isNotNull() & all_texts, of_entries(F.col("__map")))
        .when(has_reports | F.array_contains("__keys", "data"), unsupported)
        .otherwise(nothing)
    )
    exploded = staged.select("path", F.posexplode(rows).alias("pos", "item"))
    return exploded.select(
        "path",
        "pos",
        F.col("item.report_id").alias("report_id"),
        F.coalesce(F.col("item.report_text"), F.lit("")).alias("report_text"),
    )


def _as_text(value: Column) -> Column:
    return F.coalesce(F.try_variant_get(value, "$", "string"), F.nullif(F.to_json(value), F.lit("null")))


def read_json_reports(
    spark: SparkSession, path: str, id_col: str = "Accession", text_col: str = "Report Text", file_index: int = 0
) -> DataFrame:
    parsed = parse_json_reports(json_documents(spark, path), id_col, text_col)
    position = F.struct(
        F.lit(file_index).alias("file"),
        F.col("path"),
        F.lit(0).cast("long").alias("block"),
        F.col("pos").cast("long").alias("row"),
    )
    return parsed.select("report_id", "report_text", position.alias(_ORD))


def read_reports(
    spark: SparkSession, paths: Sequence[str], id_col: str = "Accession", text_col: str = "Report Text"
) -> DataFrame:
    """Reports of all files; of a repeated id the last row of the last file wins."""
    readers = {".csv": read_csv_reports, ".json": read_json_reports}
    parts = []
    for index, path in enumerate(paths):
        suffix = "." + str(path).rsplit(".", 1)[-1].lower() if "." in str(path) else ""
        if suffix not in readers:
            raise ValueError(f"{path}: only .csv and .json reports can be read")
        parts.append(readers[suffix](spark, str(path), id_col, text_col, index))
    if not parts:
        raise ValueError("no report files given")
    return last_wins(reduce(DataFrame.unionByName, parts), _ORD)


def last_wins(rows: DataFrame, ord_col: str) -> DataFrame:
    """One row per report id: the one that comes last."""
    return last_per_key(rows, ["report_id"], ord_col).drop(ord_col)

