"""Session settings and the few choices that depend on the cluster."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str | None = None, app: str = "scanledger", **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC time."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.variant.allowDuplicateKeys": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``.  Where that is unset the
    session's checkpoint folder counts, then one inside the warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/scanledger").rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: it is computed once, and lost executors do not matter."""
    path = f"{shared_folder(df.sparkSession)}/scanledger/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int | None:
    """The setting ``scanledger.partitions``: pieces to deal reports to, or none to keep those they are read in."""
    named = spark.conf.get("scanledger.partitions", None)
    return int(named) if named else None


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal rows evenly to that many partitions, for tables that arrive in too few pieces; none keeps them."""
    return df.repartition(partitions) if partitions else df


def settle(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are computed once, here.

    Spark moves a filter on a computed column below it by copying the whole
    expression.  For a regular expression over a report that means doing the
    work again, and for columns built on each other the copies multiply.  Rows
    that come out of a generator stop that, and filters on other columns still
    move down to the scan.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))
