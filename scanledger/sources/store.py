"""Stage tables at rest: Parquet folders in hash buckets of the report, with one row per key."""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import STAGE_COLUMNS, STAGE_KEYS
from ..operators.requests import pending
from ..operators.responses import integrity_report, one_per_key

BUCKET = "bucket"


@dataclass(frozen=True)
class StageStore:
    """Stage tables under one folder that all executors share.

    A table is only ever appended to through Spark's commit protocol, so a lost
    executor or a rerun leaves no half-written rows, and rows whose key is
    stored already are left out, so appending twice is appending once.  One
    writer per table at a time.

    Rows lie in folders by a hash of their report.  An append or a resume asks
    which of these a batch falls into and reads no others: a batch costs what
    it holds and its buckets, not what is stored.  ``buckets`` counts when a
    table is made, the session's shuffle partitions where it is not given; from
    then on the number written beside the table does.
    """

    path: str
    buckets: int | None = None

    def location(self, stage: str) -> str:
        if stage not in STAGE_COLUMNS:
            raise ValueError(f"unknown stage {stage!r}")
        return f"{self.path}/{stage}"

    def _read(self, spark: SparkSession, path: str, schema: str) -> DataFrame | None:
        try:
            return spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def layout(self, spark: SparkSession, stage: str) -> int:
        """The number of buckets of a table, written down before its first rows."""
        known = self._read(spark, f"{self.location(stage)}/layout", "buckets int")
        found = known.agg(F.max("buckets")).first()[0] if known is not None else None
        if found is None:
            found = self.buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.range(1).select(F.lit(found).alias("buckets")).write.mode("overwrite").parquet(f"{self.location(stage)}/layout")
        return found

    def _rows(self, spark: SparkSession, stage: str) -> DataFrame | None:
        location = self.location(stage)
        schema = ", ".join(f"{c} string" for c in STAGE_COLUMNS[stage])
        return self._read(spark, f"{location}/rows", f"{schema}, {BUCKET} int")

    def load(self, spark: SparkSession, stage: str) -> DataFrame | None:
        """The stored rows, or None before the first write."""
        stored = self._rows(spark, stage)
        return None if stored is None else stored.drop(BUCKET)

    def near(self, spark: SparkSession, stage: str, batch: DataFrame) -> DataFrame | None:
        """The stored rows of the buckets that the reports of ``batch`` fall into, or None.

        The buckets come to the driver, at most as many as the table has, and
        prune the folders that are read.
        """
        stored = self._rows(spark, stage)
        if stored is None:
            return None
        wanted = batch.select(bucket_of(self.layout(spark, stage)).alias(BUCKET)).distinct().collect()
        return stored.filter(F.col(BUCKET).isin([r[0] for r in wanted])).drop(BUCKET)

    def new_rows(self, stage: str, rows: DataFrame) -> DataFrame:
        """The rows an append would add: one per key, keys not stored yet.

        The stored keys are cut down to the buckets of the batch, then to its
        keys, before the batch is held against them, so a small batch never
        shuffles a large table.
        """
        columns, keys = STAGE_COLUMNS[stage], list(STAGE_KEYS[stage])
        unique = one_per_key(rows.select(*columns), keys)
        stored = self.near(rows.sparkSession, stage, rows)
        if stored is None:
            return unique
        known = stored.select(*keys).join(rows.select(*keys).distinct(), keys, "left_semi")
        return pending(unique, known, keys).select(*columns)

    def _write(self, stage: str, rows: DataFrame, mode: str) -> None:
        # Each bucket is written by as many tasks as its size asks for, not by every task.
        dealt = rows.withColumn(BUCKET, bucket_of(self.layout(rows.sparkSession, stage))).hint("rebalance", BUCKET)
        dealt.write.mode(mode).partitionBy(BUCKET).parquet(f"{self.location(stage)}/rows")

    def append(self, stage: str, rows: DataFrame) -> None:
        """Add the rows whose keys are not stored yet.

        Once there is something to hold a batch against, the batch is written
        down first: it is then computed once, and cannot change in between.
        """
        spark, columns = rows.sparkSession, STAGE_COLUMNS[stage]
        if self._rows(spark, stage) is not None:
            folder = f"{self.path}/incoming/{stage}/{uuid4().hex}"
            rows.select(*columns).write.parquet(folder)
            rows = spark.read.schema(", ".join(f"{c} string" for c in columns)).parquet(folder)
        self._write(stage, self.new_rows(stage, rows), "append")

    def overwrite(self, stage: str, rows: DataFrame) -> None:
        self._write(stage, one_per_key(rows.select(*STAGE_COLUMNS[stage]), STAGE_KEYS[stage]), "overwrite")

    def reject(self, stage: str, rows: DataFrame, run: str) -> None:
        """Keep the rejected answers of a run: keys and ``content``.  A run that is repeated replaces its own."""
        keys = STAGE_KEYS[stage]
        rows.select(*keys, "content").write.mode("overwrite").parquet(f"{self.path}/rejected/{self._named(stage)}/run={run}")

    def rejected(self, spark: SparkSession, stage: str) -> DataFrame | None:
        """All rejected answers with their runs, or None before the first."""
        schema = ", ".join(f"{c} string" for c in (*STAGE_KEYS[stage], "content", "run"))
        return self._read(spark, f"{self.path}/rejected/{self._named(stage)}", schema)

    def still_open(self, spark: SparkSession, stage: str) -> DataFrame | None:
        """Keys that were answered, always without use, each once."""
        refused, keys = self.rejected(spark, stage), list(STAGE_KEYS[stage])
        return None if refused is None else pending(refused.select(*keys).distinct(), self.load(spark, stage), keys)

    def _named(self, stage: str) -> str:
        return self.location(stage).rsplit("/", 1)[-1]

    def integrity(self, spark: SparkSession, stage: str) -> DataFrame | None:
        stored = self.load(spark, stage)
        return None if stored is None else integrity_report(stored, STAGE_COLUMNS[stage])


def bucket_of(buckets: int, report: str = "report_id") -> Column:
    """The bucket of a report; rows without a report share one."""
    return F.pmod(F.xxhash64(F.col(report).cast("string")), F.lit(buckets)).cast("int")
