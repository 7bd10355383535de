"""Reading tables, cutting lineage and small helpers shared by the operators."""

from __future__ import annotations

import ctypes
import functools
import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``.  Where that is unset the
    session's checkpoint folder counts, then one inside the warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/scanledger-stages").rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts its lineage.

    The files outlive any executor; each call has a folder of its own.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = f"_{name}"
    return name


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the wanted columns, under fixed names, so that clashing names do no harm."""
    return df.select([F.col(f"`{source}`").alias(name) for name, source in columns.items()])


#: Bytes of text whose words are looked at at once where that changes no result: their hashes take many times that for a moment.
PIECE_BYTES = 1 << 20


def text_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the texts of a piece have about ``limit`` bytes.

    A row is never cut: one longer text is a piece of its own.
    """
    for batch in batches:
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def give_back() -> None:
    """Return freed memory to the system: of Arrow's pool, and where it is glibc's of the allocator of Python and numpy."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function of a task's record batches; when they are through, freed memory goes back to the system.

    Python workers outlive their tasks, and allocators keep what is freed: a
    stage would carry what the largest tasks of the stages before it took.
    """

    @functools.wraps(run)
    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return through
