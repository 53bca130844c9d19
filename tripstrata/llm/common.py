"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# A side of a join is broadcast only after its rows were counted and found to
# stay under this many bytes; beyond it the join is left to shuffle.
BROADCAST_BYTES = 48 << 20


def text_of(column: Column | str = "text") -> Column:
    """The text of a row; a null text reads as an empty one."""
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(value.cast("string"), F.lit(""))


def text_key(value: Column) -> Column:
    """16 bytes that stand for a text: equal texts have equal keys."""
    return F.substring(F.unhex(F.sha2(value, 256)), 1, 16)


def fits(side: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the counted rows stay under the limit.

    ``side`` should be cheap to count: read it from a staged table.  ``row_bytes``
    is an upper bound for one row of it in memory.
    """
    return side.count() * row_bytes <= limit


def broadcast_if_small(side: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast when the counted rows are known to fit, else leave it to a shuffle."""
    return F.broadcast(side) if fits(side, row_bytes, limit) else side


def importable_in_tasks(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Matters for local sessions that loaded the package from a folder that is not
    on PYTHONPATH; on a cluster ship the package with the job.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Views of a few rows each, so that a task holds little decoded text at once."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


_held: dict = {}


def held(key: tuple, make: Callable):
    """A table that a Python worker keeps between tasks: the last one asked for, no other.

    Workers outlive their tasks and serve stages of many operators, so what each of them
    left behind would add up.
    """
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def tidy(run: Callable) -> Callable:
    """The same map over batches, after which the worker gives its free memory back.

    Python workers outlive their tasks and keep what they once allocated.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:  # also when nobody wants the rest
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def map_batches(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: StructType | str,
    rows: int = 512,
) -> DataFrame:
    """One output batch for each slice of a few input rows; no shuffle."""

    importable_in_tasks(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, rows):
                yield function(part)

    return df.mapInArrow(tidy(run), schema)


def rows_without(docs: DataFrame, gone: DataFrame, match: Callable[[Column], Column]) -> DataFrame:
    """The rows of ``docs`` that match no row of ``gone``, with their columns as they were.

    ``match`` gets the row as a struct, in which its names cannot clash with those
    of ``gone``.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    left = rows.join(gone, match(F.col("_doc")), "left_anti")
    return left.select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns])
