"""Compaction that clusters rows by several columns, so that filters on any of them skip files."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, StructType, TimestampNTZType, TimestampType

from tripstrata.sources.readers import read_layer, record_schema
from tripstrata.sources.writers import CODEC

# Rows of one cell are dealt to so many shares, which files may part.
SHARES = 256
# Cells for each file, so that files begin and end near the bounds of cells.
CELLS_PER_FILE = 4
_ORDERED = (NumericType, DateType, TimestampType, TimestampNTZType)


def _checked(schema: StructType, columns: Sequence[str]) -> dict[str, DataType]:
    types = {f.name: f.dataType for f in schema}
    unfit = [c for c in columns if not isinstance(types.get(c), _ORDERED)]
    if unfit or not columns or len(set(columns)) < len(columns):
        raise ValueError(f"cluster by different columns of numbers, dates or times, not {unfit or list(columns)}")
    return {c: types[c] for c in columns}


def split_points(df: DataFrame, columns: Sequence[str], bits: int) -> dict[str, list]:
    """At most ``2 ** bits - 1`` values per column that part its rows about evenly; one pass, one row fetched.

    A value that holds many rows repeats in the list, which leaves cells empty but
    moves no row.  A column without values has no points.
    """
    ranks = [n / (1 << bits) for n in range(1, 1 << bits)]
    exactness = 20 << bits
    found = df.agg(*[F.percentile_approx(c, ranks, exactness).alias(str(n)) for n, c in enumerate(columns)]).first()
    return {c: found[n] or [] for n, c in enumerate(columns)}


def interleaved(df: DataFrame, points: dict[str, list], bits: int, name: str) -> DataFrame:
    """Add ``name``: the bits of each column's cell in turn, the highest first.

    A cell is found by halving, one comparison per bit.  Null lies in the first cell, NaN in the last.
    """
    types = {f.name: f.dataType for f in df.schema}
    cells = {c: f"{name}_{n}" for n, c in enumerate(points)}
    df = df.withColumns({cell: F.lit(0) for cell in cells.values()})
    for bit in reversed(range(bits)):
        step: dict[str, Column] = {}
        for column, cell in cells.items():
            if not points[column]:
                continue
            bounds = F.array(*[F.lit(p).cast(types[column]) for p in points[column]])
            bound = F.get(bounds, F.col(cell) + ((1 << bit) - 1))
            step[cell] = F.col(cell) + F.when(F.col(column) >= bound, 1 << bit).otherwise(0)
        df = df.withColumns(step)
    key = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for cell in cells.values():
            key = key * 2 + F.shiftright(cell, bit).bitwiseAND(F.lit(1))
    return df.withColumn(name, key).drop(*cells.values())


def cluster_table(
    spark: SparkSession,
    source: str,
    target: str,
    columns: Sequence[str],
    files: int,
    fmt: str = "parquet",
    codec: str = CODEC,
    schema: StructType | None = None,
) -> DataFrame:
    """Copy a table into about ``files`` files in a fresh folder, each a box of the given columns.

    Rows and columns stay as they are.  The table is cut at quantiles of each column, the
    numbers of the cells are interleaved, and rows are dealt out by ranges of that key, so
    minima and maxima of a file are narrow in every column.  Rows of one cell are parted by
    their place in the source too: a value with a third of all rows fills a third of the
    files, not one task.
    """
    if files < 1:
        raise ValueError("files must be 1 or more")
    rows = read_layer(spark, source, fmt, schema=schema)
    _checked(rows.schema, columns)
    bits = max(1, math.ceil(math.log2(CELLS_PER_FILE * files) / len(columns)))
    name = "_cell"
    while any(c.startswith(name) for c in rows.columns):
        name = f"_{name}"
    points = split_points(rows, columns, bits)
    # The number comes from a scan, whose splits and order stay the same when a task runs again.
    share = F.pmod(F.monotonically_increasing_id(), F.lit(SHARES)).alias(f"{name}_share")
    keyed = interleaved(rows.select("*", share), points, bits, name)
    dealt = keyed.repartitionByRange(files, name, f"{name}_share").sortWithinPartitions(name)
    dealt.select(*rows.columns).write.format(fmt).option("compression", codec).mode("overwrite").save(target)
    record_schema(spark, target, rows.schema, None)
    return spark.read.format(fmt).schema(rows.schema).load(target)


def file_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``file, n_rows`` and ``min_<column>, max_<column>`` per file that ``df`` reads: what a filter can skip by."""
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)]
    return df.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n_rows"), *ends)
