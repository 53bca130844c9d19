"""Equal-width bin counts: the data behind a histogram or a scatter plot.

Null, NaN and infinite values have no bin and are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.functions.expressions import all_of, is_finite


def _numeric(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns as doubles, under the given aliases, where all are finite numbers."""
    numbers = df.select(*[F.col(c).cast("double").alias(alias) for alias, c in columns.items()])
    return numbers.filter(all_of([is_finite(F.col(alias)) for alias in columns]))


def _extent(numbers: DataFrame) -> DataFrame:
    """One row: per column the low edge and the high edge.

    A column with a single value gets an extent of one around it, or of a millionth
    of its size if that is more, so that the edges differ from it.
    """
    columns = numbers.columns
    flat = numbers.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)])

    def edges(c: str) -> Column:
        low, high = F.col(f"min_{c}"), F.col(f"max_{c}")
        pad = F.when(low == high, F.greatest(F.lit(0.5), F.abs(low) * 5e-7)).otherwise(0.0)
        return F.struct((low - pad).alias("low"), (high + pad).alias("high")).alias(c)

    return flat.select(F.struct(*[edges(c) for c in columns]).alias("extent"))


def _bin(value: Column, edges: Column, bins: int) -> Column:
    """Bin index from 0; the last bin is closed on the right."""
    low, high = edges.getField("low"), edges.getField("high")
    return F.least(F.floor((value - low) / ((high - low) / bins)), F.lit(bins - 1).cast("long"))


def _edge(edges: Column, position: Column, bins: int) -> Column:
    low, high = edges.getField("low"), edges.getField("high")
    return low + position * ((high - low) / bins)


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """``bin, low, high, n`` for every bin, empty ones included.

    Counting is one aggregate of at most ``bins`` rows per task; the extent is a
    scalar subquery on the one column.
    """
    numbers = _numeric(df, x=column)
    edges = _extent(numbers).scalar().getField("x")
    counts = numbers.groupBy(_bin(F.col("x"), edges, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    every_bin = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return every_bin.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        _edge(edges, F.col("bin"), bins).alias("low"),
        _edge(edges, F.col("bin") + 1, bins).alias("high"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def histogram_2d(df: DataFrame, x: str, y: str, x_bins: int = 50, y_bins: int = 50) -> DataFrame:
    """``x_bin, y_bin, n`` for the occupied cells of the grid over two columns."""
    numbers = _numeric(df, x=x, y=y)
    extent = _extent(numbers).scalar()
    return numbers.groupBy(
        _bin(F.col("x"), extent.getField("x"), x_bins).alias("x_bin"),
        _bin(F.col("y"), extent.getField("y"), y_bins).alias("y_bin"),
    ).agg(F.count(F.lit(1)).alias("n"))
