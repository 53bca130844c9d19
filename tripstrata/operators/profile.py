"""Column profile: one row per column, as a DataFrame."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstrata.operators.columns import present_columns


def _facts(df: DataFrame, name: str, distinct, extremes: bool = True) -> list[Column]:
    """The aggregates of one column.  Mean and spread exist for numbers only."""
    value = F.col(name)
    number = isinstance(df.schema[name].dataType, T.NumericType)
    absent = F.lit(None).cast("double")
    return [
        F.lit(name).alias("column_name"),
        F.count(value).alias("value_count"),
        (F.avg(value) if number else absent).cast("double").alias("mean"),
        (F.stddev(value) if number else absent).alias("stddev"),
        (F.min(value) if extremes else F.lit(None)).cast("string").alias("min"),
        (F.max(value) if extremes else F.lit(None)).cast("string").alias("max"),
        distinct(value).alias("unique_count"),
        F.count_if(value.isNull()).alias("null_count"),
    ]


def column_profile(
    df: DataFrame, columns: Iterable[str] | None = None, exact_distinct: bool = True
) -> DataFrame:
    """Count, mean, stddev, min, max, distinct values and nulls of each column.

    Exact: one aggregate without keys for all plain facts of all columns, and per
    column one that shuffles its values alone, merged in each task first.  Minimum and
    maximum of text come from those distinct values: a text cannot live in a hash
    buffer, so asking for them per row would sort the column.  Put a costly input in
    a stage table first, since each column reads it.

    ``exact_distinct=False`` makes one pass with a fixed-size sketch per column.
    """
    names = df.columns if columns is None else present_columns(df, columns)
    if not exact_distinct:
        rows = [F.struct(*_facts(df, c, F.approx_count_distinct)) for c in names]
        return df.agg(F.array(*rows).alias("facts")).select(F.inline("facts"))
    texts = [c for c in names if isinstance(df.schema[c].dataType, T.StringType)]
    plain = [F.struct(*_facts(df, c, lambda _: F.lit(0).cast("long"), extremes=c not in texts)) for c in names]
    facts = df.agg(F.array(*plain).alias("facts")).select(F.inline("facts"))
    distinct = reduce(DataFrame.unionByName, [_distinct_facts(df, c, c in texts) for c in names])
    # One row for each column on either side.
    joined = facts.drop("unique_count").join(F.broadcast(distinct), "column_name")
    return joined.select(
        "column_name",
        "value_count",
        "mean",
        "stddev",
        F.coalesce("min", "least").alias("min"),
        F.coalesce("max", "greatest").alias("max"),
        "unique_count",
        "null_count",
    )


def _distinct_facts(df: DataFrame, name: str, text: bool) -> DataFrame:
    """One row: number of distinct values, and for text the first and last of them."""
    values = df.groupBy(F.col(f"`{name}`").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    least, greatest = (F.min("value"), F.max("value")) if text else (F.lit(None), F.lit(None))
    return values.agg(
        F.lit(name).alias("column_name"),
        F.count("value").alias("unique_count"),
        least.cast("string").alias("least"),
        greatest.cast("string").alias("greatest"),
    )
