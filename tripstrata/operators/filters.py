"""Row filters.  Each adds one predicate that Catalyst can push to the scan."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.functions.expressions import all_of
from tripstrata.operators.columns import present_columns
from tripstrata.operators.quantiles import iqr_fences

# The default time window of the first monthly load.
DEFAULT_TIME_COLUMN = "tpep_pickup_datetime"
DEFAULT_DATE_RANGE = ("2024-01-01", "2024-01-31")


def filter_valid_range(
    df: DataFrame,
    ranges: Mapping[str, tuple[float, float]],
    missing: str = "warn",
) -> DataFrame:
    """Keep rows whose columns lie in ``[low, high]``.  Null and NaN drop."""
    names = present_columns(df, ranges, missing)
    return df.filter(all_of([F.col(c).between(*ranges[c]) for c in names])) if names else df


def filter_positive(df: DataFrame, columns: Iterable[str], missing: str = "warn") -> DataFrame:
    """Keep rows strictly above zero.  Null drops; NaN compares greatest and stays."""
    names = present_columns(df, columns, missing)
    return df.filter(all_of([F.col(c) > 0 for c in names])) if names else df


def filter_time_range(
    df: DataFrame,
    column: str = DEFAULT_TIME_COLUMN,
    date_range: tuple[str, str] = DEFAULT_DATE_RANGE,
    end_inclusive_day: bool = False,
    missing: str = "warn",
) -> DataFrame:
    """Keep rows from the first date up to the last one.

    The upper bound is the *first instant* of the last day unless
    ``end_inclusive_day`` is set, which keeps the whole of it.  The literal is
    cast, not the column, so that the comparison reaches the parquet reader.
    """
    if not present_columns(df, [column], missing):
        return df
    when, kind = F.col(column), df.schema[column].dataType
    first, last = date_range
    if end_inclusive_day:
        upper = when < F.date_add(F.lit(last).cast("date"), 1).cast(kind)
    else:
        upper = when <= F.lit(last).cast(kind)
    return df.filter((when >= F.lit(first).cast(kind)) & upper)


def filter_iqr(
    df: DataFrame,
    columns: Iterable[str],
    relative_error: float = 0.05,
    whisker: float = 1.5,
    missing: str = "warn",
) -> DataFrame:
    """Drop outliers beyond ``whisker`` interquartile ranges from the quartiles.

    Each column is measured on the rows that the previous column kept.  The two
    fences arrive as one scalar subquery: no driver round trip, no join, and the
    parquet reader can prune row groups with them.  Null, NaN and (on an empty
    input) everything drops.

    The plan reads its input twice, once for the fences.  When the input is
    costly, put it in a stage table first (``sources.writers.stage``).
    """
    for column in present_columns(df, columns, missing):
        fences = iqr_fences(df, column, relative_error, whisker).scalar()
        df = df.filter(F.col(column).between(fences.getField("low"), fences.getField("high")))
    return df


def exclude_dates(
    df: DataFrame, dates: Iterable[str | date], column: str = "date"
) -> DataFrame:
    """Drop whole days.  A null date drops as well, as in any SQL inequality.

    Without any date to drop the rows stay as they are, null dates too.
    """
    differs = [F.col(column) != F.lit(d).cast("date") for d in dates]
    return df.filter(all_of(differs)) if differs else df
