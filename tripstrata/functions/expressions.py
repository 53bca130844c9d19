"""Column expressions.  All built-in, so they stay inside generated code."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_of(conditions: list[Column]) -> Column:
    """One AND-ed predicate, so the scan sees a single filter."""
    return reduce(and_, conditions)


def sign_removed(value: Column) -> Column:
    """Flip negatives only: null, NaN and -0.0 pass through untouched."""
    return F.when(value < 0, -value).otherwise(value)


def shifted_code(code: Column, offset: int) -> Column:
    """Move a non-negative code; a negative or absent one has no meaning (null)."""
    return F.when(code >= 0, code + offset)


def minutes_between(start: Column, end: Column) -> Column:
    """Whole seconds between two instants, in minutes.  Negative when reversed."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / 60


def ratio_or_zero(amount: Column, per: Column) -> Column:
    """``amount / per`` for a positive divisor, else 0 (also for a null divisor)."""
    return F.when(per > 0, amount / per).otherwise(F.lit(0.0))


def is_number(value: Column) -> Column:
    """Neither null nor NaN."""
    return value.isNotNull() & ~F.isnan(value)


def is_finite(value: Column) -> Column:
    """Neither null nor NaN nor infinite."""
    return is_number(value) & (F.abs(value) < float("inf"))
