"""Choosing, dropping and renaming columns."""

from __future__ import annotations

import warnings
from collections.abc import Iterable

from pyspark.sql import DataFrame

from tripstrata.functions.names import snake_case_all


def present_columns(
    df: DataFrame,
    columns: Iterable[str],
    missing: str = "warn",
    case_sensitive: bool = True,
) -> list[str]:
    """The requested columns that ``df`` has, in request order.

    ``missing='warn'`` skips the others with a warning; ``'error'`` raises.
    """
    if missing not in ("warn", "error"):
        raise ValueError(f"missing must be 'warn' or 'error', not {missing!r}")
    key = str if case_sensitive else str.lower
    actual = {key(name): name for name in df.columns}
    requested = list(columns)
    absent = [name for name in requested if key(name) not in actual]
    if absent and missing == "error":
        raise ValueError(f"columns not found: {absent}")
    if absent:
        warnings.warn(f"columns not found, skipped: {absent}", stacklevel=3)
    return [actual[key(name)] for name in requested if key(name) in actual]


def drop_columns(df: DataFrame, columns: Iterable[str], missing: str = "warn") -> DataFrame:
    return df.drop(*present_columns(df, columns, missing))


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename all columns in one projection."""
    return df.toDF(*snake_case_all(df.columns))


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns both tables have, in the order of ``left``."""
    on_the_right = set(right.columns)
    return [name for name in left.columns if name in on_the_right]
