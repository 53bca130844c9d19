"""Repairs to values and whole rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstrata.functions.expressions import shifted_code, sign_removed
from tripstrata.operators.columns import present_columns

# The raw feeds write instants in this pattern.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

_ACCEPTS = {bool: T.BooleanType, str: T.StringType, int: T.NumericType, float: T.NumericType}


def dedup_rows(df: DataFrame, ignore: Iterable[str] = ()) -> DataFrame:
    """Distinct rows.  Copies collapse inside each task before the shuffle.

    Columns in ``ignore`` take no part in the comparison; the copies are folded
    into the one whose ignored columns sort first, so the result does not
    depend on the order in which tasks finish.  Null sorts before any value.  One
    ignored date or number keeps the hash aggregate; several need a struct, which Spark
    aggregates by sorting.
    """
    ignored = present_columns(df, ignore)
    if not ignored:
        return df.distinct()
    keys = df.groupBy(*[name for name in df.columns if name not in ignored])
    if len(ignored) == 1:
        (name,) = ignored
        absent = F.count_if(F.col(name).isNull()) > 0
        return keys.agg(F.when(~absent, F.min(name)).alias(name)).select(*df.columns)
    folded = keys.agg(F.min(F.struct(*ignored)).alias("_first"))
    return folded.select(
        *[F.col(f"_first.{name}").alias(name) if name in ignored else name for name in df.columns]
    )


def fill_na(df: DataFrame, columns: Iterable[str], value: Any, missing: str = "warn") -> DataFrame:
    """Replace null by one value in many columns; the types must agree."""
    names = present_columns(df, columns, missing)
    wanted = _ACCEPTS.get(type(value), ())
    unfit = [name for name in names if not isinstance(df.schema[name].dataType, wanted)]
    if unfit:
        raise TypeError(f"{value!r} cannot fill {unfit}")
    return df.fillna({name: value for name in names}) if names else df


def abs_negatives(df: DataFrame, columns: Iterable[str], missing: str = "warn") -> DataFrame:
    """Turn negative amounts positive."""
    names = present_columns(df, columns, missing)
    return df.withColumns({name: sign_removed(F.col(name)) for name in names}) if names else df


def shift_code(
    df: DataFrame, column: str = "payment_type", offset: int = 1, missing: str = "warn"
) -> DataFrame:
    """Renumber a code: ``code + offset`` from zero up, null below."""
    names = present_columns(df, [column], missing)
    return df.withColumns({name: shifted_code(F.col(name), offset) for name in names}) if names else df


def parse_timestamps(
    df: DataFrame,
    renames: Mapping[str, str],
    fmt: str = TIMESTAMP_FORMAT,
    missing: str = "warn",
) -> DataFrame:
    """Replace each source column by a parsed timestamp under a new name.

    ``renames`` maps source to target.  Text that does not fit ``fmt`` becomes
    null.  The result carries no time zone, like the wall-clock times it comes
    from.  New columns come last.
    """
    found = present_columns(df, renames, missing)

    def parsed(name: str):
        text = isinstance(df.schema[name].dataType, T.StringType)
        instant = F.try_to_timestamp(F.col(name), F.lit(fmt)) if text else F.col(name)
        return instant.cast("timestamp_ntz").alias(renames[name])

    replaced = set(found) | {renames[name] for name in found}
    kept = [name for name in df.columns if name not in replaced]
    return df.select(*kept, *[parsed(name) for name in found])
