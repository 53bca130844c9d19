"""Totals of several levels at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.operators.summaries import fare_and_distance


def totals(
    df: DataFrame,
    keys: Mapping[str, Column],
    levels: Sequence[Sequence[str]],
    metrics: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row for each group of each level, in one aggregate.

    ``keys`` are expressions by name, ``levels`` are sets of those names; the empty one is
    the grand total.  Keys that a level leaves out are null, and ``grouping_id`` tells
    them from keys that are null themselves: a bit for each key, the first one highest,
    set where the key is left out.  Rows are expanded inside each task and combined there
    before the shuffle, so the input is read once and a key with most of the rows
    shuffles one row for each task.
    """
    unknown = {name for level in levels for name in level} - set(keys)
    if unknown or not levels:
        raise ValueError(f"levels need names among {sorted(keys)}, got {sorted(unknown)}")
    rows = df.withColumns({f"_key_{name}": value for name, value in keys.items()})
    named = {name: F.col(f"_key_{name}") for name in keys}
    grouped = rows.groupingSets([[named[name] for name in level] for level in levels], *named.values())
    values = [value.alias(name) for name, value in (metrics or fare_and_distance()).items()]
    found = grouped.agg(F.grouping_id(*named.values()).alias("grouping_id"), *values)
    return found.withColumnsRenamed({f"_key_{name}": name for name in keys})
