"""Column statistics as mergeable states, kept by load.

A load is read once and leaves one small row per column: counts, a sketch of its
quantiles and a sketch of its distinct values.  Statistics over any loads come from
merging those rows; the loads themselves are not read again.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.operators.columns import present_columns
from tripstrata.operators.quantiles import QUARTILES
from tripstrata.sources.readers import read_layer
from tripstrata.sources.writers import replace_partitions

STATE_SCHEMA = "`column` string, n long, n_null long, quantiles binary, distinct_values binary, load string"
# Entries of a quantile sketch; its rank error is about 2.3 / K ** 0.9, 0.8 % of the rows.
K = 800
# Two to this many registers; the standard error of a distinct count is 0.8 %.
REGISTERS = 14


def _double(df: DataFrame, column: str) -> Column:
    """The values that have a rank: null and NaN have none."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value), value)


def column_states(df: DataFrame, quantiles_of: Iterable[str], distinct_of: Iterable[str], missing: str = "warn") -> DataFrame:
    """``column, n, n_null, quantiles, distinct_values``, one row per column, in one pass.

    ``n`` counts the values that have a rank where quantiles are kept, else all that are
    not null.  A sketch that was not asked for, or has no values, is null.  Tasks combine their rows
    first, so one small row per task is shuffled.
    """
    ranked = present_columns(df, quantiles_of, missing)
    counted = present_columns(df, distinct_of, missing)
    names = list(dict.fromkeys([*ranked, *counted]))
    if not names:
        raise ValueError("no columns to keep states of")
    nothing = F.lit(None).cast("binary")
    states = []
    for name in names:
        value = _double(df, name) if name in ranked else F.col(f"`{name}`")
        n = F.count(value)
        sketch = F.when(n > 0, F.kll_sketch_agg_double(value, K)) if name in ranked else nothing
        # Doubles have no sketch of their own; equal numbers have equal texts once the zeros are one.
        seen = F.col(f"`{name}`")
        plain = (seen + 0.0).cast("string") if df.schema[name].dataType.typeName() in ("double", "float") else seen.cast("string")
        distinct = F.when(F.count(seen) > 0, F.hll_sketch_agg(plain, REGISTERS)) if name in counted else nothing
        states.append(
            F.struct(
                F.lit(name).alias("column"),
                n.alias("n"),
                F.count_if(seen.isNull()).alias("n_null"),
                sketch.alias("quantiles"),
                distinct.alias("distinct_values"),
            )
        )
    return df.agg(F.array(*states).alias("states")).select(F.inline("states"))


def record_states(
    df: DataFrame, load: str, path: str, quantiles_of: Iterable[str], distinct_of: Iterable[str], missing: str = "warn"
) -> None:
    """Write the states of a load in place of those that it had; other loads stay."""
    states = column_states(df, quantiles_of, distinct_of, missing)
    replace_partitions(states.withColumn("load", F.lit(load)), path, ["load"])


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return read_layer(spark, path, schema=STATE_SCHEMA)


def merge_states(states: DataFrame) -> DataFrame:
    """``column, n, n_null, n_distinct, quantiles`` over all loads of ``states``.

    ``n_distinct`` is an estimate; it and the sketch are null where no load kept one.
    """
    return states.groupBy("column").agg(
        F.sum("n").alias("n"),
        F.sum("n_null").alias("n_null"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_values")).alias("n_distinct"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )


def merged_quantiles(states: DataFrame, probabilities: Sequence[float] = QUARTILES) -> DataFrame:
    """``column, n, quantiles``: arrays in the order of ``probabilities``; columns with values only."""
    ranks = F.array(*[F.lit(float(p)) for p in probabilities])
    merged = states.filter("quantiles IS NOT NULL").groupBy("column").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("quantiles").alias("sketch")
    )
    return merged.select("column", "n", F.kll_sketch_get_quantile_double("sketch", ranks).alias("quantiles"))


def merged_fences(states: DataFrame, column: str, whisker: float = 1.5) -> DataFrame:
    """One row, one struct ``fences`` with ``low`` and ``high``; none without values."""
    found = merged_quantiles(states.filter(F.col("column") == column))
    low, high = F.get("quantiles", F.lit(0)), F.get("quantiles", F.lit(1))
    reach = (high - low) * F.lit(float(whisker))
    return found.select(F.struct((low - reach).alias("low"), (high + reach).alias("high")).alias("fences"))
