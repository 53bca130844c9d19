"""Quantiles as one-row DataFrames, so that callers stay lazy."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUARTILES = (0.25, 0.75)

# Exact order statistics without sorting the column or meeting it in one task.
#
# Values are first collapsed to (value, count), with map-side combining, so a
# value that fills a third of the column is one row.  Four steps then close in on
# the rank: cells of 1/64 octave, twice 2^16 equal parts of the values that are
# left, and those values themselves.  All keys are monotone in the value.  Only
# histogram rows meet in a window: under 140,000 cells of either sign in the first,
# 2^16 + 1 parts in the next two, and in the last no more than 2^14 doubles, since a
# cell holds at most 2^46.  The broadcast side has one row per probability.
#
# The cell is coalesced because it is then provably non-null: no filter is inferred
# below the shuffle of `counts`, and its uses share one shuffle.
_EXACT = """
WITH counts AS (
  SELECT v, count(*) AS n
  FROM {values}
  WHERE v IS NOT NULL AND NOT isnan(v)
  GROUP BY v
),
by_octave AS (
  SELECT v, n, greatest(least(v, __LARGEST__), -__LARGEST__) AS f,
         coalesce(CASE WHEN v > 0 THEN 70000 + floor(64 * log2(least(v, __LARGEST__)))
                       WHEN v < 0 THEN -70000 - floor(64 * log2(least(-v, __LARGEST__)))
                  END, 0L) AS cell
  FROM counts
),
cells AS (
  SELECT cell, low, high, n, sum(n) OVER (ORDER BY cell) AS upto, sum(n) OVER () AS total
  FROM (SELECT cell, min(f) AS low, max(f) AS high, sum(n) AS n FROM by_octave GROUP BY cell)
),
in_cell AS (
  SELECT p, cell, low, high, rank - upto + n AS rank
  FROM (SELECT cell, low, high, n, upto, p, greatest(ceil(p * total), 1L) AS rank
        FROM cells LATERAL VIEW explode(array(__PROBABILITIES__)) AS p)
  WHERE upto - n < rank AND rank <= upto
),
__FIRST__,
__SECOND__,
doubles AS (
  SELECT /*+ BROADCAST(second_in) */ p, rank, v, n, sum(n) OVER (PARTITION BY p ORDER BY v) AS upto
  FROM by_octave JOIN second_in USING (cell)
  WHERE f BETWEEN low AND high
)
SELECT array(__PICKED__) AS quantiles
FROM doubles
WHERE upto - n < rank AND rank <= upto
"""
_LARGEST = "1.7976931348623157E308D"


def _narrowed(name: str, before: str) -> str:
    """Equal parts of the values between ``low`` and ``high``, and the one with the rank."""
    return f"""{name} AS (
  SELECT p, rank, cell, part, low, high, n, sum(n) OVER (PARTITION BY p ORDER BY part) AS upto
  FROM (SELECT /*+ BROADCAST({before}) */ p, rank, cell, min(f) AS low, max(f) AS high, sum(n) AS n,
               CASE WHEN high > low THEN floor((f - low) / (high - low) * 65536) ELSE 0L END AS part
        FROM by_octave JOIN {before} USING (cell)
        WHERE f BETWEEN low AND high
        GROUP BY p, rank, cell, CASE WHEN high > low THEN floor((f - low) / (high - low) * 65536) ELSE 0L END)
),
{name}_in AS (
  SELECT p, cell, low, high, rank - upto + n AS rank
  FROM {name}
  WHERE upto - n < rank AND rank <= upto
)"""


def _exact_quantiles(values: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    picked = ", ".join(f"max(v) FILTER (WHERE p = {p!r}D)" for p in probabilities)
    sought = ", ".join(f"{p!r}D" for p in sorted(set(probabilities)))
    query = _EXACT.replace("__FIRST__", _narrowed("first", "in_cell"))
    query = query.replace("__SECOND__", _narrowed("second", "first_in")).replace("__LARGEST__", _LARGEST)
    query = query.replace("__PROBABILITIES__", sought).replace("__PICKED__", picked)
    return values.sparkSession.sql(query, values=values)


def quantile_bounds(
    df: DataFrame,
    column: str,
    probabilities: Sequence[float] = QUARTILES,
    relative_error: float = 0.05,
) -> DataFrame:
    """One row, one array column ``quantiles``, in the order of ``probabilities``.

    ``relative_error`` bounds the rank error as a share of the rows.  Above zero
    it is a sketch of about ``1 / relative_error`` entries per task, merged in
    one final task.  At zero the answer is the exact nearest-rank value; that
    costs one shuffle of the distinct values, and no task sees them all.
    Null and NaN do not count.  An empty input gives nulls.  Values are compared as
    doubles: at zero error, a long or decimal that no double equals fails the job.
    """
    probabilities = [float(p) for p in probabilities]
    if not probabilities or not all(0 <= p <= 1 for p in probabilities):
        raise ValueError(f"probabilities must lie in [0, 1]: {probabilities}")
    if not 0 <= relative_error < 1:
        raise ValueError(f"relative_error must lie in [0, 1): {relative_error}")
    value, kind = F.col(column), df.schema[column].dataType
    double = value.cast("double")
    if relative_error == 0 and isinstance(kind, (T.LongType, T.DecimalType)):
        message = F.concat(F.lit(f"{column} has a value that is no double: "), value.cast("string"))
        double = F.when(double.try_cast(kind) == value, double).when(value.isNotNull(), F.raise_error(message))
    values = df.select(double.alias("v"))
    if relative_error == 0:
        return _exact_quantiles(values, probabilities)
    sketch = F.percentile_approx("v", probabilities, math.ceil(1 / relative_error))
    found = values.filter("v IS NOT NULL AND NOT isnan(v)").agg(sketch.alias("found"))
    empty = F.array_repeat(F.lit(None).cast("double"), len(probabilities))
    return found.select(F.coalesce("found", empty).alias("quantiles"))


def iqr_fences(
    df: DataFrame,
    column: str,
    relative_error: float = 0.05,
    whisker: float = 1.5,
) -> DataFrame:
    """One row, one struct column ``fences`` with ``low`` and ``high``."""
    quartiles = quantile_bounds(df, column, QUARTILES, relative_error)
    spread = f"{float(whisker)!r}D * (quantiles[1] - quantiles[0])"
    return quartiles.selectExpr(
        f"named_struct('low', quantiles[0] - {spread}, 'high', quantiles[1] + {spread}) AS fences"
    )
