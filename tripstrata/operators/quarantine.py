"""Rows that the cleaning rules reject, each with the first rule that it fails.

The filters drop such rows silently.  Judging them instead lets a load be reconciled: what
came in is what was kept, plus what was rejected, plus copies.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.operators.columns import drop_columns, present_columns
from tripstrata.operators.quantiles import iqr_fences
from tripstrata.plans.rules import CleaningRules
from tripstrata.sources.writers import stage

REASON, COPIES = "rejected_by", "copies"


def row_checks(rows: DataFrame, rules: CleaningRules) -> Mapping[str, Column]:
    """The checks of the rules that look at one row, by name, in the order of ``silver``."""
    checks = {}
    for name in present_columns(rows, rules.valid_ranges):
        checks[f"valid_range:{name}"] = F.col(name).between(*rules.valid_ranges[name])
    for name in present_columns(rows, [rules.time_column]):
        first, last = (F.lit(day).cast(rows.schema[name].dataType) for day in rules.date_range)
        checks[f"time_range:{name}"] = (F.col(name) >= first) & (F.col(name) <= last)
    for name in present_columns(rows, rules.positive):
        checks[f"positive:{name}"] = F.col(name) > 0
    return checks


def _first_failing(checks: Mapping[str, Column]) -> Column:
    """Name of the first check that does not hold; a check on null does not hold."""
    return F.coalesce(
        *[F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in checks.items()],
        F.lit(None).cast("string"),
    )


def judge_rows(loaded: DataFrame, rules: CleaningRules, stage_path: str | None = None, relative_error: float = 0.05) -> DataFrame:
    """Each distinct row with ``copies``, how often it came, and ``rejected_by``.

    ``rejected_by`` is null for rows that ``silver`` keeps.  Outliers are judged last, on
    the rows that passed everything else, as there.  Copies are counted inside each task
    first; that is the one shuffle.  The fences read the judged rows a second time, so
    give a ``stage_path`` at scale.
    """
    rows = drop_columns(loaded, rules.drop) if rules.drop else loaded
    names = rows.columns
    rows = rows.groupBy(*[F.col(f"`{name}`") for name in names]).agg(F.count(F.lit(1)).alias(COPIES))
    rows = rows.withColumn(REASON, _first_failing(row_checks(rows, rules)))
    if stage_path:
        rows = stage(rows, stage_path)
    for name in present_columns(rows, rules.outliers):
        fences = iqr_fences(rows.filter(F.col(REASON).isNull()), name, relative_error).scalar()
        inside = F.coalesce(F.col(name).between(fences.getField("low"), fences.getField("high")), F.lit(False))
        rows = rows.withColumn(REASON, F.when(F.col(REASON).isNull() & ~inside, f"outlier:{name}").otherwise(F.col(REASON)))
    return rows


def quarantined(judged: DataFrame) -> DataFrame:
    """The rejected rows with their reason and number."""
    return judged.filter(F.col(REASON).isNotNull())


def reconcile(judged: DataFrame) -> DataFrame:
    """``outcome, rows``: how many rows were kept, were copies, or failed which rule first.

    The numbers add up to the rows that came in.
    """
    outcomes = judged.groupBy(F.coalesce(REASON, F.lit("kept")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(COPIES) - 1).alias("more")
    )
    pairs = F.array(F.struct("outcome", "rows"), F.struct(F.lit("copy").alias("outcome"), F.col("more").alias("rows")))
    return outcomes.select(F.inline(pairs)).groupBy("outcome").agg(F.sum("rows").alias("rows"))
