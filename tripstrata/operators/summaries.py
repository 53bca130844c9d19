"""Aggregates for reporting: per day, and per day and source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.operators.columns import common_columns


def day_of(column: str) -> Column:
    return F.to_date(F.col(column)).alias("date")


def daily_summary(
    df: DataFrame,
    time_column: str = "pickup_datetime",
    fare: str = "fare_amount",
    distance: str = "trip_distance",
    duration: str = "trip_duration",
) -> DataFrame:
    """One row per day, oldest first; a null day comes first of all."""
    # The names of the columns.
    return (
        df.groupBy(day_of(time_column))
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            F.sum(fare).alias("total_fare_amount"),
            F.avg(distance).alias("average_trip_distance"),
            F.avg(duration).alias("average_trip_duration"),
        )
        .sort("date")
    )


def union_common(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both tables on the columns they share; copies are kept.

    Types widen as in any union (int with double gives double); text meeting a
    number is cast to it, so unreadable text fails the job.
    """
    shared = common_columns(left, right)
    return left.select(*shared).unionByName(right.select(*shared))


def fare_and_distance(fare: str = "fare_amount", distance: str = "trip_distance") -> dict[str, Column]:
    """The metrics of the source comparison, by name."""
    # The names of the metrics.
    return {
        "avg_fare": F.avg(fare),
        "min_fare": F.min(fare),
        "max_fare": F.max(fare),
        "avg_trip_distance": F.avg(distance),
        "min_trip_distance": F.min(distance),
        "max_trip_distance": F.max(distance),
        "total_trips": F.count(F.lit(1)),
    }


def source_metrics(
    df: DataFrame,
    sources: Sequence[str] | None = None,
    time_column: str = "pickup_datetime",
    source_column: str = "source",
    metrics: Mapping[str, Column] | None = None,
    unlisted: str = "error",
) -> DataFrame:
    """One row per day, one column ``<source>_<metric>`` per pair.

    A row whose source is not among the named ``sources``, or null, fails the job;
    ``unlisted="drop"`` leaves it out of every column instead.  Name the ``sources``: the schema is then fixed and no job runs to find them.
    A day without trips of a source has null in all its columns, counts too.
    The pivot aggregates by (day, source) inside each task first, so a source
    with most of the rows shuffles no more than one row per day and task.
    """
    if unlisted not in ("error", "drop"):
        raise ValueError(f"unlisted must be error or drop, not {unlisted!r}")
    metrics = dict(metrics or fare_and_distance())
    if sources is not None and unlisted == "error":
        source = F.col(source_column)
        message = F.concat(F.lit("source is not listed: "), F.coalesce(source.cast("string"), F.lit("null")))
        known = F.when(source.isin(list(sources)), source).otherwise(F.raise_error(message))
        df = df.withColumn(source_column, known)
    pivoted = (
        df.groupBy(day_of(time_column))
        .pivot(source_column, list(sources) if sources is not None else None)
        .agg(*[value.alias(name) for name, value in metrics.items()])
    )
    if len(metrics) == 1:
        (only,) = metrics
        pivoted = pivoted.toDF("date", *[f"{name}_{only}" for name in pivoted.columns[1:]])
    return pivoted.sort("date")


def metric_series(
    comparison: DataFrame,
    sources: Sequence[str],
    metrics: Sequence[str] = ("avg_fare", "total_trips", "max_fare"),
) -> DataFrame:
    """The columns of a source comparison that one chart draws over time."""
    return comparison.select("date", *[f"{s}_{m}" for m in metrics for s in sources])


def preview(df: DataFrame, n: int, order_by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows; planned as top-n per task when an order is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
