"""Gold tables brought up to date load by load, from mergeable states.

A load leaves one small state for each day and source that it has trips of: counts,
sums, minima, maxima.  States lie under ``date=.../load=...``.  A load then merges the
states of the days it touches, of all loads, and replaces the gold rows of those days;
neither the trips of earlier loads nor other days are read.  Trips that arrive late for
an old day are a load that touches that day.

Repeating a load replaces its states, so it counts once.  Days that it had before and has
no longer get a state without trips.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.operators.summaries import day_of, source_metrics
from tripstrata.plans.flows import side_by_side
from tripstrata.sources.readers import read_layer
from tripstrata.sources.scratch import scratch_dir
from tripstrata.sources.writers import replace_partitions, stage, stored_schema

MEASURES = {"fare": "fare_amount", "distance": "trip_distance", "duration": "trip_duration"}
_PARTS = {"sum": "double", "count": "bigint", "min": "double", "max": "double"}
_STATE = {
    "source": "string",
    "trips": "bigint",
    **{f"{measure}_{part}": kind for measure in MEASURES for part, kind in _PARTS.items()},
    "date": "date",
    "load": "string",
}
STATE_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in _STATE.items())


def day_states(
    rows: DataFrame, time_column: str = "pickup_datetime", source_column: str = "source", measures: Mapping[str, str] = MEASURES
) -> DataFrame:
    """One mergeable state for each day and source; a measure that is absent stays null."""
    parts = []
    for name, column in measures.items():
        value = F.col(column).cast("double") if column in rows.columns else F.lit(None).cast("double")
        parts += [
            F.sum(value).alias(f"{name}_sum"), F.count(value).alias(f"{name}_count"),
            F.min(value).alias(f"{name}_min"), F.max(value).alias(f"{name}_max"),
        ]
    return rows.groupBy(day_of(time_column), F.col(source_column).cast("string").alias("source")).agg(
        F.count(F.lit(1)).alias("trips"), *parts
    )


def _mean(name: str) -> Column:
    return F.sum(f"{name}_sum") / F.nullif(F.sum(f"{name}_count"), F.lit(0))


def summary_of_states(states: DataFrame) -> DataFrame:
    """The daily summary; days without trips have a row of zero trips."""
    return states.groupBy("date").agg(
        F.sum("trips").alias("total_trips"),
        F.sum("fare_sum").alias("total_fare_amount"),
        _mean("distance").alias("average_trip_distance"),
        _mean("duration").alias("average_trip_duration"),
    )


def metrics_of_states(states: DataFrame, sources: Sequence[str]) -> DataFrame:
    """The comparison of sources, by day."""
    metrics = {
        "avg_fare": _mean("fare"),
        "min_fare": F.min("fare_min"),
        "max_fare": F.max("fare_max"),
        "avg_trip_distance": _mean("distance"),
        "min_trip_distance": F.min("distance_min"),
        "max_trip_distance": F.max("distance_max"),
        "total_trips": F.nullif(F.sum("trips"), F.lit(0)),
    }
    return source_metrics(states, sources, "date", "source", metrics)


def _on(dates: Sequence[date | None]) -> Column:
    """Of these days; with literals, so that other folders are not even listed for reading."""
    known = [d for d in dates if d is not None]
    found = F.col("date").isin(known) if known else F.lit(False)
    return found | F.col("date").isNull() if None in dates else found


def record_load(rows: DataFrame, load: str, path: str, **columns) -> list[date | None]:
    """Store the states of a load; returns the days that it touches or no longer does.

    The days of a load are few, so their list may pass through the driver.
    """
    spark = rows.sparkSession
    states = stage(day_states(rows, **columns), scratch_dir(spark, "day-states"))
    if stored_schema(spark, path) is not None:
        earlier = read_layer(spark, path, schema=STATE_SCHEMA).filter(F.col("load") == load).select("date", "source")
        gone = earlier.join(states.select("date").distinct(), earlier["date"].eqNullSafe(states["date"]), "left_anti")
        none = gone.distinct().withColumn("trips", F.lit(0).cast("long"))
        states = stage(states.unionByName(none, allowMissingColumns=True), scratch_dir(spark, "day-states"))
    ordered = states.withColumn("load", F.lit(load)).select(*_STATE)
    replace_partitions(ordered.repartition(32, "date"), path, ["date", "load"])
    return [row.date for row in states.select("date").distinct().collect()]


def refresh_days(spark: SparkSession, states: str, gold: str, dates: Sequence[date | None], sources: Sequence[str]) -> None:
    """Replace the gold rows of these days, from their states alone."""
    touched = read_layer(spark, states, schema=STATE_SCHEMA).filter(_on(dates))
    touched = stage(touched, scratch_dir(spark, "touched-days"))
    tables = {"daily_summary": summary_of_states(touched), "source_metrics": metrics_of_states(touched, sources)}

    def replace(name: str) -> None:
        replace_partitions(tables[name].repartition(32, "date"), f"{gold}/{name}", ["date"])

    side_by_side(spark, replace, list(tables))


def read_gold(spark: SparkSession, gold: str, name: str) -> DataFrame:
    """A gold table without the days that have lost all their trips."""
    table = read_layer(spark, f"{gold}/{name}")
    totals = [F.nullif(F.col(c), F.lit(0)) for c in table.columns if c.endswith("total_trips")]
    return table.filter(F.coalesce(*totals).isNotNull())


def advance_gold(rows: DataFrame, load: str, root: str, sources: Sequence[str], **columns) -> dict[str, DataFrame]:
    """Bring both gold tables up to date with a load of silver rows."""
    spark = rows.sparkSession
    dates = record_load(rows, load, f"{root}/states", **columns)
    if dates:
        refresh_days(spark, f"{root}/states", f"{root}/gold", dates, sources)
    return {name: read_gold(spark, f"{root}/gold", name) for name in ("daily_summary", "source_metrics")}
