"""New columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.functions.expressions import minutes_between, ratio_or_zero
from tripstrata.operators.columns import present_columns


def add_ingest_metadata(df: DataFrame, source: str, as_of: str | date | None = None) -> DataFrame:
    """Stamp the load date (today unless given) and the name of the feed."""
    day = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return df.withColumns({"ingest_date": day, "source": F.lit(source)})


def add_trip_duration(
    df: DataFrame,
    start: str = "pickup_datetime",
    end: str = "dropoff_datetime",
    missing: str = "warn",
) -> DataFrame:
    """``trip_duration`` in minutes.  Reversed trips come out negative and stay."""
    if len(present_columns(df, [start, end], missing)) < 2:
        return df
    return df.withColumns({"trip_duration": minutes_between(F.col(start), F.col(end))})


def add_fare_per_mile(
    df: DataFrame,
    fare: str = "fare_amount",
    distance: str = "trip_distance",
    missing: str = "warn",
) -> DataFrame:
    """``fare_per_mile``; zero where the distance is not positive or unknown."""
    if len(present_columns(df, [fare, distance], missing)) < 2:
        return df
    return df.withColumns({"fare_per_mile": ratio_or_zero(F.col(fare), F.col(distance))})
