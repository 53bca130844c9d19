"""Trip-shaped views over the generated tables.

``lineitem`` stands in for the first feed and ``orders`` for the second, under
the raw column names.  Each view is a projection of one whole table: no join and
no filter.  Dates are laid over one month, as in a monthly load, with a few days
beyond either end.  The expressions are common to Spark SQL and DuckDB but for
the name of the timestamp type, so both sides start from the same rows.  Measures
are multiples of 1/128: sums of doubles are then exact in any order, and averages
compare without rounding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SIGN = "CASE WHEN l_discount = 0 THEN -1 ELSE 1 END"
_EVE = "TIMESTAMP_NTZ '2023-12-31 00:00:00'"
_PICKUP = (
    f"{_EVE} + (day(l_shipdate) + l_linenumber - 4) * INTERVAL '1' DAY"
    " + (l_partkey % 1440) * INTERVAL '1' MINUTE"
)
YELLOW_COLUMNS = {
    "VendorID": "CAST(l_suppkey % 4 AS INT)",
    "tpep_pickup_datetime": _PICKUP,
    "tpep_dropoff_datetime": f"{_PICKUP} + CAST((l_quantity - 3) * 90 AS INT) * INTERVAL '1' SECOND",
    "passenger_count": "CAST(nullif(l_orderkey % 5, 4) AS DOUBLE)",
    "trip_distance": "CASE WHEN l_tax = 0 THEN 0 ELSE CAST(floor(l_extendedprice / l_quantity) AS DOUBLE) / 128 END",
    "RatecodeID": "CAST(nullif(l_partkey % 8, 7) AS DOUBLE)",
    "store_and_fwd_flag": "nullif(l_returnflag, 'R')",
    "PULocationID": "CAST(l_suppkey % 265 + 1 AS INT)",
    "DOLocationID": "CAST(l_partkey % 265 + 1 AS INT)",
    "payment_type": "CAST(l_linenumber - 2 AS BIGINT)",
    "fare_amount": f"({_SIGN}) * CAST(floor(l_extendedprice) AS DOUBLE) / 4",
    "extra": f"({_SIGN}) * CAST(l_linenumber AS DOUBLE) / 2",
    "mta_tax": f"({_SIGN}) * CAST(0.5 AS DOUBLE)",
    "tip_amount": "CAST(floor(l_quantity * 2) AS DOUBLE) / 8",
    "tolls_amount": "CAST(l_suppkey % 7 AS DOUBLE)",
    "improvement_surcharge": f"({_SIGN}) * CAST(1 AS DOUBLE)",
    "total_amount": f"({_SIGN}) * CAST(floor(l_extendedprice) + l_linenumber AS DOUBLE) / 4",
    "congestion_surcharge": f"({_SIGN}) * CAST(nullif(l_linenumber % 3, 0) AS DOUBLE)",
    "Airport_fee": f"({_SIGN}) * CAST(nullif(l_suppkey % 5, 0) AS DOUBLE) / 4",
}

_O_SIGN = "CASE WHEN o_custkey % 11 = 0 THEN -1 ELSE 1 END"
_O_PICKUP = (
    f"{_EVE} + (day(o_orderdate) + o_custkey % 7 - 3) * INTERVAL '1' DAY"
    " + (o_orderkey % 1440) * INTERVAL '1' MINUTE"
)
GREEN_COLUMNS = {
    "VendorID": "CAST(o_custkey % 4 AS INT)",
    "lpep_pickup_datetime": _O_PICKUP,
    "lpep_dropoff_datetime": f"{_O_PICKUP} + (o_custkey % 97 - 5) * INTERVAL '1' MINUTE",
    "store_and_fwd_flag": "nullif(o_orderstatus, 'P')",
    "RatecodeID": "CAST(nullif(o_orderkey % 8, 7) AS DOUBLE)",
    "PULocationID": "CAST(o_custkey % 265 + 1 AS INT)",
    "DOLocationID": "CAST(o_orderkey % 265 + 1 AS INT)",
    "passenger_count": "CAST(nullif(o_orderkey % 5, 4) AS DOUBLE)",
    "trip_distance": "CAST(floor(o_totalprice / (o_custkey % 50 + 1)) AS DOUBLE) / 128",
    "fare_amount": f"({_O_SIGN}) * CAST(floor(o_totalprice) AS DOUBLE) / 4",
    "extra": f"({_O_SIGN}) * CAST(o_custkey % 3 AS DOUBLE) / 2",
    "mta_tax": f"({_O_SIGN}) * CAST(0.5 AS DOUBLE)",
    "tip_amount": "CAST(o_custkey % 40 AS DOUBLE) / 4",
    "tolls_amount": "CAST(o_custkey % 7 AS DOUBLE)",
    "ehail_fee": "CAST(NULL AS DOUBLE)",
    "improvement_surcharge": f"({_O_SIGN}) * CAST(1 AS DOUBLE)",
    "total_amount": f"({_O_SIGN}) * CAST(floor(o_totalprice) + o_custkey % 3 AS DOUBLE) / 4",
    "payment_type": "CAST(nullif(o_custkey % 8 - 1, 6) AS DOUBLE)",
    "trip_type": "CAST(o_custkey % 2 + 1 AS DOUBLE)",
    "congestion_surcharge": f"({_O_SIGN}) * CAST(nullif(o_custkey % 3, 0) AS DOUBLE)",
}

EVENT_COLUMNS = {
    "pickup_datetime": "ts",
    "source": "event_type",
    "fare_amount": "CAST(round(value * 100) AS DOUBLE)",
    "trip_distance": "CAST(user_id AS DOUBLE) / 8",
}
EVENT_SOURCES = ("click", "error", "purchase", "signup", "view")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select_list(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]


def yellow_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*_select_list(YELLOW_COLUMNS))


def green_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_select_list(GREEN_COLUMNS))


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*_select_list(EVENT_COLUMNS))


def sql_view(columns: dict[str, str], name: str) -> str:
    select_list = ", ".join(_select_list(columns)).replace("TIMESTAMP_NTZ", "TIMESTAMP")
    return f"SELECT {select_list} FROM {name}"


YELLOW_SQL = sql_view(YELLOW_COLUMNS, "lineitem")
GREEN_SQL = sql_view(GREEN_COLUMNS, "orders")
EVENT_SQL = sql_view(EVENT_COLUMNS, "events")
