"""The registered queries in DuckDB SQL, written from the operator definitions."""

from __future__ import annotations

from tripstrata.catalog.views import (
    EVENT_SOURCES,
    EVENT_SQL,
    GREEN_COLUMNS,
    GREEN_SQL,
    YELLOW_COLUMNS,
    YELLOW_SQL,
)
from tripstrata.plans.rules import MONEY_COLUMNS, RATE_CODES, VENDORS

_YELLOW_WITH = f"WITH yellow AS ({YELLOW_SQL})"
_EVENTS_WITH = f"WITH trips AS ({EVENT_SQL})"
_WINDOW = "BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31'"

# Snake-case names of the raw columns, spelled out for comparison.
_SNAKE = {
    "VendorID": "vendor_id",
    "RatecodeID": "ratecode_id",
    "PULocationID": "pulocation_id",
    "DOLocationID": "dolocation_id",
    "Airport_fee": "airport_fee",
}


def _values(rows: tuple[tuple[int, str], ...]) -> str:
    return ", ".join(f"({key}, '{name}')" for key, name in rows)


def _fences(source: str, column: str) -> str:
    return (
        f"SELECT q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM "
        f"(SELECT quantile_disc({column}, 0.25) AS q1, quantile_disc({column}, 0.75) AS q3 FROM {source})"
    )


def _pivot(source: str, time_column: str, names: tuple[str, ...], extra: str = "") -> str:
    metrics = {
        "avg_fare": "avg(fare_amount)",
        "min_fare": "min(fare_amount)",
        "max_fare": "max(fare_amount)",
        "avg_trip_distance": "avg(trip_distance)",
        "min_trip_distance": "min(trip_distance)",
        "max_trip_distance": "max(trip_distance)",
        "total_trips": "count(*)",
    }
    columns = []
    for name in names:
        for metric, call in metrics.items():
            value = f"{call} FILTER (WHERE source = '{name}')"
            value = f"nullif({value}, 0)" if metric == "total_trips" else value
            columns.append(f"{value} AS {name}_{metric}")
    return (
        f"SELECT CAST({time_column} AS DATE) AS date, {', '.join(columns)} "
        f"FROM {source} {extra} GROUP BY 1"
    )


def _silver(raw: str, columns: dict[str, str], source: str, start: str, end: str, drop: str = "") -> str:
    """CTEs that end in ``<source>_silver``."""
    replaced = {start, end, drop}
    kept = []
    for name in [*columns, "ingest_date", "source"]:
        if name in replaced:
            continue
        value = name
        if name == "store_and_fwd_flag":
            value = f"coalesce({name}, 'N')"
        elif name == "payment_type":
            value = f"CASE WHEN {name} >= 0 THEN {name} + 1 END"
        elif name in MONEY_COLUMNS:
            value = f"abs({name})"
        kept.append(f"{value} AS {_SNAKE.get(name, name)}")
    excluded = f"EXCLUDE ({drop})" if drop else ""
    return f"""
{source}_rows AS (
  SELECT DISTINCT * {excluded}, DATE '2024-02-01' AS ingest_date, '{source}' AS source FROM ({raw})
),
{source}_valid AS (
  SELECT * FROM {source}_rows
  WHERE VendorID BETWEEN 1 AND 2 AND RatecodeID BETWEEN 1 AND 6 AND payment_type BETWEEN 1 AND 5
    AND {start} {_WINDOW}
    AND passenger_count > 0 AND trip_distance > 0
),
{source}_fences AS ({_fences(f"{source}_valid", "trip_distance")}),
{source}_silver AS (
  SELECT {', '.join(kept)},
         {start} AS pickup_datetime, {end} AS dropoff_datetime,
         CAST(date_diff('second', {start}, {end}) AS DOUBLE) / 60 AS trip_duration,
         CASE WHEN trip_distance > 0 THEN abs(fare_amount) / trip_distance ELSE 0 END AS fare_per_mile
  FROM {source}_valid, {source}_fences
  WHERE trip_distance BETWEEN low AND high
)"""


_YELLOW_SILVER = _silver(
    YELLOW_SQL, YELLOW_COLUMNS, "yellow", "tpep_pickup_datetime", "tpep_dropoff_datetime"
)
_GREEN_SILVER = _silver(
    GREEN_SQL, GREEN_COLUMNS, "green", "lpep_pickup_datetime", "lpep_dropoff_datetime", "ehail_fee"
)

_DAILY = f"""{_YELLOW_WITH}
SELECT CAST(tpep_pickup_datetime AS DATE) AS date,
       count(*) AS total_trips,
       sum(fare_amount) AS total_fare_amount,
       avg(trip_distance) AS average_trip_distance,
       avg(CAST(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS DOUBLE) / 60)
         AS average_trip_duration
FROM yellow GROUP BY 1"""

_CLEAN_V1_COLUMNS = ", ".join(
    f"abs({name}) AS {name}"
    if name in MONEY_COLUMNS
    else f"coalesce({name}, 'N') AS {name}"
    if name == "store_and_fwd_flag"
    else f"CASE WHEN {name} >= 0 THEN {name} + 1 END AS {name}"
    if name == "payment_type"
    else name
    for name in YELLOW_COLUMNS
)


def _profile(name: str, numeric: bool) -> str:
    mean = f"round(avg({name}), 3)" if numeric else "CAST(NULL AS DOUBLE)"
    spread = f"round(stddev_samp({name}), 3)" if numeric else "CAST(NULL AS DOUBLE)"
    return (
        f"SELECT '{name}' AS column_name, count({name}) AS value_count, {mean} AS mean, "
        f"{spread} AS stddev, CAST(min({name}) AS VARCHAR) AS min, CAST(max({name}) AS VARCHAR) AS max, "
        f"count(DISTINCT {name}) AS unique_count, count(*) FILTER (WHERE {name} IS NULL) AS null_count "
        "FROM orders"
    )


_ORDER_COLUMNS = {
    "o_orderkey": True,
    "o_custkey": True,
    "o_orderstatus": False,
    "o_totalprice": True,
    "o_orderdate": False,
    "o_orderpriority": False,
}

_TWO_LOADS = """
SELECT *, CAST(NULL AS DOUBLE) AS c_debt, DATE '2024-02-01' AS ingest_date, 'first' AS source FROM customer
UNION ALL BY NAME
SELECT *, -c_acctbal AS c_debt, DATE '2024-02-02' AS ingest_date, 'second' AS source FROM customer"""

_FLOW_METRICS = f"""WITH {_YELLOW_SILVER}, {_GREEN_SILVER},
trips AS (
  SELECT pickup_datetime, source, fare_amount, trip_distance FROM yellow_silver
  UNION ALL
  SELECT pickup_datetime, source, fare_amount, trip_distance FROM green_silver
)
SELECT * FROM ({_pivot("trips", "pickup_datetime", ("yellow", "green"))})
WHERE date <> DATE '2024-01-31'"""



def daily_sql() -> str:
    """The daily summary of all trips of the first feed."""
    return _DAILY


def events_sql() -> str:
    """The events as ``trips``, to begin a query with."""
    return _EVENTS_WITH


def pivot_sql(source: str, time_column: str, names: tuple[str, ...]) -> str:
    return _pivot(source, time_column, names)


ORACLE: dict[str, str] = {
    "scan_parquet": "SELECT * FROM orders",
    "scan_csv": "SELECT * FROM customer",
    "dim_literal": f"""{_YELLOW_WITH},
vendors(vendor_id, vendor_name) AS (VALUES {_values(VENDORS)}),
rate_codes(rate_code_id, rate_description) AS (VALUES {_values(RATE_CODES)}),
per_code AS (
  SELECT CAST(VendorID AS BIGINT) AS vendor_id, CAST(RatecodeID AS BIGINT) AS rate_code_id,
         count(*) AS total_trips
  FROM yellow GROUP BY ALL
)
SELECT per_code.vendor_id, per_code.rate_code_id, total_trips, vendor_name, rate_description
FROM per_code LEFT JOIN vendors USING (vendor_id) LEFT JOIN rate_codes USING (rate_code_id)""",
    "dim_overwrite": f"""
SELECT 'dim_location' AS dimension, s_suppkey AS id, s_name AS name,
       s_nationkey AS region_id, s_acctbal AS account_balance FROM supplier
UNION ALL BY NAME
SELECT 'dim_vendor' AS dimension, CAST(id AS BIGINT) AS id, name FROM (VALUES {_values(VENDORS)}) t(id, name)
UNION ALL BY NAME
SELECT 'dim_rate_code' AS dimension, CAST(id AS BIGINT) AS id, name FROM (VALUES {_values(RATE_CODES)}) t(id, name)""",
    "ingest_metadata": "SELECT *, DATE '2024-02-01' AS ingest_date, 'orders' AS source FROM orders",
    "bronze_append": _TWO_LOADS,
    "compact_evolved": _TWO_LOADS,
    "register_evolved": _TWO_LOADS,
    "silver_append": """
SELECT *, DATE '2024-02-01' AS ingest_date, 'customer' AS source FROM customer
UNION ALL BY NAME
SELECT *, DATE '2024-02-02' AS ingest_date, 'customer' AS source FROM customer""",
    "gold_overwrite": _DAILY,
    "gold_published": _DAILY,
    "staged_bronze": "SELECT *, DATE '2024-02-01' AS ingest_date, 'part' AS source FROM part",
    "register_table": "SELECT * FROM part",
    "compact_table": "SELECT * FROM orders",
    "snake_case_columns": f"""{_YELLOW_WITH}
SELECT {', '.join(f'{name} AS {_SNAKE.get(name, name)}' for name in YELLOW_COLUMNS)} FROM yellow""",
    "drop_columns": "SELECT p_partkey, p_name, p_type, p_retailprice FROM part",
    "filter_valid_range": f"""{_YELLOW_WITH}
SELECT * FROM yellow
WHERE VendorID BETWEEN 1 AND 2 AND RatecodeID BETWEEN 1 AND 6 AND payment_type BETWEEN 1 AND 5""",
    "filter_positive": "SELECT * FROM customer WHERE c_acctbal > 0",
    "filter_time_range": """
SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts <= TIMESTAMP '2024-01-22'""",
    "quantile_bounds": """
SELECT quantile_disc(l_extendedprice, 0.25) AS q1, quantile_disc(l_extendedprice, 0.75) AS q3
FROM lineitem""",
    "quantile_sketch": "SELECT * FROM (VALUES (0.25::DOUBLE, true), (0.75::DOUBLE, true)) t(p, within)",
    "filter_iqr": f"""
WITH fences AS ({_fences("events", "value")})
SELECT events.* FROM events, fences WHERE value BETWEEN low AND high""",
    "exclude_dates": f"""{_EVENTS_WITH}
SELECT * FROM ({_pivot("trips", "pickup_datetime", EVENT_SOURCES)})
WHERE date <> DATE '2024-01-30' AND date <> DATE '2024-01-03'""",
    "fill_na": f"""{_YELLOW_WITH}
SELECT * REPLACE (coalesce(store_and_fwd_flag, 'N') AS store_and_fwd_flag) FROM yellow""",
    "abs_negatives": "SELECT * REPLACE (abs(c_acctbal) AS c_acctbal) FROM customer",
    "shift_code": f"""{_YELLOW_WITH}
SELECT * REPLACE (CASE WHEN payment_type >= 0 THEN payment_type + 1 END AS payment_type) FROM yellow""",
    "parse_timestamps": """
SELECT o_orderkey, o_orderdate AS dropoff_datetime,
       try_strptime(CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y/%m/%d')
                         ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END,
                    '%Y-%m-%d %H:%M:%S') AS pickup_datetime
FROM orders""",
    "trip_duration": f"""{_YELLOW_WITH}
SELECT *, CAST(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS DOUBLE) / 60
          AS trip_duration FROM yellow""",
    "fare_per_mile": f"""{_YELLOW_WITH}
SELECT *, CASE WHEN trip_distance > 0 THEN fare_amount / trip_distance ELSE 0 END AS fare_per_mile
FROM yellow""",
    "clean_v1": f"""{_YELLOW_WITH},
counted AS (SELECT * FROM yellow WHERE VendorID BETWEEN 1 AND 2 AND passenger_count > 0),
fences AS ({_fences("counted", "trip_distance")}),
inside AS (SELECT counted.* FROM counted, fences WHERE trip_distance BETWEEN low AND high)
SELECT {_CLEAN_V1_COLUMNS} FROM inside WHERE RatecodeID BETWEEN 1 AND 6""",
    "dedup_rows": "SELECT DISTINCT * FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer)",
    "dedup_across_loads": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'customer' AS source,
       min(ingest_date) AS ingest_date
FROM customer, (VALUES (DATE '2024-02-01'), (DATE '2024-02-02')) loads(ingest_date)
GROUP BY ALL""",
    "daily_summary": _DAILY,
    "union_common": f"""{_YELLOW_WITH}, green AS ({GREEN_SQL})
SELECT {', '.join(name for name in YELLOW_COLUMNS if name in GREEN_COLUMNS)} FROM yellow
UNION ALL
SELECT {', '.join(name for name in YELLOW_COLUMNS if name in GREEN_COLUMNS)} FROM green""",
    "source_metrics": f"""{_EVENTS_WITH}
{_pivot("trips", "pickup_datetime", EVENT_SOURCES)}""",
    "preview": "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 31",
    "column_profile": " UNION ALL ".join(_profile(*item) for item in _ORDER_COLUMNS.items()),
    "histogram": """
WITH extent AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
counts AS (
  SELECT least(CAST(floor((l_extendedprice - lo) / ((hi - lo) / 50)) AS BIGINT), 49) AS bin, count(*) AS n
  FROM lineitem, extent GROUP BY 1
)
SELECT bins.bin, lo + bins.bin * ((hi - lo) / 50) AS low, lo + (bins.bin + 1) * ((hi - lo) / 50) AS high,
       coalesce(n, 0) AS n
FROM range(50) bins(bin) CROSS JOIN extent LEFT JOIN counts USING (bin)""",
    "histogram_2d": """
WITH extent AS (
  SELECT min(l_extendedprice) AS x_lo, max(l_extendedprice) AS x_hi,
         min(l_quantity) AS y_lo, max(l_quantity) AS y_hi FROM lineitem
)
SELECT least(CAST(floor((l_extendedprice - x_lo) / ((x_hi - x_lo) / 50)) AS BIGINT), 49) AS x_bin,
       least(CAST(floor((l_quantity - y_lo) / ((y_hi - y_lo) / 5)) AS BIGINT), 4) AS y_bin,
       count(*) AS n
FROM lineitem, extent GROUP BY 1, 2""",
    "metric_series": f"""{_EVENTS_WITH}
SELECT date, {', '.join(f'{s}_{m}' for m in ('avg_fare', 'total_trips', 'max_fare') for s in EVENT_SOURCES)}
FROM ({_pivot("trips", "pickup_datetime", EVENT_SOURCES)})""",
    "silver_yellow": f"WITH {_YELLOW_SILVER} SELECT * FROM yellow_silver",
    "silver_green": f"WITH {_GREEN_SILVER} SELECT * FROM green_silver",
    "medallion": _FLOW_METRICS,
    "medallion_across_loads": _FLOW_METRICS,
    "medallion_daily": f"""WITH {_YELLOW_SILVER}
SELECT CAST(pickup_datetime AS DATE) AS date, count(*) AS total_trips, sum(fare_amount) AS total_fare_amount,
       avg(trip_distance) AS average_trip_distance, avg(trip_duration) AS average_trip_duration
FROM yellow_silver GROUP BY 1""",
}
