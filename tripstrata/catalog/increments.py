"""Queries that work load by load, as a stream, or account for every row."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.catalog.oracle import daily_sql, events_sql, pivot_sql
from tripstrata.catalog.views import EVENT_SOURCES, GREEN_SQL, YELLOW_SQL, event_trips, green_raw, table, yellow_raw
from tripstrata.operators.corrections import parse_timestamps
from tripstrata.operators.enrich import add_ingest_metadata, add_trip_duration
from tripstrata.operators.quarantine import judge_rows, quarantined, reconcile
from tripstrata.operators.states import merge_states, merged_quantiles, read_states, record_states
from tripstrata.operators.summaries import union_common
from tripstrata.operators.totals import totals
from tripstrata.operators.validity import join_valid
from tripstrata.plans import history, incremental
from tripstrata.plans.rules import GREEN, YELLOW
from tripstrata.sources.clustering import cluster_table, file_ranges
from tripstrata.sources.readers import read_layer
from tripstrata.sources.scratch import scratch_dir
from tripstrata.streaming import ingest, summary

AS_OF = "2024-02-01"


def _yellow_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = yellow_raw(spark, sf_dir).transform(parse_timestamps, YELLOW.timestamps)
    return add_trip_duration(trips).withColumn("source", F.lit("yellow"))


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads, the last with late trips; the first came whole, then again as it should."""
    trips, root = _yellow_trips(spark, sf_dir), scratch_dir(spark, "incremental")
    day = F.dayofmonth("pickup_datetime")
    load = F.when((day <= 10) & (F.col("DOLocationID") % 7 != 0), "a").when((day > 10) & (day <= 20), "b").otherwise("c")
    incremental.advance_gold(trips, "a", root, ["yellow"])
    for name in ("a", "b", "c", "b"):
        gold = incremental.advance_gold(trips.filter(load == name), name, root, ["yellow"])
    return gold["daily_summary"]


def gold_incremental_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every load touches all days."""
    trips, root = event_trips(spark, sf_dir), scratch_dir(spark, "incremental")
    for number in range(3):
        part = trips.filter(F.col("fare_amount") % 3 == number)
        gold = incremental.advance_gold(part, f"load {number}", root, EVENT_SOURCES)
    return gold["source_metrics"]


def dedup_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads that share most rows; the second comes twice."""
    customers = table(spark, sf_dir, "customer")
    root, name = scratch_dir(spark, "history"), f"digests_{uuid4().hex}"
    history.open_history(spark, name, f"{root}/digests", buckets=8)
    changed = F.when(F.col("c_custkey") % 5 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    loads = {
        "2024-02-01": customers.filter("c_custkey % 3 <> 0").unionByName(customers.filter("c_custkey % 3 = 1")),
        "2024-02-02": customers,
        "2024-02-03": customers.withColumn("c_acctbal", changed),
    }
    for load in ("2024-02-01", "2024-02-02", "2024-02-03", "2024-02-02"):
        stored = history.append_new(loads[load], f"{root}/rows", name, load)
    spark.sql(f"DROP TABLE {name}")
    return stored


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files arrive twice; the stream runs after each, and its last batch is repeated."""
    orders, root = table(spark, sf_dir, "orders"), scratch_dir(spark, "stream")
    write = ingest.bronze_batch("orders", f"{root}/bronze", AS_OF)
    for rest in range(2):
        part = orders.filter(F.col("o_orderkey") % 2 == rest)
        part.write.mode("append").parquet(f"{root}/arrived")
        stream = ingest.read_files(spark, f"{root}/arrived", orders.schema)
        ingest.stream_bronze(stream, "orders", f"{root}/bronze", f"{root}/checkpoint", AS_OF).awaitTermination()
    write(part, 1)
    return read_layer(spark, f"{root}/bronze").drop(ingest.BATCH)


def _second(trips: DataFrame) -> Column:
    return (F.dayofmonth("pickup_datetime") > 15) | (F.col("trip_distance") * 8 % 10 == 0)


def _streamed(spark: SparkSession, sf_dir: str) -> str:
    """Trips arrive twice; some of the second arrival are late."""
    trips, root = event_trips(spark, sf_dir), scratch_dir(spark, "stream-summary")
    for part in (trips.filter(~_second(trips)), trips.filter(_second(trips))):
        part.write.mode("append").parquet(f"{root}/arrived")
        stream = ingest.read_files(spark, f"{root}/arrived", trips.schema)
        summary.stream_summary(stream, root, f"{root}/checkpoint", EVENT_SOURCES).awaitTermination()
    summary.summary_batch(root, EVENT_SOURCES)(part, 1)
    return root


def stream_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.read_gold(spark, f"{_streamed(spark, sf_dir)}/gold", "source_metrics")


def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.late_rows(spark, _streamed(spark, sf_dir))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some trips came twice."""
    trips = yellow_raw(spark, sf_dir)
    loaded = trips.unionByName(trips.filter("PULocationID % 3 = 0"))
    return judge_rows(loaded, YELLOW, scratch_dir(spark, "judged"), relative_error=0)


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantined(_judged(spark, sf_dir))


def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile(_judged(spark, sf_dir))


def totals_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By day, source and vendor, with all the totals above."""
    feeds = [
        add_ingest_metadata(raw(spark, sf_dir).transform(parse_timestamps, rules.timestamps), source, AS_OF)
        for raw, rules, source in ((yellow_raw, YELLOW, "yellow"), (green_raw, GREEN, "green"))
    ]
    keys = {"date": F.to_date("pickup_datetime"), "feed": F.col("source"), "vendor": F.col("VendorID")}
    return totals(union_common(*feeds), keys, [["date", "feed", "vendor"], ["date", "feed"], ["feed", "vendor"], ["date"], []])


_MEASURES = ("fare_amount", "trip_distance", "total_amount")
_RANKS = (0.05, 0.25, 0.5, 0.75, 0.95)
_RANK_ERROR = 0.015
_COUNTED = ("VendorID", "PULocationID", "tpep_pickup_datetime", "fare_amount")


def _recorded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Yellow trips, and the states of the three loads that brought them; one came wrong at first."""
    trips, path = yellow_raw(spark, sf_dir), scratch_dir(spark, "states")
    loads = {name: trips.filter(F.col("DOLocationID") % 3 == k) for k, name in enumerate("abc")}
    record_states(trips, "b", path, _MEASURES, _COUNTED)
    for name, rows in loads.items():
        record_states(rows, name, path, _MEASURES, _COUNTED)
    return trips, read_states(spark, path)


def quantile_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether quantiles from merged states have the rank that they should, by exact count."""
    trips, states = _recorded(spark, sf_dir)
    found = merged_quantiles(states, _RANKS)
    ranks = []
    for column in _MEASURES:
        answer = found.filter(F.col("column") == column).select("quantiles").scalar()
        for number, p in enumerate(_RANKS):
            value = F.get(answer, F.lit(number))
            below, upto = F.avg((F.col(column) < value).cast("int")), F.avg((F.col(column) <= value).cast("int"))
            within = (below - _RANK_ERROR <= p) & (upto + _RANK_ERROR >= p)
            ranks.append(F.struct(F.lit(column).alias("column"), F.lit(p).alias("probability"), within.alias("within")))
    checked = trips.agg(F.array(*ranks).alias("ranks")).select(F.inline("ranks"))
    return checked.join(found.select("column", "n"), "column")


def distinct_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts from merged states, held against exact ones."""
    trips, states = _recorded(spark, sf_dir)
    exact = [F.struct(F.lit(c).alias("column"), F.count_distinct(c).alias("exact")) for c in _COUNTED]
    counted = trips.agg(F.array(*exact).alias("exact")).select(F.inline("exact"))
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= F.col("exact") * 0.03 + 0.5
    return merge_states(states).join(counted, "column").select("column", "n_null", "exact", near.alias("within"))


def terms_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the terms of their supplier on the day of shipping; some days have none."""
    began = "TIMESTAMP_NTZ '1995-06-01 00:00:00' + CAST(s_suppkey % 400 AS INT) * INTERVAL '1' DAY"
    changed = f"{began} + INTERVAL '600' DAY"
    suppliers = table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    versions = [("'old'", began, changed), ("'new'", f"{changed} + CAST(s_suppkey % 3 AS INT) * INTERVAL '20' DAY", "NULL")]
    terms = [
        suppliers.selectExpr(
            "l_suppkey", f"{name} AS terms",
            *[f"CAST({e.replace('s_suppkey', 'l_suppkey')} AS TIMESTAMP_NTZ) AS {c}" for e, c in ((low, "valid_from"), (high, "valid_to"))],
        )
        for name, low, high in versions
    ]
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_shipdate").cast("timestamp_ntz").alias("l_shipdate"))
    joined = join_valid(lines, terms[0].unionByName(terms[1]), "l_suppkey", "l_shipdate")
    return joined.withColumn("terms", F.coalesce("terms", F.lit("unknown")))


_BOX = {"o_orderdate": ("1996-01-01", "1997-07-01"), "o_totalprice": (150_000, 250_000)}


def _clustered(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    root = scratch_dir(spark, "clustering")
    table(spark, sf_dir, "orders").repartition(8).write.parquet(f"{root}/loose")
    return cluster_table(spark, f"{root}/loose", f"{root}/clustered", list(_BOX), number)


def compact_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clustered(spark, sf_dir, 16)


def clustered_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in a box of dates and prices, by each side of it and by both, and whether few of 64 files can hold them."""
    clustered = _clustered(spark, sf_dir, 64)
    ranges = file_ranges(clustered, list(_BOX))

    def inside(column: str) -> Column:
        return F.col(column).between(*_BOX[column])

    def possible(column: str) -> Column:
        low, high = _BOX[column]
        return (F.col(f"min_{column}") <= high) & (F.col(f"max_{column}") >= low)

    boxes = {"date": ["o_orderdate"], "price": ["o_totalprice"], "both": list(_BOX)}
    rows, files = [
        {name: F.count_if(reduce(and_, map(test, columns))).alias(name) for name, columns in boxes.items()}
        for test in (inside, possible)
    ]
    counted = clustered.agg(*rows.values()).unpivot([], list(boxes), "box", "n")
    read = ranges.agg(*files.values(), F.count(F.lit(1)).alias("all_files")).unpivot("all_files", list(boxes), "box", "n_files")
    # A side of the box holds a quarter to a half of the rows, both sides a seventh.
    most = F.when(F.col("box") == "both", 0.35).otherwise(0.65)
    return counted.join(read, "box").select("box", "n", (F.col("n_files") <= most * F.col("all_files")).alias("few_files"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "gold_incremental": gold_incremental,
    "gold_incremental_sources": gold_incremental_sources,
    "dedup_history": dedup_history,
    "stream_bronze": stream_bronze,
    "stream_summary": stream_summary,
    "stream_late": stream_late,
    "quarantine_rows": quarantine_rows,
    "reconciliation": reconciliation,
    "totals_by_level": totals_by_level,
    "quantile_states": quantile_states,
    "distinct_states": distinct_states,
    "terms_by_date": terms_by_date,
    "compact_clustered": compact_clustered,
    "clustered_pruning": clustered_pruning,
}

_ARRIVED = f"""{events_sql()},
judged AS (
  SELECT *, day(pickup_datetime) > 15 OR CAST(trip_distance * 8 AS BIGINT) % 10 = 0 AS second FROM trips
),
mark AS (SELECT max(pickup_datetime) - INTERVAL '2' DAY AS missed FROM judged WHERE NOT second)"""
_LATE = "second AND CAST(pickup_datetime AS DATE) < CAST(missed AS DATE)"

_JUDGED = f"""WITH yellow AS ({YELLOW_SQL}),
counted AS (
  SELECT *, count(*) AS copies FROM (SELECT * FROM yellow UNION ALL SELECT * FROM yellow WHERE PULocationID % 3 = 0) GROUP BY ALL
),
checked AS (
  SELECT *, CASE
    WHEN (VendorID BETWEEN 1 AND 2) IS NOT TRUE THEN 'valid_range:VendorID'
    WHEN (RatecodeID BETWEEN 1 AND 6) IS NOT TRUE THEN 'valid_range:RatecodeID'
    WHEN (payment_type BETWEEN 1 AND 5) IS NOT TRUE THEN 'valid_range:payment_type'
    WHEN (tpep_pickup_datetime BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31') IS NOT TRUE
      THEN 'time_range:tpep_pickup_datetime'
    WHEN (passenger_count > 0) IS NOT TRUE THEN 'positive:passenger_count'
    WHEN (trip_distance > 0) IS NOT TRUE THEN 'positive:trip_distance' END AS first
  FROM counted
),
quartiles AS (
  SELECT quantile_disc(trip_distance, 0.25) AS q1, quantile_disc(trip_distance, 0.75) AS q3 FROM checked WHERE first IS NULL
),
judged AS (
  SELECT checked.* EXCLUDE (first), CASE WHEN first IS NULL AND trip_distance NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
    THEN 'outlier:trip_distance' ELSE first END AS rejected_by
  FROM checked, quartiles
)"""

_METRICS = """avg(fare_amount) AS avg_fare, min(fare_amount) AS min_fare, max(fare_amount) AS max_fare,
  avg(trip_distance) AS avg_trip_distance, min(trip_distance) AS min_trip_distance, max(trip_distance) AS max_trip_distance,
  count(*) AS total_trips"""

_DATES, _PRICES = "o_orderdate BETWEEN '1996-01-01' AND '1997-07-01'", "o_totalprice BETWEEN 150000 AND 250000"

ORACLE: dict[str, str] = {
    "gold_incremental": daily_sql(),
    "gold_incremental_sources": f"{events_sql()}\n{pivot_sql('trips', 'pickup_datetime', EVENT_SOURCES)}",
    "dedup_history": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, min(load) AS load FROM (
  SELECT *, '2024-02-01' AS load FROM customer WHERE c_custkey % 3 <> 0
  UNION ALL SELECT *, '2024-02-02' FROM customer
  UNION ALL SELECT * REPLACE (CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal), '2024-02-03' FROM customer
) GROUP BY ALL""",
    "stream_bronze": "SELECT *, DATE '2024-02-01' AS ingest_date, 'orders' AS source FROM orders",
    "stream_summary": f"{_ARRIVED},\nontime AS (SELECT judged.* FROM judged, mark WHERE NOT ({_LATE}))\n"
    + pivot_sql("ontime", "pickup_datetime", EVENT_SOURCES),
    "stream_late": f"{_ARRIVED}\nSELECT judged.* EXCLUDE (second), missed, CAST(1 AS BIGINT) AS batch FROM judged, mark WHERE {_LATE}",
    "quarantine_rows": f"{_JUDGED}\nSELECT * FROM judged WHERE rejected_by IS NOT NULL",
    "reconciliation": f"""{_JUDGED}
SELECT coalesce(rejected_by, 'kept') AS outcome, count(*) AS rows FROM judged GROUP BY 1
UNION ALL SELECT 'copy', CAST(sum(copies - 1) AS BIGINT) FROM judged""",
    "totals_by_level": f"""
WITH trips AS (
  SELECT CAST(tpep_pickup_datetime AS DATE) AS date, 'yellow' AS feed, VendorID AS vendor, fare_amount, trip_distance FROM ({YELLOW_SQL})
  UNION ALL
  SELECT CAST(lpep_pickup_datetime AS DATE), 'green', VendorID, fare_amount, trip_distance FROM ({GREEN_SQL})
)
SELECT date, feed, vendor, CAST(GROUPING_ID(date, feed, vendor) AS BIGINT) AS grouping_id, {_METRICS} FROM trips
GROUP BY GROUPING SETS ((date, feed, vendor), (date, feed), (feed, vendor), (date), ())""",
    "quantile_states": "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", unnest([{', '.join(f'CAST({p} AS DOUBLE)' for p in _RANKS)}]) AS probability, "
        f"true AS within, count({c}) AS n FROM ({YELLOW_SQL})"
        for c in _MEASURES
    ),
    "distinct_states": "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS exact, true AS within FROM ({YELLOW_SQL})"
        for c in _COUNTED
    ),
    "terms_by_date": """
WITH began AS (SELECT s_suppkey, TIMESTAMP '1995-06-01' + CAST(s_suppkey % 400 AS INT) * INTERVAL '1' DAY AS began FROM supplier),
terms AS (
  SELECT s_suppkey, 'old' AS terms, began AS valid_from, began + INTERVAL '600' DAY AS valid_to FROM began
  UNION ALL
  SELECT s_suppkey, 'new', began + INTERVAL '600' DAY + CAST(s_suppkey % 3 AS INT) * INTERVAL '20' DAY, NULL FROM began
)
SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate, coalesce(terms, 'unknown') AS terms, valid_from, valid_to
FROM lineitem LEFT JOIN terms
  ON l_suppkey = s_suppkey AND valid_from <= l_shipdate AND (valid_to IS NULL OR l_shipdate < valid_to)""",
    "compact_clustered": "SELECT * FROM orders",
    "clustered_pruning": "\nUNION ALL\n".join(
        f"SELECT '{box}' AS box, count(*) AS n, true AS few_files FROM orders WHERE {condition}"
        for box, condition in {"date": _DATES, "price": _PRICES, "both": f"{_DATES} AND {_PRICES}"}.items()
    ),
}
