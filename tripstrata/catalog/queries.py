"""One query per operator, each over the whole of its input tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.catalog.views import (
    EVENT_SOURCES,
    event_trips,
    green_raw,
    table,
    yellow_raw,
)
from tripstrata.operators.columns import drop_columns, snake_case_columns
from tripstrata.operators.corrections import (
    abs_negatives,
    dedup_rows,
    fill_na,
    parse_timestamps,
    shift_code,
)
from tripstrata.operators.enrich import (
    add_fare_per_mile,
    add_ingest_metadata,
    add_trip_duration,
)
from tripstrata.operators.filters import (
    exclude_dates,
    filter_iqr,
    filter_positive,
    filter_time_range,
    filter_valid_range,
)
from tripstrata.operators.histograms import histogram, histogram_2d
from tripstrata.operators.profile import column_profile
from tripstrata.operators.quantiles import QUARTILES, quantile_bounds
from tripstrata.operators.summaries import (
    daily_summary,
    metric_series,
    preview,
    source_metrics,
    union_common,
)
from tripstrata.plans import flows
from tripstrata.plans.draft import clean_first_draft
from tripstrata.plans.rules import (
    GREEN,
    RATE_CODE_SCHEMA,
    RATE_CODES,
    VENDOR_SCHEMA,
    VENDORS,
    YELLOW,
)
from tripstrata.sources import readers, writers
from tripstrata.sources.scratch import scratch_dir

AS_OF = "2024-02-01"
EXACT = 0.0
SKETCH = 0.05


# -- sources, sinks, table maintenance ---------------------------------------


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_parquet(spark, f"{sf_dir}/orders.parquet")


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    path = scratch_dir(spark, "scan-csv")
    customers.write.csv(path, header=True)
    return readers.read_csv(spark, path, customers.schema)


def dim_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per vendor and rate code, named by the two literal tables."""
    vendors = readers.literal_table(spark, VENDORS, VENDOR_SCHEMA)
    rate_codes = readers.literal_table(spark, RATE_CODES, RATE_CODE_SCHEMA)
    per_code = (
        yellow_raw(spark, sf_dir)
        .groupBy(
            F.col("VendorID").cast("long").alias("vendor_id"),
            F.col("RatecodeID").cast("long").alias("rate_code_id"),
        )
        .agg(F.count(F.lit(1)).alias("total_trips"))
    )
    named = per_code.join(vendors, "vendor_id", "left")
    return named.join(rate_codes, "rate_code_id", "left")


def dim_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three dimensions, written twice; suppliers stand in for locations.

    The result has the rows of all three under one set of columns.
    """
    places = table(spark, sf_dir, "supplier").toDF(
        "LocationID", "Zone Name", "Region-ID", "accountBalance"
    )
    root = scratch_dir(spark, "dimensions")
    places.write.csv(f"{root}/csv", header=True)
    for _ in range(2):
        paths = flows.dimensions(spark, root, f"{root}/csv", places.schema)
    names = {
        "dim_vendor": ("vendor_id", "vendor_name"),
        "dim_rate_code": ("rate_code_id", "rate_description"),
        "dim_location": ("location_id", "zone_name"),
    }
    parts = [
        readers.read_layer(spark, paths[name])
        .withColumnsRenamed({key: "id", label: "name"})
        .withColumn("dimension", F.lit(name))
        for name, (key, label) in names.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def ingest_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_ingest_metadata(table(spark, sf_dir, "orders"), "orders", AS_OF)


def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads; the second brings one more column."""
    path = scratch_dir(spark, "bronze")
    _two_loads(spark, sf_dir, path)
    return readers.read_layer(spark, path)


def silver_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads under two dates, with the schema of the first enforced."""
    customers = table(spark, sf_dir, "customer")
    path = scratch_dir(spark, "silver")
    for day in (AS_OF, "2024-02-02"):
        writers.append_fixed(add_ingest_metadata(customers, "customer", day), path)
    return readers.read_layer(spark, path)


def gold_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily summary, published twice."""
    path = scratch_dir(spark, "gold")
    for _ in range(2):
        published = flows.publish(_daily(spark, sf_dir), path)
    return published


def staged_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "staged")
    path = f"{root}/bronze"
    flows.bronze(table(spark, sf_dir, "part"), "part", path, AS_OF, stage_path=f"{root}/stage")
    return readers.read_layer(spark, path)


def _let_go(spark: SparkSession, name: str) -> DataFrame:
    """What a registered table shows, read from where it lies; the name is free again."""
    shown = spark.table(name)
    location = writers.table_location(spark, name)
    rows = spark.read.schema(shown.schema).parquet(location)
    spark.sql(f"DROP TABLE {name}")
    return rows


def register_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, name = scratch_dir(spark, "registered"), f"parts_{uuid4().hex}"
    writers.overwrite(table(spark, sf_dir, "part"), path, partition_by=["p_type"])
    writers.register_table(spark, name, path, partition_by=["p_type"])
    return _let_go(spark, name)


def _two_loads(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Customers twice; the second load brings one more column."""
    customers = table(spark, sf_dir, "customer")
    flows.bronze(customers, "first", path, AS_OF)
    flows.bronze(customers.withColumn("c_debt", -F.col("c_acctbal")), "second", path, "2024-02-02")


def register_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name given before the second load, refreshed after it."""
    path, name = scratch_dir(spark, "evolving"), f"customers_{uuid4().hex}"
    flows.bronze(table(spark, sf_dir, "customer"), "first", path, AS_OF)
    writers.register_table(spark, name, path, partition_by=["ingest_date"])
    second = table(spark, sf_dir, "customer").withColumn("c_debt", -F.col("c_acctbal"))
    flows.bronze(second, "second", path, "2024-02-02")
    writers.register_table(spark, name, path, partition_by=["ingest_date"])
    return _let_go(spark, name)


def compact_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "compact-evolved")
    _two_loads(spark, sf_dir, f"{root}/loose")
    return writers.compact_table(spark, f"{root}/loose", f"{root}/compact", ["ingest_date"])


def gold_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write, register, compact and repoint, twice: first half the days, then all."""
    root, name = scratch_dir(spark, "published"), f"daily_{uuid4().hex}"
    daily = _daily(spark, sf_dir)
    for rows in (daily.filter("day(date) < 15").withColumn("total_trips", F.lit(0).cast("long")), daily):
        flows.publish(rows, f"{root}/gold", name, compacted_path=f"{root}/compact")
    return _let_go(spark, name)


def compact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status, first written with every task touching every status."""
    root = scratch_dir(spark, "compaction")
    scattered = table(spark, sf_dir, "orders").repartition(8)
    writers.overwrite(scattered, f"{root}/loose", ["o_orderstatus"], rebalance=False)
    return writers.compact_table(spark, f"{root}/loose", f"{root}/compact", ["o_orderstatus"])


# -- projections, filters, corrections ---------------------------------------


def snake_case_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snake_case_columns(yellow_raw(spark, sf_dir))


def drop_part_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_columns(table(spark, sf_dir, "part"), ["p_brand", "p_size"])


def valid_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_valid_range(yellow_raw(spark, sf_dir), YELLOW.valid_ranges)


def positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_positive(table(spark, sf_dir, "customer"), ["c_acctbal"])


def time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_time_range(table(spark, sf_dir, "events"), "ts", ("2024-01-08", "2024-01-22"))


def iqr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_iqr(table(spark, sf_dir, "events"), ["value"], EXACT)


def exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_day = source_metrics(event_trips(spark, sf_dir), EVENT_SOURCES)
    return exclude_dates(per_day, ["2024-01-30", "2024-01-03"])


def fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_na(yellow_raw(spark, sf_dir), ["store_and_fwd_flag"], "N")


def negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abs_negatives(table(spark, sf_dir, "customer"), ["c_acctbal"])


def code_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shift_code(yellow_raw(spark, sf_dir))


def timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order times as text; urgent orders carry text in another pattern."""
    as_text = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "yyyy/MM/dd"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .alias("placed"),
        F.col("o_orderdate").alias("stored"),
    )
    return parse_timestamps(as_text, {"placed": "pickup_datetime", "stored": "dropoff_datetime"})


def duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_trip_duration(
        yellow_raw(spark, sf_dir), "tpep_pickup_datetime", "tpep_dropoff_datetime"
    )


def fare_per_mile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_fare_per_mile(yellow_raw(spark, sf_dir))


def clean_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_first_draft(yellow_raw(spark, sf_dir), EXACT)


# -- aggregates --------------------------------------------------------------


def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return dedup_rows(customers.unionByName(customers))


def dedup_across_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows loaded on two dates: the first load stays."""
    customers = table(spark, sf_dir, "customer")
    loads = [add_ingest_metadata(customers, "customer", day) for day in ("2024-02-02", AS_OF)]
    return dedup_rows(loads[0].unionByName(loads[1]), ignore=["ingest_date"])


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = yellow_raw(spark, sf_dir).transform(parse_timestamps, YELLOW.timestamps)
    return daily_summary(add_trip_duration(trips))


def union_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_common(yellow_raw(spark, sf_dir), green_raw(spark, sf_dir))


def event_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_metrics(event_trips(spark, sf_dir), EVENT_SOURCES)


def first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(table(spark, sf_dir, "orders"), 31, ["o_orderdate", "o_orderkey"])


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = column_profile(table(spark, sf_dir, "orders"))
    return facts.withColumns({"mean": F.round("mean", 3), "stddev": F.round("stddev", 3)})


def quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = quantile_bounds(table(spark, sf_dir, "lineitem"), "l_extendedprice", relative_error=EXACT)
    return prices.selectExpr("quantiles[0] AS q1", "quantiles[1] AS q3")


def sketched_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the sketch of the default error finds values whose ranks lie within it."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("v"))
    found = quantile_bounds(lines, "v", relative_error=SKETCH).scalar()
    rows = lines.withColumn("q", found)
    counts = [F.count(F.lit(1)).alias("n")]
    for i in range(2):
        counts.append(F.count_if(F.col("v") < F.get("q", F.lit(i))).alias(f"below{i}"))
        counts.append(F.count_if(F.col("v") <= F.get("q", F.lit(i))).alias(f"upto{i}"))
    within = [
        F.struct(
            F.lit(p).alias("p"),
            ((F.col(f"below{i}") <= (p + SKETCH) * F.col("n")) & (F.col(f"upto{i}") >= (p - SKETCH) * F.col("n"))).alias("within"),
        )
        for i, p in enumerate(QUARTILES)
    ]
    return rows.agg(*counts).select(F.inline(F.array(*within)))


def price_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 50)


def price_quantity_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_2d(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_quantity", 50, 5)


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_series(event_metrics(spark, sf_dir), EVENT_SOURCES)


# -- flows -------------------------------------------------------------------


def silver_yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = add_ingest_metadata(yellow_raw(spark, sf_dir), "yellow", AS_OF)
    return flows.silver(loaded, YELLOW, scratch_dir(spark, "yellow-stage"), EXACT)


def silver_green(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = add_ingest_metadata(green_raw(spark, sf_dir), "green", AS_OF)
    rules = replace(GREEN, unsigned=tuple(c for c in GREEN.unsigned if c in loaded.columns))
    return flows.silver(loaded, rules, scratch_dir(spark, "green-stage"), EXACT)


def _whole_flow(spark: SparkSession, sf_dir: str, **options) -> dict[str, DataFrame]:
    """Both feeds to gold.  Every raw row arrives twice in its load."""
    root = scratch_dir(spark, "medallion")
    green, yellow = green_raw(spark, sf_dir), yellow_raw(spark, sf_dir)
    unsigned = tuple(c for c in GREEN.unsigned if c in green.columns)
    feeds = (
        flows.Feed("yellow", yellow.unionByName(yellow), YELLOW),
        flows.Feed("green", green.unionByName(green), replace(GREEN, unsigned=unsigned)),
    )
    loads = options.pop("loads", (AS_OF,))
    for day in loads[:-1]:
        for feed in feeds:
            flows.bronze(feed.raw, feed.name, f"{root}/layers/bronze/{feed.name}", day)
    names = {name: f"{name}_{uuid4().hex}" for name in ("daily_summary", "source_metrics")}
    flows.medallion(
        feeds,
        f"{root}/layers",
        excluded_dates=["2024-01-31"],
        as_of=loads[-1],
        relative_error=EXACT,
        stage_root=f"{root}/stage",
        tables=names,
        **options,
    )
    return {name: _let_go(spark, registered) for name, registered in names.items()}


def medallion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _whole_flow(spark, sf_dir)["source_metrics"]


def medallion_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other gold table, compacted."""
    return _whole_flow(spark, sf_dir, compact=True)["daily_summary"]


def medallion_across_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads that share all their rows, which count once."""
    loads = (AS_OF, "2024-02-02")
    return _whole_flow(spark, sf_dir, loads=loads, ignore=["ingest_date"])["source_metrics"]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_parquet": scan_parquet,
    "scan_csv": scan_csv,
    "dim_literal": dim_literal,
    "dim_overwrite": dim_overwrite,
    "ingest_metadata": ingest_metadata,
    "bronze_append": bronze_append,
    "silver_append": silver_append,
    "gold_overwrite": gold_overwrite,
    "staged_bronze": staged_bronze,
    "register_table": register_table,
    "register_evolved": register_evolved,
    "compact_table": compact_table,
    "compact_evolved": compact_evolved,
    "gold_published": gold_published,
    "snake_case_columns": snake_case_names,
    "drop_columns": drop_part_columns,
    "filter_valid_range": valid_range,
    "filter_positive": positive,
    "filter_time_range": time_range,
    "quantile_bounds": quartiles,
    "quantile_sketch": sketched_quartiles,
    "filter_iqr": iqr,
    "exclude_dates": exclude,
    "fill_na": fill,
    "abs_negatives": negatives,
    "shift_code": code_shift,
    "parse_timestamps": timestamps,
    "trip_duration": duration,
    "fare_per_mile": fare_per_mile,
    "clean_v1": clean_v1,
    "dedup_rows": dedup,
    "dedup_across_loads": dedup_across_loads,
    "daily_summary": _daily,
    "union_common": union_shared,
    "source_metrics": event_metrics,
    "preview": first_orders,
    "column_profile": profile,
    "histogram": price_histogram,
    "histogram_2d": price_quantity_grid,
    "metric_series": event_series,
    "silver_yellow": silver_yellow,
    "silver_green": silver_green,
    "medallion": medallion,
    "medallion_daily": medallion_daily,
    "medallion_across_loads": medallion_across_loads,
}
