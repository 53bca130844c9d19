"""Plan shape: what reaches the scan, what shuffles, and that operators are lazy."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripstrata.catalog.views import EVENT_SOURCES, event_trips, table, yellow_raw
from tripstrata.operators.corrections import dedup_rows
from tripstrata.operators.filters import (
    filter_iqr,
    filter_positive,
    filter_time_range,
    filter_valid_range,
)
from tripstrata.operators.histograms import histogram
from tripstrata.operators.profile import column_profile
from tripstrata.operators.quantiles import quantile_bounds
from tripstrata.operators.summaries import daily_summary, preview, source_metrics
from tripstrata.plans import flows
from tripstrata.plans.draft import clean_first_draft
from tripstrata.plans.rules import YELLOW

SF_DIR = "/root/testdata/sf0.001"


def plan(df, run=False) -> str:
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def whole_plan(spark, df) -> str:
    """The plan with its scan metadata in full."""
    key = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(key)
    spark.conf.set(key, "10000")
    try:
        return plan(df)
    finally:
        spark.conf.set(key, before)


def test_filters_reach_the_scan(spark):
    kept = (
        table(spark, SF_DIR, "lineitem")
        .transform(filter_valid_range, {"l_linenumber": (1, 5)})
        .transform(filter_positive, ["l_quantity"])
        .transform(filter_time_range, "l_shipdate", ("1996-01-01", "1997-01-01"))
    )
    (pushed,) = re.findall(r"PushedFilters: \[(.*?)\]", whole_plan(spark, kept))
    assert "GreaterThanOrEqual(l_linenumber,1)" in pushed
    assert "LessThanOrEqual(l_linenumber,5)" in pushed
    assert "GreaterThan(l_quantity,0.0)" in pushed
    assert "GreaterThanOrEqual(l_shipdate,1996-01-01T00:00)" in pushed
    assert "LessThanOrEqual(l_shipdate,1997-01-01T00:00)" in pushed


def test_filters_written_after_dedup_run_before_its_shuffle(spark):
    text = whole_plan(spark, filter_positive(dedup_rows(table(spark, SF_DIR, "customer")), ["c_acctbal"]))
    assert text.index("Exchange") < text.index("Filter")
    # Copies collapse inside each task before the shuffle, and again after it.
    assert len(re.findall("HashAggregate", text.split("Exchange")[0])) == 1
    assert len(re.findall("HashAggregate", text.split("Exchange")[1])) == 1
    assert "GreaterThan(c_acctbal,0.0)" in text


def test_dedup_across_loads_stays_a_hash_aggregate(spark):
    rows = table(spark, SF_DIR, "customer").withColumn("ingest_date", F.current_date())
    text = plan(dedup_rows(rows, ignore=["ingest_date"]))
    assert "SortAggregate" not in text and text.count("HashAggregate") == 2


def test_bronze_load_neither_shuffles_nor_sorts(spark, tmp_path):
    """The load date is one value, so the write needs no grouping by it."""
    loaded = flows.add_ingest_metadata(yellow_raw(spark, SF_DIR), "y", "2024-02-01")
    target = f"t_{tmp_path.name.replace('-', '_')}"
    flows.append_evolving(loaded.limit(0), f"{tmp_path}/bronze")
    columns = ", ".join(f"{name} {kind}" for name, kind in loaded.dtypes)
    spark.sql(
        f"CREATE TABLE {target} ({columns}) USING parquet PARTITIONED BY (ingest_date)"
        f" LOCATION '{tmp_path}/bronze'"
    )
    loaded.createOrReplaceTempView("loaded")
    names = ", ".join([c for c in loaded.columns if c != "ingest_date"] + ["ingest_date"])
    text = spark.sql(f"EXPLAIN INSERT INTO {target} SELECT {names} FROM loaded").first()[0]
    assert "WriteFiles" in text and "Sort" not in text and "Exchange" not in text


def test_iqr_fences_are_one_scalar_subquery_and_no_join(spark):
    text = plan(filter_iqr(table(spark, SF_DIR, "events"), ["value"]), run=True)
    final = text.split("== Initial Plan ==")[0]
    assert "Join" not in text and "Cartesian" not in text
    assert "ReusedSubquery" in final
    assert re.search(r"DataFilters: \[.*value.*Subquery", text)
    assert "ReadSchema: struct<value:double>" in text


def test_exact_quantiles_share_one_shuffle_of_the_values(spark):
    lines = table(spark, SF_DIR, "lineitem")
    text = plan(quantile_bounds(lines, "l_extendedprice", relative_error=0.0), run=True)
    final = text.split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan", final)) == 1
    assert final.count("ReusedExchange") == 3
    assert "Cartesian" not in text and "NestedLoop" not in text
    assert "ReadSchema: struct<l_extendedprice:double>" in text


def test_pivot_reads_three_columns_and_runs_no_job_when_sources_are_named(spark, jobs_run):
    trips = event_trips(spark, SF_DIR)
    assert jobs_run(lambda: source_metrics(trips, EVENT_SOURCES)) == 0
    assert jobs_run(lambda: source_metrics(trips)) > 0
    text = plan(source_metrics(trips, EVENT_SOURCES))
    assert "props" not in text and "event_id" not in text


def test_profile_reads_each_column_once_without_copying_rows(spark):
    text = plan(column_profile(table(spark, SF_DIR, "orders")))
    assert "Expand" not in text
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert len(schemas) == 6 and all("," not in s for s in schemas)
    single_pass = plan(column_profile(table(spark, SF_DIR, "orders"), exact_distinct=False))
    assert single_pass.count("FileScan") == 1


def test_histogram_reads_one_column(spark):
    text = plan(histogram(table(spark, SF_DIR, "lineitem"), "l_extendedprice", 50), run=True)
    assert set(re.findall(r"ReadSchema: struct<(.*?)>", text)) == {"l_extendedprice:double"}
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_preview_is_top_n_per_task(spark):
    assert "TakeOrderedAndProject" in plan(preview(table(spark, SF_DIR, "orders"), 5, ["o_orderkey"]))


def test_operators_start_no_job(spark, jobs_run):
    trips = yellow_raw(spark, SF_DIR).withColumns({"ingest_date": F.current_date(), "source": F.lit("y")})

    def build():
        rows = flows.silver(trips, YELLOW, relative_error=0.0)
        daily_summary(rows)
        column_profile(rows, ["trip_distance"])
        histogram(rows, "trip_distance")
        clean_first_draft(trips)

    assert jobs_run(build) == 0


def test_silver_below_the_stage_has_one_shuffle(spark):
    trips = yellow_raw(spark, SF_DIR)
    rows = dedup_rows(trips)
    rows = filter_valid_range(rows, YELLOW.valid_ranges)
    rows = filter_positive(filter_time_range(rows), YELLOW.positive)
    assert plan(rows).count("Exchange ") == 1


@pytest.mark.parametrize("last", ["2024-01-31", datetime(2024, 1, 31).isoformat(sep=" ")])
def test_time_literals_fold(spark, last):
    text = whole_plan(spark, filter_time_range(table(spark, SF_DIR, "events"), "ts", ("2024-01-01", last)))
    assert "LessThanOrEqual(ts,2024-01-31T00:00" in text


def test_profile_sorts_no_rows(spark):
    """Text is profiled from its distinct values, by hash."""
    text = plan(column_profile(table(spark, SF_DIR, "orders"), ["o_orderpriority", "o_totalprice"]))
    assert not re.search(r"\bSort \[|SortAggregate\(key=\[[^\]]", text)
