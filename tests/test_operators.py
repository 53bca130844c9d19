"""Edge cases: null, NaN, zero, sign, missing columns, empty input."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tripstrata.functions.names import snake_case
from tripstrata.operators.columns import (
    common_columns,
    drop_columns,
    present_columns,
    snake_case_columns,
)
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
from tripstrata.operators.quantiles import quantile_bounds
from tripstrata.operators.summaries import (
    daily_summary,
    metric_series,
    preview,
    source_metrics,
    union_common,
)
from tripstrata.sources.readers import literal_table

NAN = float("nan")


def column(df, name=None):
    return [row[name or df.columns[0]] for row in df.collect()]


def doubles(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x DOUBLE")


# names and columns


def test_literal_table(spark):
    table = literal_table(spark, [(1, None), (2, None)], "k INT, s STRING")
    assert table.dtypes == [("k", "int"), ("s", "string")] and table.collect() == [(1, None), (2, None)]
    assert literal_table(spark, [], "k INT").collect() == []
    assert "LocalTableScan" in table._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        literal_table(spark, [(1, "a"), (2,)], "k INT, s STRING")


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("VendorID", "vendor_id"),
        ("RatecodeID", "ratecode_id"),
        ("PULocationID", "pulocation_id"),
        ("Airport_fee", "airport_fee"),
        ("Foo  Bar", "foo_bar"),
        ("foo-baz", "foo_baz"),
        ("zone2Name", "zone2_name"),
        ("tpep_pickup_datetime", "tpep_pickup_datetime"),
        ("", ""),
    ],
)
def test_snake_case(raw, expected):
    assert snake_case(raw) == expected


def test_snake_case_columns_refuses_a_clash(spark):
    df = spark.createDataFrame([(1, 2)], "`Foo Bar` INT, `foo-bar` INT")
    with pytest.raises(ValueError, match="foo_bar"):
        snake_case_columns(df)


def test_present_columns(spark):
    df = spark.createDataFrame([(1, 2)], "VendorID INT, b INT")
    assert present_columns(df, ["b", "VendorID"]) == ["b", "VendorID"]
    with pytest.warns(UserWarning, match="vendorid"):
        assert present_columns(df, ["vendorid", "b"]) == ["b"]
    assert present_columns(df, ["vendorid"], case_sensitive=False) == ["VendorID"]
    with pytest.raises(ValueError, match="absent"):
        present_columns(df, ["absent"], missing="error")
    with pytest.raises(ValueError, match="missing"):
        present_columns(df, ["b"], missing="ignore")


def test_missing_columns_leave_the_rows_alone(spark):
    df = spark.createDataFrame([(1,)], "a INT")
    guarded = [
        lambda: drop_columns(df, ["z"]),
        lambda: filter_valid_range(df, {"z": (1, 2)}),
        lambda: filter_positive(df, ["z"]),
        lambda: filter_time_range(df),
        lambda: filter_iqr(df, ["z"]),
        lambda: fill_na(df, ["z"], "N"),
        lambda: abs_negatives(df, ["z"]),
        lambda: shift_code(df),
        lambda: parse_timestamps(df, {"z": "y"}),
        lambda: add_trip_duration(df),
        lambda: add_fare_per_mile(df),
    ]
    for operator in guarded:
        with pytest.warns(UserWarning, match="not found"):
            assert operator().collect() == df.collect()


def test_common_columns_keep_the_left_order(spark):
    left = spark.createDataFrame([(1, 2, 3)], "c INT, a INT, b INT")
    right = spark.createDataFrame([(1, 2.5)], "a INT, c DOUBLE")
    assert common_columns(left, right) == ["c", "a"]
    both = union_common(left, right)
    assert both.dtypes == [("c", "double"), ("a", "int")]
    assert sorted(both.collect()) == [(1.0, 2), (2.5, 1)]


# filters


def test_valid_range_is_closed_and_drops_null_and_nan(spark):
    df = doubles(spark, 0.9, 1.0, 3.0, 6.0, 6.1, None, NAN)
    assert column(filter_valid_range(df, {"x": (1, 6)})) == [1.0, 3.0, 6.0]


def test_valid_ranges_combine(spark):
    df = spark.createDataFrame([(1, 1), (1, 9), (9, 1)], "a INT, b INT")
    assert filter_valid_range(df, {"a": (1, 2), "b": (1, 2)}).collect() == [(1, 1)]


def test_positive_is_strict_and_keeps_nan(spark):
    kept = column(filter_positive(doubles(spark, -1.0, 0.0, -0.0, 0.1, None, NAN), ["x"]))
    assert kept[0] == 0.1 and math.isnan(kept[1]) and len(kept) == 2


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "string"])
def test_time_range_ends_at_the_first_instant_of_the_last_day(spark, kind):
    instants = [
        "2023-12-31 23:59:59", "2024-01-01 00:00:00", "2024-01-30 23:59:59",
        "2024-01-31 00:00:00", "2024-01-31 12:00:00", "2024-02-01 00:00:00", None,
    ]
    df = spark.createDataFrame([(t,) for t in instants], "t STRING").select(F.col("t").cast(kind))
    kept = filter_time_range(df, "t").select(F.col("t").cast("string"))
    expected = instants[1:3] if kind == "string" else instants[1:4]
    assert column(kept) == expected
    if kind != "string":
        whole_day = filter_time_range(df, "t", end_inclusive_day=True)
        assert column(whole_day.select(F.col("t").cast("string"))) == instants[1:5]


def test_exclude_dates_drops_null_dates(spark):
    df = spark.sql("SELECT explode(array(date'2024-01-30', date'2024-01-31', null)) AS date")
    assert column(exclude_dates(df, ["2024-01-31", date(2024, 1, 1)])) == [date(2024, 1, 30)]


@pytest.mark.parametrize("relative_error", [0.0, 0.05])
def test_iqr_drops_far_values_null_and_nan(spark, relative_error):
    df = doubles(spark, *[float(v) for v in range(1, 101)], 1e6, -1e6, None, NAN)
    assert sorted(column(filter_iqr(df, ["x"], relative_error))) == [float(v) for v in range(1, 101)]


@pytest.mark.parametrize("relative_error", [0.0, 0.05])
def test_iqr_on_no_rows(spark, relative_error):
    assert filter_iqr(doubles(spark), ["x"], relative_error).count() == 0
    assert filter_iqr(doubles(spark, None, NAN), ["x"], relative_error).count() == 0


def test_iqr_measures_the_second_column_after_the_first_filter(spark):
    rows = [(float(i), float(i)) for i in range(1, 21)] + [(1000.0, 30.0 + i) for i in range(6)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE").union(
        spark.createDataFrame([(5.0, 34.0)], "a DOUBLE, b DOUBLE")
    )
    kept = filter_iqr(df, ["a", "b"], 0.0)
    # Among all rows b = 34 is ordinary; among those that survive `a` it stays in
    # [5 - 15, 16 + 16.5] only if below the fence.
    survivors = [(a, b) for a, b in [*rows, (5.0, 34.0)] if a < 1000]
    ordered = sorted(b for _, b in survivors)
    q1, q3 = ordered[math.ceil(0.25 * 21) - 1], ordered[math.ceil(0.75 * 21) - 1]
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert sorted(kept.collect()) == sorted(r for r in survivors if low <= r[1] <= high)
    assert (5.0, 34.0) not in kept.collect()


# corrections


def test_fill_na_checks_types(spark):
    df = spark.createDataFrame([(None, None)], "s STRING, i INT")
    assert fill_na(df, ["s"], "N").collect() == [("N", None)]
    assert fill_na(df, ["i"], 7).collect() == [(None, 7)]
    with pytest.raises(TypeError, match="'i'"):
        fill_na(df, ["s", "i"], "N")
    with pytest.raises(TypeError, match="cannot fill"):
        fill_na(df, ["i"], date(2024, 1, 1))


def test_abs_negatives_keeps_null_nan_and_minus_zero(spark):
    fixed = column(abs_negatives(doubles(spark, -2.5, 0.0, -0.0, 3.0, None, NAN), ["x"]))
    assert fixed[0] == 2.5 and fixed[3] == 3.0 and fixed[4] is None and math.isnan(fixed[5])
    assert math.copysign(1, fixed[1]) == 1 and math.copysign(1, fixed[2]) == -1


def test_shift_code(spark):
    df = spark.createDataFrame([(-1,), (0,), (5,), (None,)], "payment_type INT")
    assert column(shift_code(df)) == [None, 1, 6, None]
    assert column(shift_code(df.toDF("c"), "c", -3)) == [None, -3, 2, None]


def test_parse_timestamps(spark):
    df = spark.createDataFrame(
        [("2024-01-31 08:05:00", 1), ("31/01/2024", 2), (None, 3)], "tpep_pickup_datetime STRING, k INT"
    ).withColumn("end", F.expr("timestamp_ntz'2024-01-31 08:15:30'"))
    parsed = parse_timestamps(df, {"tpep_pickup_datetime": "pickup_datetime", "end": "dropoff_datetime"})
    assert parsed.dtypes == [
        ("k", "int"), ("pickup_datetime", "timestamp_ntz"), ("dropoff_datetime", "timestamp_ntz")
    ]
    assert column(parsed, "pickup_datetime") == [datetime(2024, 1, 31, 8, 5), None, None]
    assert set(column(parsed, "dropoff_datetime")) == {datetime(2024, 1, 31, 8, 15, 30)}


def test_parse_timestamps_replaces_in_place_of_an_old_target(spark):
    df = spark.createDataFrame([("2024-01-31 08:05:00", "x")], "pickup_datetime STRING, b STRING")
    parsed = parse_timestamps(df, {"pickup_datetime": "pickup_datetime"})
    assert column(parsed, "pickup_datetime") == [datetime(2024, 1, 31, 8, 5)]


def test_dedup_rows(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, null, date'2024-01-02'), (1, null, date'2024-01-01'),"
        " (1, null, date'2024-01-02'), (2, 'a', date'2024-01-02') AS t(k, s, ingest_date)"
    )
    assert dedup_rows(df).count() == 3
    folded = dedup_rows(df, ignore=["ingest_date"])
    assert folded.columns == df.columns
    assert sorted(folded.collect(), key=lambda r: r.k) == [
        (1, None, date(2024, 1, 1)), (2, "a", date(2024, 1, 2))
    ]
    by_key = dedup_rows(df, ignore=["s", "ingest_date"])
    assert sorted(by_key.collect()) == [(1, None, date(2024, 1, 1)), (2, "a", date(2024, 1, 2))]


# enrichment


def test_trip_duration_may_be_negative_and_counts_whole_seconds(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2024-01-01 00:00:00.9' AS pickup_datetime,"
        " explode(array(timestamp_ntz'2024-01-01 00:01:30.1', timestamp_ntz'2023-12-31 23:59:00', null))"
        " AS dropoff_datetime"
    )
    assert column(add_trip_duration(df), "trip_duration") == [1.5, -1.0, None]


def test_fare_per_mile(spark):
    df = spark.createDataFrame(
        [(4.0, 2.0), (4.0, 0.0), (4.0, -1.0), (4.0, None), (None, 2.0)],
        "fare_amount DOUBLE, trip_distance DOUBLE",
    )
    assert column(add_fare_per_mile(df), "fare_per_mile") == [2.0, 0.0, 0.0, 0.0, None]


def test_ingest_metadata(spark):
    df = doubles(spark, 1.0)
    assert add_ingest_metadata(df, "yellow", "2024-02-01").collect() == [
        (1.0, date(2024, 2, 1), "yellow")
    ]
    today = add_ingest_metadata(df, "yellow").select(F.col("ingest_date") == F.current_date())
    assert column(today) == [True]


# aggregates


@pytest.fixture(scope="module")
def trips(spark):
    return spark.sql(
        """SELECT CAST(t AS TIMESTAMP_NTZ) AS pickup_datetime, source, fare AS fare_amount,
                  distance AS trip_distance, 3.0D AS trip_duration
           FROM VALUES ('2024-01-02 10:00:00', 'yellow', 4.0D, 1.0D),
                       ('2024-01-01 10:00:00', 'yellow', 2.0D, 3.0D),
                       ('2024-01-01 23:59:59', 'green', 8.0D, null),
                       ('2024-01-01 00:00:00', 'yellow', 6.0D, 5.0D) AS v(t, source, fare, distance)"""
    )


def test_daily_summary(trips):
    assert daily_summary(trips).collect() == [
        (date(2024, 1, 1), 3, 16.0, 4.0, 3.0),
        (date(2024, 1, 2), 1, 4.0, 1.0, 3.0),
    ]


def test_source_metrics_absent_source_is_null(trips):
    rows = source_metrics(trips, ["green", "yellow"]).collect()
    assert rows[0].asDict()["green_total_trips"] == 1 and rows[0]["yellow_avg_fare"] == 4.0
    assert rows[1]["green_total_trips"] is None and rows[1]["green_max_fare"] is None
    assert rows[1]["yellow_total_trips"] == 1


def test_source_metrics_finds_sources(trips):
    named = source_metrics(trips, ["green", "yellow"])
    assert source_metrics(trips).collect() == named.collect()
    with_null = trips.union(trips.limit(1).withColumn("source", F.lit(None).cast("string")))
    assert "null_total_trips" in source_metrics(with_null).columns


def test_source_metrics_with_one_metric_keeps_its_name(trips):
    one = source_metrics(trips, ["green", "yellow"], metrics={"trips": F.count(F.lit(1))})
    assert one.columns == ["date", "green_trips", "yellow_trips"]


def test_metric_series(trips):
    series = metric_series(source_metrics(trips, ["yellow"], unlisted="drop"), ["yellow"], ["max_fare"])
    assert series.collect() == [(date(2024, 1, 1), 6.0), (date(2024, 1, 2), 4.0)]


def test_aggregates_of_nothing(trips):
    none = trips.limit(0)
    assert daily_summary(none).count() == 0
    assert source_metrics(none, ["green"]).count() == 0
    profile = column_profile(none.select("fare_amount")).first()
    assert (profile.value_count, profile.unique_count, profile.null_count) == (0, 0, 0)


def test_preview(trips):
    assert column(preview(trips, 2, ["fare_amount"]), "fare_amount") == [2.0, 4.0]
    assert preview(trips, 3).count() == 3


# quantiles, profile, histograms


def test_quantile_sketch_stays_within_its_error(spark):
    df = spark.range(10_001).select((F.col("id") * F.col("id")).cast("double").alias("x"))
    for error in (0.05, 0.001):
        (found,) = quantile_bounds(df, "x", [0.1, 0.5, 0.9], error).first()
        ranks = [math.sqrt(v) / 10_000 for v in found]
        assert all(abs(r - p) <= error + 1e-3 for r, p in zip(ranks, [0.1, 0.5, 0.9]))


@pytest.mark.parametrize("relative_error", [0.0, 0.001])
def test_quantiles_come_in_the_order_asked_for(spark, relative_error):
    df = spark.range(1, 101).select(F.col("id").cast("int").alias("x"))
    (found,) = quantile_bounds(df, "x", [0.5, 0.1, 0.5, 1e-05, 1], relative_error).first()
    assert found == [50.0, 10.0, 50.0, 1.0, 100.0]


def test_quantile_bounds_reject_bad_arguments(spark):
    for bad in ([], [1.5]):
        with pytest.raises(ValueError):
            quantile_bounds(doubles(spark), "x", bad)
    with pytest.raises(ValueError):
        quantile_bounds(doubles(spark), "x", relative_error=-0.1)


def test_profile_modes_agree(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (2, "b", 2.0), (2, None, 4.0)], "i INT, s STRING, d DOUBLE"
    ).withColumn("t", F.expr("timestamp_ntz'2024-01-01 00:00:00'"))
    exact = {r.column_name: r for r in column_profile(df).collect()}
    sketched = {r.column_name: r for r in column_profile(df, exact_distinct=False).collect()}
    assert exact == sketched and list(exact) == df.columns
    assert exact["i"][1:] == (3, pytest.approx(5 / 3), pytest.approx(0.57735, abs=1e-5), "1", "2", 2, 0)
    assert exact["s"][1:] == (2, None, None, "a", "b", 2, 1)
    assert exact["d"][1:] == (2, 3.0, pytest.approx(2**0.5), "2.0", "4.0", 2, 1)
    assert exact["t"][1:] == (3, None, None, "2024-01-01 00:00:00", "2024-01-01 00:00:00", 1, 0)


def test_histogram_counts_every_number_once(spark):
    df = doubles(spark, 0.0, 0.1, 2.5, 9.99, 10.0, None, NAN)
    rows = histogram(df, "x", 5).orderBy("bin").collect()
    assert [r.n for r in rows] == [2, 1, 0, 0, 2]
    assert (rows[0].low, rows[0].high, rows[-1].high) == (0.0, 2.0, 10.0)


def test_histogram_of_one_value_and_of_none(spark):
    rows = histogram(doubles(spark, 3.0, 3.0), "x", 4).orderBy("bin").collect()
    assert [r.n for r in rows] == [0, 0, 2, 0] and rows[0].low == 2.5
    assert column(histogram(doubles(spark), "x", 3), "n") == [0, 0, 0]


def test_histogram_2d_skips_rows_without_both_numbers(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0), (1.0, 10.0), (1.0, 10.0), (0.5, None), (NAN, 3.0)], "x DOUBLE, y DOUBLE"
    )
    assert sorted(histogram_2d(df, "x", "y", 2, 2).collect()) == [(0, 0, 1), (1, 1, 2)]
    assert sorted(histogram_2d(df, "y", "y", 2, 2).collect()) == [(0, 0, 2), (1, 1, 2)]


def test_unlisted_sources_fail_unless_dropped(spark):
    trips = spark.createDataFrame(
        [(datetime(2024, 1, 1), s, 1.0, 2.0) for s in ("green", "red", None)],
        "pickup_datetime TIMESTAMP, source STRING, fare_amount DOUBLE, trip_distance DOUBLE",
    )
    with pytest.raises(Exception, match="not listed"):
        source_metrics(trips, ["green"]).collect()
    with pytest.raises(Exception, match="not listed: null"):
        source_metrics(trips.filter("source IS NULL"), ["green"]).collect()
    assert source_metrics(trips, ["green"], unlisted="drop").first().green_total_trips == 1
    with pytest.raises(ValueError, match="unlisted"):
        source_metrics(trips, ["green"], unlisted="keep")


def test_excluding_no_date_keeps_all_rows(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),), (None,)], "date DATE")
    assert exclude_dates(df, []).count() == 2


def test_null_comes_first_among_ignored_columns(spark):
    df = spark.createDataFrame([(1, None, 2), (1, 5, None)], "k INT, x INT, y INT")
    assert dedup_rows(df.drop("y"), ignore=["x"]).collect() == [(1, None)]
    assert dedup_rows(df, ignore=["x", "y"]).collect() == [(1, None, 2)]


def test_histogram_of_infinite_values_and_large_constants(spark):
    values = [float("inf"), float("-inf"), float("nan"), None, 1.0, 2.0]
    rows = histogram(spark.createDataFrame([(v,) for v in values], "x DOUBLE"), "x", 2).collect()
    assert sum(r.n for r in rows) == 2
    for constant in (1e17, -1e17, 0.0, 3.0):
        rows = histogram(spark.createDataFrame([(constant,)] * 3, "x DOUBLE"), "x", 4).collect()
        assert sum(r.n for r in rows) == 3 and all(r.low < r.high for r in rows)


def test_exact_quantiles_of_doubles_that_share_a_single(spark):
    """300,000 doubles of one single-precision value: every window stays small."""
    df = spark.range(300_000).select((F.lit(1.7e9) + F.col("id") * 1e-4).alias("x"))
    exact = [1.7e9 + k * 1e-4 for k in (74_999, 224_999)]
    assert quantile_bounds(df, "x", relative_error=0.0).first()[0] == exact


def test_exact_quantiles_refuse_what_no_double_holds(spark):
    df = spark.createDataFrame([(9007199254740993,), (1,)], "x LONG")
    with pytest.raises(Exception, match="no double"):
        quantile_bounds(df, "x", relative_error=0.0).collect()
    fine = spark.createDataFrame([(9007199254740992,), (None,)], "x LONG")
    assert quantile_bounds(fine, "x", relative_error=0.0).first()[0] == [2.0**53] * 2
