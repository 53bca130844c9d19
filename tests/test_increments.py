"""Incremental gold, deduplication against history, streams, quarantine, totals."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripstrata.operators.quarantine import judge_rows, quarantined, reconcile
from tripstrata.operators.states import column_states, merge_states, merged_fences, merged_quantiles, read_states, record_states
from tripstrata.operators.totals import totals
from tripstrata.operators.validity import join_valid
from tripstrata.plans import history, incremental
from tripstrata.plans.flows import silver
from tripstrata.plans.rules import CleaningRules
from tripstrata.sources.readers import read_layer, recorded_schema
from tripstrata.sources.writers import replace_partitions
from tripstrata.streaming import ingest, summary

TRIPS = "pickup_datetime timestamp_ntz, source string, fare_amount double, trip_distance double, trip_duration double"


def trips_of(spark, rows):
    return spark.createDataFrame([(day and dt.datetime(2024, 1, day, 5), *rest) for day, *rest in rows], TRIPS)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_load_touches_its_days_only(spark, tmp_path):
    root = str(tmp_path)
    first = trips_of(spark, [(1, "a", 1.0, 2.0, 3.0), (1, "b", None, None, None), (2, "a", 4.0, None, 1.0), (None, "a", 7.0, 1.0, 1.0)])
    second = trips_of(spark, [(2, "a", 6.0, 8.0, 3.0), (3, "b", 1.0, 1.0, 1.0)])
    incremental.advance_gold(first, "1", root, ["a", "b"])
    before = {p: p.stat().st_mtime_ns for p in tmp_path.glob("gold/daily_summary/date=2024-01-01/*.parquet")}
    gold = incremental.advance_gold(second, "2", root, ["a", "b"])
    assert before == {p: p.stat().st_mtime_ns for p in tmp_path.glob("gold/daily_summary/date=2024-01-01/*.parquet")}
    found = {r.date and r.date.day: r for r in gold["daily_summary"].collect()}
    assert sorted(found, key=str) == [1, 2, 3, None]
    assert (found[1].total_trips, found[1].total_fare_amount, found[1].average_trip_distance) == (2, 1.0, 2.0)
    assert (found[2].total_trips, found[2].total_fare_amount, found[2].average_trip_distance, found[2].average_trip_duration) == (2, 10.0, 8.0, 2.0)
    by_source = {r.date and r.date.day: r for r in gold["source_metrics"].collect()}
    assert (by_source[1].a_avg_fare, by_source[1].b_avg_fare, by_source[1].b_total_trips) == (1.0, None, 1)
    assert by_source[2].b_total_trips is None and by_source[2].a_max_fare == 6.0


def test_states_are_read_for_touched_days_alone(spark, tmp_path):
    rows = trips_of(spark, [(day, "a", 1.0, 1.0, 1.0) for day in range(1, 29)])
    incremental.record_load(rows, "1", str(tmp_path))
    states = read_layer(spark, str(tmp_path), schema=incremental.STATE_SCHEMA)
    touched = states.filter(incremental._on([dt.date(2024, 1, 3)]))
    assert "PartitionFilters: [isnotnull(date" in plan_of(touched) or "PartitionFilters: [(date" in plan_of(touched)
    assert len(touched.inputFiles()) == 28  # listed, and pruned when the scan runs
    assert touched.count() == 1


def test_a_repeated_load_counts_once_and_may_lose_days(spark, tmp_path):
    root = str(tmp_path)
    wrong = trips_of(spark, [(1, "a", 1.0, 1.0, 1.0), (2, "a", 1.0, 1.0, 1.0), (5, "a", 1.0, 1.0, 1.0)])
    right = trips_of(spark, [(2, "a", 2.0, 1.0, 1.0)])
    other = trips_of(spark, [(5, "a", 3.0, 1.0, 1.0)])
    for load, rows in (("x", wrong), ("y", other), ("x", right), ("x", right)):
        gold = incremental.advance_gold(rows, load, root, ["a"])
    assert {r.date.day: (r.total_trips, r.total_fare_amount) for r in gold["daily_summary"].collect()} == {2: (1, 2.0), 5: (1, 3.0)}
    assert {r.date.day for r in gold["source_metrics"].collect()} == {2, 5}
    assert incremental.record_load(trips_of(spark, []), "z", f"{root}/states") == []


def test_row_digests_follow_whole_row_equality(spark):
    rows = [(1, None, 0.0), (None, 1, 0.0), (1, 1, 0.0), (1, 1, -0.0), (1, 1, float("nan")), (1, 1, None), (None, None, None)]
    frame = spark.createDataFrame(rows, "a int, b int, c double")
    digests = [bytes(r.d) for r in frame.select(history.row_digest(frame.columns).alias("d")).collect()]
    assert digests[2] == digests[3] and len(set(digests)) == len(rows) - 1
    renamed = frame.select("c", "b", "a")
    assert [bytes(r.d) for r in renamed.select(history.row_digest(renamed.columns).alias("d")).collect()] == digests


def test_history_is_not_shuffled(spark, tmp_path):
    name = "digests_plan"
    history.open_history(spark, name, f"{tmp_path}/digests", buckets=4)
    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("v"))
    history.append_new(rows, f"{tmp_path}/rows", name, "1")
    found = history.new_rows(rows.filter("id > 500").unionByName(spark.range(2000, 2010).select("id", F.lit(0).alias("v"))), spark.table(name), "2")
    assert found.count() == 10
    plan = plan_of(found)
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    # One for copies within the load, one that brings the load to the buckets.
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Exchange hashpartitioning(_digest") == 1
    spark.sql(f"DROP TABLE {name}")
    # The digests stay where they lie and are found again.
    assert history.open_history(spark, name, f"{tmp_path}/digests", buckets=4).count() == 1000
    spark.sql(f"DROP TABLE {name}")


def test_history_equals_deduplicating_everything(spark, tmp_path):
    name = "digests_edges"
    history.open_history(spark, name, f"{tmp_path}/digests", buckets=3)
    loads = {
        "1": [(1, None, "x"), (1, None, "y"), (2, "b", "x")],
        "2": [(1, None, "z"), (3, None, "z"), (None, None, None)],
        "3": [],
        "4": [(None, None, "w"), (3, "b", "w")],
    }
    for load in ("1", "2", "2", "3", "4"):
        rows = spark.createDataFrame(loads[load], "a int, b string, stamp string")
        stored = history.append_new(rows, f"{tmp_path}/rows", name, load, ignore=["stamp"])
    found = sorted([tuple(r) for r in stored.collect()], key=str)
    assert found == sorted([(1, None, "x", "1"), (2, "b", "x", "1"), (3, None, "z", "2"), (None, None, None, "2"), (3, "b", "w", "4")], key=str)
    spark.sql(f"DROP TABLE {name}")


def test_a_repeated_batch_adds_nothing_and_columns_may_grow(spark, tmp_path):
    write = ingest.bronze_batch("feed", f"{tmp_path}/bronze", "2024-02-01")
    first = spark.range(5).select("id")
    write(first, 0)
    write(first.withColumn("more", F.lit(1)), 1)
    write(first.filter("id > 3").withColumn("more", F.lit(2)), 1)
    rows = read_layer(spark, f"{tmp_path}/bronze")
    assert rows.groupBy(ingest.BATCH).count().orderBy(ingest.BATCH).collect() == [(0, 5), (1, 1)]
    assert set(rows.columns) == {"id", "more", "ingest_date", "source", ingest.BATCH}
    with pytest.raises(TypeError):
        write(first.select(F.col("id").cast("string").alias("id")), 2)


def test_the_stream_takes_what_is_new(spark, tmp_path):
    source, bronze = f"{tmp_path}/in", f"{tmp_path}/bronze"
    for day, ids in enumerate((range(4), range(4, 9), range(0))):
        spark.createDataFrame([(i,) for i in ids], "id long").coalesce(1).write.mode("append").parquet(source)
        stream = ingest.read_files(spark, source, "id long", files_per_batch=1)
        ingest.stream_bronze(stream, "feed", bronze, f"{tmp_path}/checkpoint", "2024-02-01").awaitTermination()
        assert read_layer(spark, bronze).count() == (4, 9, 9)[day]
    assert sorted(r.id for r in read_layer(spark, bronze).collect()) == list(range(9))


def test_late_rows_are_told_apart_and_reported(spark, tmp_path):
    root = str(tmp_path)
    write = summary.summary_batch(root, ["a"], delay="2 DAYS")
    batches = [
        [(1, "a", 1.0, 1.0, 1.0), (10, "a", 1.0, 1.0, 1.0)],
        [(7, "a", 5.0, 1.0, 1.0), (8, "a", 2.0, 1.0, 1.0), (None, "a", 4.0, 1.0, 1.0)],  # the watermark is the 8th, 05:00
        [],
        [(8, "a", 3.0, 1.0, 1.0), (12, "a", 3.0, 1.0, 1.0)],
        [(9, "a", 9.0, 1.0, 1.0)],  # the 10th by now
    ]
    for number, rows in enumerate(batches):
        write(trips_of(spark, rows), number)
    write(trips_of(spark, batches[1]), 1)  # judged by what came before it, as the first time
    found = incremental.read_gold(spark, f"{root}/gold", "daily_summary").collect()
    assert {r.date and r.date.day: (r.total_trips, r.total_fare_amount) for r in found} == {
        1: (1, 1.0), 10: (1, 1.0), 8: (2, 5.0), None: (1, 4.0), 12: (1, 3.0)}
    late = {(r.pickup_datetime.day, r.batch, r.missed) for r in summary.late_rows(spark, root).collect()}
    assert late == {(7, 1, dt.datetime(2024, 1, 8, 5)), (9, 4, dt.datetime(2024, 1, 10, 5))}


RULES = CleaningRules(
    time_column="at", timestamps={}, valid_ranges={"code": (1, 3)}, date_range=("2024-01-01", "2024-01-31"),
    positive=("size",), outliers=("size",))


def test_every_row_is_accounted_for(spark, tmp_path):
    at = dt.datetime(2024, 1, 5)
    good = [(n, 1, at, float(8 + n % 5)) for n in range(40)]
    bad = [(50, 9, None, 1.0), (51, None, at, 1.0), (52, 2, None, -1.0), (53, 2, at, None), (54, 2, at, 0.0), (55, 3, at, 900.0)]
    loaded = spark.createDataFrame([*good, *good[:7], *bad, bad[0], bad[5]], "id int, code int, at timestamp_ntz, size double")
    judged = judge_rows(loaded, RULES, str(tmp_path), relative_error=0)
    reasons = {r.id: (r.rejected_by, r.copies) for r in quarantined(judged).collect()}
    assert reasons == {
        50: ("valid_range:code", 2), 51: ("valid_range:code", 1), 52: ("time_range:at", 1), 53: ("positive:size", 1),
        54: ("positive:size", 1), 55: ("outlier:size", 2)}
    counts = {r.outcome: r.rows for r in reconcile(judged).collect()}
    assert counts["kept"] == 40 == silver(loaded, RULES, relative_error=0).count()
    assert counts["copy"] == 9 and sum(counts.values()) == loaded.count()
    assert judge_rows(loaded.limit(0), RULES, relative_error=0).count() == 0


def test_totals_tell_left_out_keys_from_null_ones(spark):
    rows = spark.createDataFrame([("x", None, 1.0), ("x", "v", 2.0), (None, "v", 4.0)], "a string, b string, fare_amount double")
    keys = {"a": F.col("a"), "b": F.col("b")}
    found = totals(rows, keys, [["a", "b"], ["a"], []], {"sum": F.sum("fare_amount")})
    assert {tuple(r) for r in found.collect()} == {
        ("x", None, 0, 1.0), ("x", "v", 0, 2.0), (None, "v", 0, 4.0), ("x", None, 1, 3.0), (None, None, 1, 4.0), (None, None, 3, 7.0)}
    with pytest.raises(ValueError, match="levels"):
        totals(rows, keys, [["c"]])


def test_replaced_partitions_leave_others(spark, tmp_path):
    path = f"{tmp_path}/t"
    both = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    replace_partitions(both, path, ["p"])
    replace_partitions(both.filter("p = 'b'").withColumn("v", F.lit(9)), path, ["p"])
    replace_partitions(both.limit(0), path, ["p"])
    assert sorted(tuple(r) for r in read_layer(spark, path).collect()) == [(1, "a"), (9, "b")]
    assert recorded_schema(spark, path).names == ["v", "p"]


def test_states_of_loads_merge_and_a_repeated_load_counts_once(spark, tmp_path):
    path = str(tmp_path / "states")
    frame = lambda values: spark.createDataFrame([(v, v and str(v)) for v in values], "x double, name string")
    record_states(frame([1e9] * 50), "a", path, ["x"], ["x", "name"])
    record_states(frame([float(n) for n in range(1000)] + [None, float("nan")]), "a", path, ["x"], ["x", "name"])
    record_states(frame([float(n) for n in range(500, 2000)] + [0.0, -0.0]), "b", path, ["x"], ["x", "name"])
    record_states(frame([]), "c", path, ["x"], ["x", "name"])
    states = read_states(spark, path)
    assert states.groupBy("load").count().count() == 3
    merged = {r.column: r for r in merge_states(states).collect()}
    assert (merged["x"].n, merged["x"].n_null, merged["name"].n_null) == (2502, 1, 1)
    assert merged["x"].n_distinct == pytest.approx(2001, rel=0.03)  # NaN is a value
    values = sorted([*range(1000), *range(500, 2000), 0, 0])
    (found,) = merged_quantiles(states, [0.0, 0.5, 1.0]).collect()
    assert (found.quantiles[0], found.quantiles[2]) == (0.0, 1999.0)
    assert abs(values.index(int(found.quantiles[1])) / len(values) - 0.5) < 0.015
    fences = merged_fences(states, "x").first().fences
    low, high = (values[int(p * len(values))] for p in (0.25, 0.75))
    assert fences.low == pytest.approx(low - 1.5 * (high - low), abs=120)
    assert fences.high == pytest.approx(high + 1.5 * (high - low), abs=120)


def test_states_without_values_and_without_columns(spark):
    rows = spark.createDataFrame([(None, float("nan"))], "x double, y double")
    assert [(r.n, r.n_null, r.quantiles) for r in column_states(rows, ["x", "y"], []).collect()] == [(0, 1, None), (0, 0, None)]
    assert merged_quantiles(column_states(rows, ["x", "y"], [])).collect() == []
    with pytest.warns(UserWarning, match="not found"), pytest.raises(ValueError, match="no columns"):
        column_states(rows, ["z"], [])


def test_validity_join_equals_every_pair_compared(spark):
    day = lambda n: None if n is None else dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * n)
    facts = [(n, n % 4 if n % 9 else None, day(None if n % 13 == 0 else n)) for n in range(400)] + [(7, 1, day(7))] * 3
    terms = [(k, f"{k}-{n}", day(low), day(high)) for k in (0, 1, 2, None) for n, (low, high) in enumerate(
        [(None, 20), (20, 21), (50, 300), (300, 300), (310, 305), (250, 320), (350, None), (-9000, -8000)])]
    left = spark.createDataFrame(facts, "_slot0 int, k int, at timestamp_ntz")
    right = spark.createDataFrame(terms, "k int, own string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    want = []
    for number, k, at in facts:
        held = [t for t in terms if None not in (k, at) and t[0] == k and (t[2] is None or t[2] <= at) and (t[3] is None or at < t[3])]
        want += [(number, k, at, *t[1:]) for t in held or [(None,) * 4]]
    for days in (1, 90):
        joined = join_valid(left, right, "k", "at", days=days)
        assert joined.columns == ["_slot0", "k", "at", "own", "valid_from", "valid_to"]
        assert sorted(map(str, map(tuple, joined.collect()))) == sorted(map(str, want))
        assert "NestedLoop" not in plan_of(joined) and "Cartesian" not in plan_of(joined)
    assert join_valid(left.limit(0), right, "k", "at").count() == 0
    alone = join_valid(left, right.limit(0), "k", "at")
    assert alone.count() == len(facts) and alone.filter("own IS NOT NULL").count() == 0
    with pytest.raises(ValueError, match="columns of both"):
        join_valid(left.withColumn("own", F.lit(1)), right, "k", "at")
