"""Layer flows end to end on hand-made rows."""

from datetime import date, datetime

import pytest

from tripstrata.plans import flows
from tripstrata.plans.draft import clean_first_draft, draft_steps
from tripstrata.plans.rules import GREEN, YELLOW
from tripstrata.sources.readers import read_layer
from tripstrata.sources.scratch import scratch_dir

YELLOW_SCHEMA = (
    "VendorID INT, tpep_pickup_datetime TIMESTAMP_NTZ, tpep_dropoff_datetime TIMESTAMP_NTZ,"
    " passenger_count DOUBLE, trip_distance DOUBLE, RatecodeID DOUBLE, store_and_fwd_flag STRING,"
    " payment_type BIGINT, fare_amount DOUBLE, extra DOUBLE, mta_tax DOUBLE, tip_amount DOUBLE,"
    " tolls_amount DOUBLE, improvement_surcharge DOUBLE, total_amount DOUBLE,"
    " congestion_surcharge DOUBLE, Airport_fee DOUBLE"
)
MONEY = (-6.0, -1.0, 0.5, None, 0.0, 1.0, -6.0, 2.5, None)


def trip(day=2, distance=2.0, vendor=1, passengers=1.0, rate=1.0, flag=None, payment=1, hour=10):
    start = datetime(2024, 1, day, hour)
    return (vendor, start, start.replace(minute=12), passengers, distance, rate, flag, payment, *MONEY)


KEPT = [trip(distance=d) for d in (1.0, 2.0, 3.0, 4.0)]
DROPPED = [
    trip(distance=90.0),
    trip(distance=0.0),
    trip(vendor=3),
    trip(passengers=0.0),
    trip(passengers=None),
    trip(rate=99.0),
    trip(payment=0),
    trip(payment=6),
    trip(day=31, hour=1),
]


@pytest.fixture(scope="module")
def yellow(spark):
    return spark.createDataFrame(KEPT + DROPPED + KEPT, YELLOW_SCHEMA)


@pytest.fixture(scope="module")
def green(spark, yellow):
    names = {"tpep_pickup_datetime": "lpep_pickup_datetime", "tpep_dropoff_datetime": "lpep_dropoff_datetime"}
    renamed = yellow.withColumnsRenamed(names).drop("Airport_fee")
    return renamed.selectExpr("*", "rand() AS ehail_fee", "1 AS trip_type")


def stamped(df, source):
    return flows.add_ingest_metadata(df, source, "2024-02-01")


@pytest.mark.parametrize("staged", [False, True])
def test_silver_yellow(spark, yellow, staged):
    path = scratch_dir(spark, "stage") if staged else None
    rows = flows.silver(stamped(yellow, "yellow"), YELLOW, path, relative_error=0.0)
    first, *rest = rows.orderBy("trip_distance").collect()
    assert [r.trip_distance for r in (first, *rest)] == [1.0, 2.0, 3.0, 4.0]
    assert first.asDict() == {
        "vendor_id": 1, "passenger_count": 1.0, "trip_distance": 1.0, "ratecode_id": 1.0,
        "store_and_fwd_flag": "N", "payment_type": 2, "fare_amount": 6.0, "extra": 1.0,
        "mta_tax": 0.5, "tip_amount": None, "tolls_amount": 0.0, "improvement_surcharge": 1.0,
        "total_amount": 6.0, "congestion_surcharge": 2.5, "airport_fee": None,
        "ingest_date": date(2024, 2, 1), "source": "yellow",
        "pickup_datetime": datetime(2024, 1, 2, 10), "dropoff_datetime": datetime(2024, 1, 2, 10, 12),
        "trip_duration": 12.0, "fare_per_mile": 6.0,
    }


def test_silver_green_drops_a_column_before_comparing_rows(spark, green):
    with pytest.warns(UserWarning, match="Airport_fee"):
        rows = flows.silver(stamped(green, "green"), GREEN, relative_error=0.0)
    assert "ehail_fee" not in rows.columns and "trip_type" in rows.columns
    assert sorted(r.trip_distance for r in rows.collect()) == [1.0, 2.0, 3.0, 4.0]


def test_first_draft_keeps_copies_and_unchecked_payments(yellow):
    rows = clean_first_draft(yellow, relative_error=0.0).collect()
    assert len(rows) == 2 * len(KEPT) + 3  # both odd payments and the late day stay
    assert {r.store_and_fwd_flag for r in rows} == {"N"}
    assert {r.payment_type for r in rows} == {1, 2, 7}
    assert min(r.fare_amount for r in rows) == 6.0
    assert list(draft_steps()) == [
        "vendor", "passengers", "distance", "rate_code", "flag", "payment", "negatives"
    ]


@pytest.mark.filterwarnings("ignore:columns not found")
@pytest.mark.parametrize("mode, trips", [("append", 12), ("replace_partitions", 4)])
def test_rerun_of_the_whole_flow(spark, yellow, green, mode, trips):
    """Silver re-reads all of bronze, so an appending rerun counts trips again.

    Bronze copies of one date collapse, but the second silver run appends all
    trips beside the first; replacing partitions keeps one of each.
    """
    root = scratch_dir(spark, "rerun")
    feeds = (flows.Feed("yellow", yellow, YELLOW), flows.Feed("green", green, GREEN))
    for _ in range(3):
        gold = flows.medallion(
            feeds, root, ["2024-01-31"], as_of="2024-02-01", mode=mode, relative_error=0.0
        )
    (day,) = gold["source_metrics"].collect()
    assert (day.yellow_total_trips, day.green_total_trips) == (trips, trips)
    assert (day.yellow_avg_fare, day.yellow_max_trip_distance, day.date) == (6.0, 4.0, date(2024, 1, 2))
    (summary,) = gold["daily_summary"].collect()
    assert (summary.total_trips, summary.total_fare_amount) == (trips, 6.0 * trips)
    assert read_layer(spark, f"{root}/silver/yellow").count() == trips


@pytest.mark.filterwarnings("ignore:columns not found")
def test_silver_of_new_loads_only(spark, yellow, green):
    """With ``since`` an appending flow takes each load once."""
    root = scratch_dir(spark, "daily")
    feeds = (flows.Feed("yellow", yellow, YELLOW), flows.Feed("green", green, GREEN))
    for day in ("2024-02-01", "2024-02-02", "2024-02-03"):
        gold = flows.medallion(feeds, root, as_of=day, since=day, relative_error=0.0)
    assert read_layer(spark, f"{root}/bronze/yellow").count() == 3 * yellow.count()
    assert read_layer(spark, f"{root}/silver/green").count() == 3 * len(KEPT)
    assert [r.yellow_total_trips for r in gold["source_metrics"].collect()] == [3 * len(KEPT)]


def test_side_by_side_keeps_the_order_and_raises(spark):
    assert flows.side_by_side(spark, lambda n: spark.range(n).count(), [3, 1, 2]) == [3, 1, 2]
    with pytest.raises(ZeroDivisionError):
        flows.side_by_side(spark, lambda n: 1 // n, [1, 0])
