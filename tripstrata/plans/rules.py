"""What "clean" means for a feed, as data."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from tripstrata.operators.filters import DEFAULT_DATE_RANGE, DEFAULT_TIME_COLUMN


@dataclass(frozen=True)
class CleaningRules:
    """One raw feed.  The order in which rules apply is that of ``flows.silver``."""

    time_column: str
    timestamps: Mapping[str, str]
    drop: tuple[str, ...] = ()
    valid_ranges: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    date_range: tuple[str, str] = DEFAULT_DATE_RANGE
    positive: tuple[str, ...] = ()
    outliers: tuple[str, ...] = ()
    fill: Mapping[str, str | int | float] = field(default_factory=dict)
    shift: Mapping[str, int] = field(default_factory=dict)
    unsigned: tuple[str, ...] = ()


# Column names, code ranges and defaults of the two feeds.
MONEY_COLUMNS = (
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge", "Airport_fee",
)
YELLOW = CleaningRules(
    time_column=DEFAULT_TIME_COLUMN,
    timestamps={
        "tpep_pickup_datetime": "pickup_datetime",
        "tpep_dropoff_datetime": "dropoff_datetime",
    },
    valid_ranges={"VendorID": (1, 2), "RatecodeID": (1, 6), "payment_type": (1, 5)},
    positive=("passenger_count", "trip_distance"),
    outliers=("trip_distance",),
    fill={"store_and_fwd_flag": "N"},
    shift={"payment_type": 1},
    unsigned=MONEY_COLUMNS,
)
GREEN = replace(
    YELLOW,
    time_column="lpep_pickup_datetime",
    timestamps={
        "lpep_pickup_datetime": "pickup_datetime",
        "lpep_dropoff_datetime": "dropoff_datetime",
    },
    drop=("ehail_fee",),
)
# The lookup tables.
VENDORS = (
    (1, "Creative Mobile Technologies, LLC"),
    (2, "VeriFone Inc."),
)
RATE_CODES = (
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
)
VENDOR_SCHEMA = "vendor_id BIGINT, vendor_name STRING"
RATE_CODE_SCHEMA = "rate_code_id BIGINT, rate_description STRING"
