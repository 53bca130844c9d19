"""The first draft of cleaning: fewer checks, no deduplication, no time window."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from tripstrata.operators.corrections import abs_negatives, fill_na, shift_code
from tripstrata.operators.filters import filter_iqr, filter_positive, filter_valid_range
from tripstrata.plans.rules import YELLOW

Step = Callable[[DataFrame], DataFrame]


def draft_steps(relative_error: float = 0.05) -> Mapping[str, Step]:
    """The seven cleaners by name, in the order in which the draft applies them.

    The rate code is checked after the outliers are measured, so its invalid
    rows still count towards the quartiles.
    """
    ranges = YELLOW.valid_ranges
    return {
        "vendor": lambda df: filter_valid_range(df, {"VendorID": ranges["VendorID"]}),
        "passengers": lambda df: filter_positive(df, ["passenger_count"]),
        "distance": lambda df: filter_iqr(df, ["trip_distance"], relative_error),
        "rate_code": lambda df: filter_valid_range(df, {"RatecodeID": ranges["RatecodeID"]}),
        "flag": lambda df: fill_na(df, ["store_and_fwd_flag"], "N"),
        "payment": lambda df: shift_code(df, "payment_type"),
        "negatives": lambda df: abs_negatives(df, YELLOW.unsigned),
    }


def clean_first_draft(df: DataFrame, relative_error: float = 0.05) -> DataFrame:
    for step in draft_steps(relative_error).values():
        df = df.transform(step)
    return df
