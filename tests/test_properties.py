"""Properties over generated data, against plain Python."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripstrata.functions.names import snake_case
from tripstrata.operators.columns import snake_case_columns
from tripstrata.operators.corrections import abs_negatives, dedup_rows
from tripstrata.operators.filters import filter_iqr, filter_positive, filter_valid_range
from tripstrata.operators.quantiles import quantile_bounds

FEW = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
PROBABILITIES = [0.0, 0.25, 0.5, 0.75, 1.0]
numbers = st.floats(allow_nan=True, allow_infinity=True)
close = st.integers(0, 40).map(lambda k: 1.0 + k * 2.0**-52)
cents = st.integers(-500, 50_000).map(lambda c: c / 100)
some = st.one_of(st.none(), numbers, close, cents)


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x DOUBLE")


def nearest_rank(values, p):
    ordered = sorted(v for v in values if v is not None and not math.isnan(v))
    return ordered[max(math.ceil(p * len(ordered)), 1) - 1] if ordered else None


@FEW
@given(st.lists(some, max_size=60))
def test_exact_quantiles_are_nearest_rank(spark, values):
    (found,) = quantile_bounds(frame(spark, values), "x", PROBABILITIES, 0.0).first()
    assert found == [nearest_rank(values, p) for p in PROBABILITIES]


@FEW
@given(st.lists(close, min_size=1, max_size=60))
def test_exact_quantiles_of_neighbouring_doubles(spark, values):
    (found,) = quantile_bounds(frame(spark, values), "x", PROBABILITIES, 0.0).first()
    assert found == [nearest_rank(values, p) for p in PROBABILITIES]


def test_exact_quantiles_across_cell_borders(spark):
    """Doubles on both sides of many cell borders, which one single may straddle."""
    values = []
    for k in range(-40, 40):
        border = 2.0 ** (k / 64)
        step = math.ulp(border)
        values += [border + d * step for d in range(-3, 4)] + [-border]
    grid = [i / 37 for i in range(38)]
    (found,) = quantile_bounds(frame(spark, values), "x", grid, 0.0).first()
    assert found == [nearest_rank(values, p) for p in grid]


def test_exact_quantiles_with_one_value_in_a_third_of_the_rows(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7.25).otherwise(F.col("id") / 100).alias("x")
    )
    values = [row.x for row in df.collect()]
    (found,) = quantile_bounds(df, "x", PROBABILITIES, 0.0).first()
    assert found == [nearest_rank(values, p) for p in PROBABILITIES]


@FEW
@given(st.lists(some, max_size=40))
def test_filters_keep_a_sub_bag_that_satisfies_them(spark, values):
    df = frame(spark, values)
    real = [v for v in values if v is not None and not math.isnan(v)]
    in_range = [r.x for r in filter_valid_range(df, {"x": (1, 6)}).collect()]
    assert sorted(in_range) == sorted(v for v in real if 1 <= v <= 6)
    positive = [r.x for r in filter_positive(df, ["x"]).collect() if not math.isnan(r.x)]
    assert sorted(positive) == sorted(v for v in real if v > 0)


@FEW
@given(st.lists(st.one_of(st.none(), cents), max_size=40))
def test_iqr_matches_brute_force(spark, values):
    kept = sorted(r.x for r in filter_iqr(frame(spark, values), ["x"], 0.0).collect())
    q1, q3 = nearest_rank(values, 0.25), nearest_rank(values, 0.75)
    present = [v for v in values if v is not None]
    expected = [v for v in present if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
    assert kept == sorted(expected)


@FEW
@given(st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(0, 2)))))
def test_dedup_is_the_set_of_rows_and_idempotent(spark, rows):
    df = spark.createDataFrame(rows, "a INT, b INT")
    once = dedup_rows(df)
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(set(rows), key=repr)
    assert dedup_rows(once).count() == once.count()


@FEW
@given(st.lists(st.one_of(st.none(), cents), max_size=40))
def test_abs_negatives_is_idempotent(spark, values):
    once = abs_negatives(frame(spark, values), ["x"])
    assert once.collect() == abs_negatives(once, ["x"]).collect()
    assert [r.x for r in once.collect()] == [v if v is None else abs(v) for v in values]


@given(st.text(alphabet="aZ09_- \t", max_size=12))
def test_snake_case_is_idempotent(name):
    assert snake_case(snake_case(name)) == snake_case(name)


def test_snake_case_columns_is_idempotent(spark):
    df = spark.createDataFrame([(1, 2)], "VendorID INT, `Foo-Bar` INT")
    assert snake_case_columns(snake_case_columns(df)).columns == ["vendor_id", "foo_bar"]
