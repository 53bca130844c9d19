"""Layer-to-layer flows.  ``silver`` without a stage path is lazy; the rest run jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import reduce
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

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
from tripstrata.operators.summaries import daily_summary, source_metrics, union_common
from tripstrata.plans.rules import (
    RATE_CODE_SCHEMA,
    RATE_CODES,
    VENDOR_SCHEMA,
    VENDORS,
    CleaningRules,
)
from tripstrata.sources.readers import literal_table, read_csv, read_layer
from tripstrata.sources.scratch import scratch_dir
from tripstrata.sources.writers import (
    append_evolving,
    append_fixed,
    compact_table,
    overwrite,
    register_table,
    repoint_table,
    set_table_property,
    stage,
    table_location,
    table_property,
)


def bronze(
    raw: DataFrame,
    source: str,
    path: str,
    as_of: str | date | None = None,
    mode: str = "append",
    stage_path: str | None = None,
) -> StructType:
    """Raw rows plus load metadata, appended to the bronze table.

    With ``stage_path`` the raw rows and the stamped rows are each handed over
    as files, so a failed step can be repeated from the one before.  Returns the
    schema of the table after the load.
    """
    if stage_path:
        raw = stage(raw, f"{stage_path}/raw")
    stamped = add_ingest_metadata(raw, source, as_of)
    if stage_path:
        stamped = stage(stamped, f"{stage_path}/stamped")
    return append_evolving(stamped, path, mode=mode)


def silver(
    loaded: DataFrame,
    rules: CleaningRules,
    stage_path: str | None = None,
    relative_error: float = 0.05,
    ignore: Iterable[str] = (),
) -> DataFrame:
    """Deduplicate, validate, clean, standardise and enrich one bronze table.

    The row checks are written after the deduplication and run before it: the
    optimizer moves them below the shuffle and into the scan.  ``ignore`` names
    columns that do not make two rows differ, for instance ``ingest_date``.

    The outlier fences read the surviving rows a second time.  At scale give a
    ``stage_path``: the whole-row shuffle then runs once, and the fences read a
    single column of the staged files.
    """
    rows = drop_columns(loaded, rules.drop) if rules.drop else loaded
    rows = dedup_rows(rows, ignore)
    rows = filter_valid_range(rows, rules.valid_ranges)
    rows = filter_time_range(rows, rules.time_column, rules.date_range)
    rows = filter_positive(rows, rules.positive)
    if stage_path:
        rows = stage(rows, stage_path)
    rows = filter_iqr(rows, rules.outliers, relative_error)
    for column, value in rules.fill.items():
        rows = fill_na(rows, [column], value)
    for column, offset in rules.shift.items():
        rows = shift_code(rows, column, offset)
    rows = abs_negatives(rows, rules.unsigned)
    rows = snake_case_columns(rows)
    rows = parse_timestamps(rows, rules.timestamps)
    return rows.transform(add_trip_duration).transform(add_fare_per_mile)


def dimensions(
    spark: SparkSession, root: str, locations_csv: str, locations_schema: StructType | str | None = None
) -> dict[str, str]:
    """Replace the three lookup tables; returns their paths."""
    tables = {
        "dim_vendor": literal_table(spark, VENDORS, VENDOR_SCHEMA),
        "dim_rate_code": literal_table(spark, RATE_CODES, RATE_CODE_SCHEMA),
        "dim_location": snake_case_columns(read_csv(spark, locations_csv, locations_schema)),
    }
    for name, table in tables.items():
        overwrite(table, f"{root}/{name}")
    return {name: f"{root}/{name}" for name in tables}


# Property of a published table: the root that its folders come from.
PUBLISHED_FROM = "published_from"


def publish(
    df: DataFrame,
    path: str,
    table: str | None = None,
    compacted_path: str | None = None,
    tasks: int = 32,
) -> DataFrame:
    """Publish a gold table, one folder per date; optionally register and compact it.

    A gold table has a row per date, so its cost is that of creating the files.
    They are spread over ``tasks``; adaptive execution would pack rows this few
    into one task, which then creates file after file.

    With a ``table`` name, each publish writes a fresh folder under ``path``, compacts
    it into a fresh folder under ``compacted_path`` when that is given, and then points
    the table there, once: readers see the rows of one publish and never a mix, and
    plans over the one before keep their files.  A name that was not published from
    ``path`` is refused.  Without a name, ``path`` itself is replaced.
    """
    spark, spread = df.sparkSession, df.repartition(tasks, "date")
    by_date = ["date"]
    known = table_location(spark, table) is not None if table else False
    if known and table_property(spark, table, PUBLISHED_FROM) != path:
        raise ValueError(f"{table} was not published from {path}")
    target = f"{path}/v-{uuid4().hex}" if table else path
    overwrite(spread, target, partition_by=by_date, rebalance=False)
    if table and not known:
        register_table(spark, table, target, partition_by=by_date, schema=df.schema)
        set_table_property(spark, table, PUBLISHED_FROM, path)
    if compacted_path:
        source, target = target, f"{compacted_path}/v-{uuid4().hex}"
        compact_table(spark, source, target, partition_by=by_date, schema=df.schema)
    if table:
        return repoint_table(spark, table, target, partitioned=True, schema=df.schema)
    return spark.read.schema(df.schema).parquet(target)


@dataclass(frozen=True)
class Feed:
    """One raw input of the whole flow."""

    name: str
    raw: DataFrame
    rules: CleaningRules


def medallion(
    feeds: Sequence[Feed],
    root: str,
    excluded_dates: Iterable[str] = (),
    as_of: str | date | None = None,
    since: str | date | None = None,
    mode: str = "append",
    relative_error: float = 0.05,
    stage_root: str | None = None,
    tables: Mapping[str, str] | None = None,
    ignore: Iterable[str] = (),
    compact: bool = False,
) -> dict[str, DataFrame]:
    """Bronze and silver of all feeds, then the two gold tables.

    The first feed gets the daily summary; the comparison covers them all.  Feeds
    do not depend on each other, nor do the gold tables, so they run side by
    side and fill the cluster while another one waits for its last tasks.

    Silver reads all of bronze, or the loads from ``since`` on, and is staged
    under ``stage_root``, by default a fresh path in the shared scratch folder.
    ``tables`` may map ``daily_summary`` and ``source_metrics`` to catalog names.
    ``ignore`` names columns that do not make two rows differ: with ``ingest_date``
    in it, copies that arrive in several loads count once.  ``compact`` rewrites the
    gold tables into few files before they are shown.
    """
    tables = tables or {}
    spark = feeds[0].raw.sparkSession
    stage_root = stage_root or scratch_dir(spark, "silver-stage")

    def clean(feed: Feed) -> DataFrame:
        in_bronze, in_silver = f"{root}/bronze/{feed.name}", f"{root}/silver/{feed.name}"
        schema = bronze(feed.raw, feed.name, in_bronze, as_of, mode)
        loaded = read_layer(spark, in_bronze, schema=schema, since=since)
        rows = silver(loaded, feed.rules, f"{stage_root}/{feed.name}", relative_error, ignore)
        # Without ``since`` every load date of bronze is in these rows, in every task;
        # with it there is one date as a rule, which needs no shuffle to be together.
        append_fixed(rows, in_silver, mode=mode, rebalance=since is None)
        return read_layer(spark, in_silver, schema=rows.schema)

    cleaned = side_by_side(spark, clean, feeds)
    comparison = source_metrics(reduce(union_common, cleaned), [feed.name for feed in feeds])
    gold = {
        "daily_summary": daily_summary(cleaned[0]),
        "source_metrics": exclude_dates(comparison, excluded_dates) if excluded_dates else comparison,
    }
    published = side_by_side(
        spark,
        lambda name: publish(
            gold[name], f"{root}/gold/{name}", tables.get(name), f"{root}/gold-compact/{name}" if compact else None
        ),
        list(gold),
    )
    return dict(zip(gold, published))


def side_by_side(spark: SparkSession, action: Callable, inputs: Sequence) -> list:
    """Run the Spark jobs of independent inputs at the same time; results in order."""
    with ThreadPoolExecutor(max_workers=len(inputs)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(action), inputs))
