"""Rows that no earlier load had, without shuffling what is stored.

Deduplicating all loads together shuffles all of them, each time.  Here every load leaves
the 128-bit digests of its new rows in a table that is bucketed by digest.  The next load
is brought to the buckets, so its rows are shuffled and the stored digests are not; the
stored rows themselves are not read at all.
"""

from __future__ import annotations

from collections.abc import Iterable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.operators.corrections import dedup_rows
from tripstrata.sources.readers import read_layer
from tripstrata.sources.scratch import scratch_dir
from tripstrata.sources.writers import quoted_literal, quoted_name, replace_partitions, stage, stored_schema, table_location

BUCKETS = 64
DIGEST = "_digest"


def row_digest(columns: Iterable[str]) -> Column:
    """16 bytes that stand for the values of a row.

    Rows that count as copies have the same digest: nulls are alike, and so are the two
    zeros and all NaN of a floating-point column.
    """
    names = sorted(columns)
    values = [F.col(f"`{name}`") for name in names]
    # A hash passes over nulls, so where they stand is hashed too.
    nulls = F.concat(*[F.when(v.isNull(), "0").otherwise("1") for v in values])
    halves = (F.xxhash64(nulls, *values), F.xxhash64(F.lit(1), nulls, *values))
    return F.unhex(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in halves]))


def open_history(spark: SparkSession, name: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """The table of digests under ``name``; made at ``path`` when the name is free.

    Buckets are fixed when the table is made: about one for each 100 million rows that it
    is meant to hold.  With a catalog of the session alone, open it again in the next one:
    what lies at ``path`` is found.
    """
    if table_location(spark, name) is None:
        spark.sql(
            f"CREATE TABLE {quoted_name(name)} ({DIGEST} BINARY, load STRING) USING parquet PARTITIONED BY (load) "
            f"CLUSTERED BY ({DIGEST}) SORTED BY ({DIGEST}) INTO {buckets} BUCKETS LOCATION {quoted_literal(path)}"
        )
        if stored_schema(spark, path, recorded=False) is not None:
            spark.sql(f"MSCK REPAIR TABLE {quoted_name(name)}")
    return spark.table(name)


def new_rows(rows: DataFrame, history: DataFrame, load: str, ignore: Iterable[str] = ()) -> DataFrame:
    """Rows of a load that no other load has, each once, with their digests.

    Digests of the load itself do not count, so a load may be repeated.  Copies within
    the load collapse inside tasks first.  The join keeps its shuffle on the side of the
    load: the buckets of the stored digests are taken as they lie.
    """
    skipped = set(ignore)
    own = dedup_rows(rows, skipped).withColumn(DIGEST, row_digest(c for c in rows.columns if c not in skipped))
    others = history.filter(F.col("load") != load).select(DIGEST)
    return own.join(others.hint("merge"), DIGEST, "left_anti")


def append_new(
    rows: DataFrame, path: str, name: str, load: str, ignore: Iterable[str] = (), partition: str = "load"
) -> DataFrame:
    """Add the rows that are new to the table at ``path``, under the partition of the load.

    Returns the table.  A load that is repeated replaces its partition; loads after it
    are not looked at again, so a row that it no longer has does not come back from them.
    """
    spark = rows.sparkSession
    fresh = stage(new_rows(rows, spark.table(name), load, ignore), scratch_dir(spark, "new-rows"))
    stored = fresh.drop(DIGEST).withColumn(partition, F.lit(load))
    replace_partitions(stored, path, [partition])
    fresh.select(DIGEST).createOrReplaceTempView(view := f"digests_{uuid4().hex}")
    try:
        spark.sql(f"INSERT OVERWRITE {quoted_name(name)} PARTITION (load = {quoted_literal(load)}) SELECT {DIGEST} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
    return read_layer(spark, path, schema=stored.schema)
