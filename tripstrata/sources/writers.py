"""Sinks and table maintenance.

Writes use the file commit protocol of Spark: a lost executor only repeats its
tasks, and files of failed attempts are never visible.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from tripstrata.sources.readers import read_layer, record_schema, recorded_schema, stored_schema

# On the trip tables zstd writes files as small as gzip in well under the time.
# Pass codec="gzip" for readers that need it.
CODEC = "zstd"
MODES = ("append", "overwrite", "replace_partitions")


def _types(schema: StructType, partition_by: Sequence[str]) -> dict[str, DataType | None]:
    """Column types by name without case.  Those of partition columns are guessed from
    folder names, so they do not count."""
    partitions = {name.lower() for name in partition_by}
    return {f.name.lower(): None if f.name.lower() in partitions else f.dataType for f in schema}


def _as_stored(df: DataFrame, before: StructType) -> DataFrame:
    """The rows with the spelling of column names that the table has."""
    if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true":
        return df
    spelling = {f.name.lower(): f.name for f in before}
    return df.toDF(*[spelling.get(name.lower(), name) for name in df.columns])


def _writer(
    df: DataFrame,
    mode: str,
    fmt: str,
    partition_by: Sequence[str],
    codec: str,
    rebalance: bool,
) -> DataFrameWriter:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if rebalance and partition_by:
        # One shuffle that groups rows by partition value.  Adaptive execution
        # splits a value that outgrows a task and packs small ones together.
        if df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
            raise RuntimeError("a rebalanced write needs spark.sql.adaptive.enabled: one value would fill one task")
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).option("compression", codec)
    if mode == "replace_partitions":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        # Stated, since a session may ask for dynamic: the whole table goes.
        writer = writer.mode(mode).option("partitionOverwriteMode", "static")
    return writer.partitionBy(*partition_by) if partition_by else writer


def append_evolving(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("ingest_date",),
    mode: str = "append",
    fmt: str = "parquet",
    codec: str = CODEC,
    rebalance: bool = False,
    before: StructType | None = None,
) -> StructType:
    """Add rows; the table may gain columns but a column keeps its type.

    Each task writes its own files: a load has one ``ingest_date``, so shuffling
    by it would put the whole load in one task.  ``mode='replace_partitions'``
    makes a repeated load replace the first instead of doubling it.

    Names are compared without case, and the stored spelling stays.  The schema is
    kept beside the table and returned: neither readers nor the next load then have
    to merge the footers of all files, which takes longer the more loads there are.
    """
    spark = df.sparkSession
    known = None if mode == "overwrite" else recorded_schema(spark, path)
    if mode == "overwrite":
        before = None
    elif before is None:
        before = known or stored_schema(spark, path, fmt, recorded=False)
    if before is not None:
        df = _as_stored(df, before)
        old, new = _types(before, partition_by), _types(df.schema, partition_by)
        changed = [c for c in new if c in old and new[c] != old[c]]
        if changed:
            raise TypeError(f"{path} stores other types for {changed}")
    _writer(df, mode, fmt, partition_by, codec, rebalance).option("mergeSchema", True).save(path)
    older = [f for f in before or () if f.name not in df.columns]
    schema = StructType([StructField(f.name, f.dataType) for f in [*df.schema, *older]])
    record_schema(spark, path, schema, known)
    return schema


def append_fixed(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("ingest_date",),
    mode: str = "append",
    fmt: str = "parquet",
    codec: str = CODEC,
    rebalance: bool = False,
) -> None:
    """Add rows with exactly the columns and types of the stored table.

    Ask for ``rebalance`` when the rows span many partition values and come out of
    a shuffle: otherwise each task writes a file for each value.
    """
    known = None if mode == "overwrite" else recorded_schema(df.sparkSession, path)
    before = known
    if known is None and mode != "overwrite":
        before = stored_schema(df.sparkSession, path, fmt, recorded=False)
    if before is not None:
        df = _as_stored(df, before)
        if _types(before, partition_by) != _types(df.schema, partition_by):
            raise TypeError(f"schema of {path} is {before.simpleString()}, got {df.schema.simpleString()}")
    _writer(df, mode, fmt, partition_by, codec, rebalance).save(path)
    record_schema(df.sparkSession, path, df.schema, known)


def overwrite(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    codec: str = CODEC,
    rebalance: bool = True,
) -> None:
    """Replace the whole table, whatever the session says of partitions.

    All its files then have one schema, so none is kept beside it.
    """
    _writer(df, "overwrite", fmt, partition_by, codec, rebalance).save(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet", codec: str = CODEC) -> None:
    """Write partitions of a table of fixed schema, in place of those that it has; others stay.

    Without rows nothing changes, but for the schema of a table that is new.
    """
    spark = df.sparkSession
    before = recorded_schema(spark, path)
    _writer(df, "replace_partitions", fmt, partition_by, codec, rebalance=False).save(path)
    record_schema(spark, path, df.schema, before)


def stage(df: DataFrame, path: str, codec: str = CODEC) -> DataFrame:
    """Write an intermediate result to a fresh folder under ``path`` and go on from it.

    Later steps read only the columns they need and never repeat the work above,
    also when an executor is lost.  Plans over an earlier stage keep their files.
    """
    leaf = f"{path}/{uuid4().hex}"
    df.write.option("compression", codec).parquet(leaf)
    return df.sparkSession.read.schema(df.schema).parquet(leaf)


def quoted_name(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def quoted_literal(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _plain(path: str) -> str:
    return re.sub(r"^file:/+", "/", path).rstrip("/")


def table_location(spark: SparkSession, name: str) -> str | None:
    """Where a registered table lies; None when the name is free."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted_name(name)}").filter("col_name = 'Location'")
    return rows.first().data_type


def table_property(spark: SparkSession, name: str, key: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted_name(name)}").filter(F.col("key") == key).collect()
    return rows[0].value if rows else None


def set_table_property(spark: SparkSession, name: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {quoted_name(name)} SET TBLPROPERTIES ({quoted_literal(key)} = {quoted_literal(value)})")


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    schema: StructType | None = None,
) -> DataFrame:
    """Put the table at ``path`` in the catalog under ``name``, with all its columns.

    A name that shows the same path is refreshed and gets the columns added since; a
    name that shows another one is refused (``repoint_table`` moves it).
    """
    schema = schema or stored_schema(spark, path, fmt)
    if schema is None:
        raise ValueError(f"there is no table at {path}")
    at = table_location(spark, name)
    if at is None:
        columns = ", ".join(f"{_quoted_column(f.name)} {f.dataType.simpleString()}" for f in schema)
        parts = f"PARTITIONED BY ({', '.join(map(_quoted_column, partition_by))})" if partition_by else ""
        spark.sql(f"CREATE TABLE {quoted_name(name)} ({columns}) USING {fmt} {parts} LOCATION {quoted_literal(path)}")
    elif _plain(at) != _plain(path):
        raise ValueError(f"{name} shows {at}, not {path}")
    else:
        _add_columns(spark, name, schema)
    return refresh_table(spark, name, bool(partition_by))


def _quoted_column(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _add_columns(spark: SparkSession, name: str, schema: StructType) -> None:
    known = {column.lower() for column in spark.table(name).columns}
    new = [f for f in schema if f.name.lower() not in known]
    if new:
        columns = ", ".join(f"{_quoted_column(f.name)} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {quoted_name(name)} ADD COLUMNS ({columns})")


def refresh_table(spark: SparkSession, name: str, partitioned: bool) -> DataFrame:
    """Let the catalog see the files and partitions that are there now."""
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {quoted_name(name)} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def repoint_table(
    spark: SparkSession, name: str, path: str, partitioned: bool = False, schema: StructType | None = None
) -> DataFrame:
    """Make a registered table show the files at ``path``, say a compacted copy.

    Partitions of a table keep their own locations in the catalog, so those of the
    files before are dropped from it first; the files themselves stay.
    """
    if schema is not None:
        _add_columns(spark, name, schema)
    if partitioned:
        _forget_partitions(spark, name)
    spark.sql(f"ALTER TABLE {quoted_name(name)} SET LOCATION {quoted_literal(path)}")
    return refresh_table(spark, name, partitioned)


def _forget_partitions(spark: SparkSession, name: str) -> None:
    specs = []
    for row in spark.sql(f"SHOW PARTITIONS {quoted_name(name)}").collect():
        pairs = (part.split("=", 1) for part in row.partition.split("/"))
        values = (
            f"{_quoted_column(key)} = {'NULL' if value == '__HIVE_DEFAULT_PARTITION__' else quoted_literal(unquote(value))}"
            for key, value in pairs
        )
        specs.append(f"PARTITION ({', '.join(values)})")
    for start in range(0, len(specs), 500):
        spark.sql(f"ALTER TABLE {quoted_name(name)} DROP IF EXISTS {', '.join(specs[start : start + 500])}")


def compact_table(
    spark: SparkSession,
    source: str,
    target: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    codec: str = CODEC,
    schema: StructType | None = None,
) -> DataFrame:
    """Copy a table into few, well-filled files in a fresh folder.

    Neither rows nor columns change: those that only later loads have are copied too.
    Files aim at the advisory partition size of the session; a partition that holds
    most of the table gets several.
    """
    rows = read_layer(spark, source, fmt, schema=schema)
    spread = rows.hint("rebalance", *partition_by) if partition_by else rows.hint("rebalance")
    _writer(spread, "overwrite", fmt, partition_by, codec, rebalance=False).save(target)
    record_schema(spark, target, rows.schema, None)
    return spark.read.format(fmt).schema(rows.schema).load(target)
