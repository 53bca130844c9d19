"""Scans.  Paths are any that Spark's file systems accept, globs included."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
    mode: str | None = None,
) -> DataFrame:
    """With a schema the file is read once; without one Spark reads it to guess.

    A schema must name the columns as the header does, in its order, and text that
    does not fit a type fails the job; ``mode="PERMISSIVE"`` makes it null instead.
    """
    if schema is None:
        return spark.read.option("inferSchema", True).csv(path, header=header, mode=mode or "PERMISSIVE")
    return spark.read.schema(schema).csv(path, header=header, enforceSchema=not header, mode=mode or "FAILFAST")


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """A small table given in the code.

    It goes in as Arrow, which Spark keeps as a local relation of known size: a
    join then broadcasts it on its own, by the usual size check.
    """
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not rows:
        return spark.createDataFrame([], fields)
    columns = [pa.array(values) for values in zip(*rows, strict=True)]
    return spark.createDataFrame(pa.table(columns, names=fields.names), fields)


def read_layer(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    evolved: bool | None = None,
    since: str | date | None = None,
    partition: str = "ingest_date",
) -> DataFrame:
    """A whole layer table, or its partitions from ``since`` on, with all its columns.

    The columns are those of ``schema``, else of the schema stored beside the table,
    else of all its files.  ``evolved`` overrules the stored schema: true merges the
    footers of all files, false trusts the first file that is found.
    """
    if schema is None and evolved is None:
        schema = recorded_schema(spark, path)
        evolved = True
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    elif evolved:
        reader = reader.option("mergeSchema", True)
    table = reader.load(path)
    return table if since is None else table.filter(F.col(partition) >= F.lit(since).cast("date"))


# Schemas lie in this folder of a table, which readers of the table pass over: one line
# for each time that the columns grew.
SCHEMA_FOLDER = "_schema"
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def recorded_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema stored beside the table, without a look at its files; None without one."""
    try:
        lines = spark.read.text(f"{path}/{SCHEMA_FOLDER}").collect()
    except AnalysisException as failure:
        if failure.getCondition() in _ABSENT:
            return None
        raise
    found: dict[str, StructField] = {}
    for schema in sorted((StructType.fromJson(json.loads(line.value)) for line in lines), key=len, reverse=True):
        for field in schema:
            found.setdefault(field.name.lower(), field)
    return StructType(list(found.values())) if found else None


def record_schema(spark: SparkSession, path: str, schema: StructType, known: StructType | None) -> None:
    """Store the schema beside the table, unless ``known``, what is stored there, has its columns."""
    if known is None or {f.name.lower() for f in schema} - {f.name.lower() for f in known}:
        plain = StructType([StructField(f.name, f.dataType) for f in schema])
        line = literal_table(spark, [(plain.json(),)], "value string")
        line.write.mode("append").text(f"{path}/{SCHEMA_FOLDER}")


def stored_schema(spark: SparkSession, path: str, fmt: str = "parquet", recorded: bool = True) -> StructType | None:
    """Schema of the table at ``path``; None when there is no table yet.

    A table without a stored schema shows its footers, once: writers store it then.
    ``recorded=False`` looks at the footers alone.
    """
    known = recorded_schema(spark, path) if recorded else None
    if known is not None:
        return known
    try:
        return read_layer(spark, path, fmt, evolved=True).schema
    except AnalysisException as failure:
        if failure.getCondition() in _ABSENT:
            return None
        raise
