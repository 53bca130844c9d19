"""Running counts, sums and bit sums along each key, also of keys that fill many tasks."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tripstrata.llm.common import importable_in_tasks, tidy
from tripstrata.sources.scratch import scratch_dir

_PLUS, _XOR = np.add, np.bitwise_xor


def running(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    count: str | None = None,
    sums: Mapping[str, str] | None = None,
    xors: Mapping[str, str] | None = None,
) -> DataFrame:
    """The rows with running values of their key in that order, each including its row.

    ``count`` names a column for the running number of rows, ``sums`` and ``xors`` map
    columns of longs without nulls to names for their running values.  ``key`` is a
    long without nulls.  Sums beyond 64 bits wrap around.

    A window would put a key in one task.  Here rows are sorted by range over key and
    order, so a key may span tasks.  Each task runs along its rows and the result is
    written to the shared folder.  A key that crosses the border of two tasks gets what
    it had gathered before; there are at most as many of those as tasks.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "running")
    columns = {count: ("", _PLUS)} if count else {}
    columns |= {name: (source, _PLUS) for source, name in (sums or {}).items()}
    columns |= {name: (source, _XOR) for source, name in (xors or {}).items()}
    schema = StructType([*df.schema, *[StructField(c, LongType()) for c in columns], StructField("_part", IntegerType())])
    importable_in_tasks(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, carried = None, dict.fromkeys(columns, np.int64(0))
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            first = np.concatenate([[True], keys[1:] != keys[:-1]])
            begin = np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))
            out = []
            for name, (source, op) in columns.items():
                values = batch.column(source).to_numpy(zero_copy_only=False) if source else np.ones(len(keys), np.int64)
                total = np.concatenate([[0], op.accumulate(values.astype(np.int64))])
                before = total[begin]
                result = total[1:] - before if op is _PLUS else total[1:] ^ before
                if keys[0] == held:
                    own = begin == 0
                    result[own] = op(result[own], carried[name])
                carried[name] = result[-1]
                out.append(pa.array(result, pa.int64()))
            held = keys[-1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *out, pa.array(np.full(len(keys), part, np.int32))],
                names=[*batch.schema.names, *columns, "_part"],
            )

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(tasks, key, *order).sortWithinPartitions(key, *order)
    ordered.mapInArrow(tidy(run), schema).write.parquet(f"{path}/rows")
    rows = spark.read.schema(schema).parquet(f"{path}/rows")

    # At most one row for each task: the last key of a task and the first of the next.
    ends = rows.groupBy("_part").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    crossing = (
        ends.withColumn("next", F.lead("low").over(Window.orderBy("_part")))
        .filter("high = next")
        .select(F.col("high").alias("_key"))
        .distinct()
    )
    if crossing.isEmpty():
        return rows.drop("_part")
    gathered = (
        rows.join(F.broadcast(crossing), F.col(key) == F.col("_key"))
        .groupBy("_key", F.col("_part").alias("_of"))
        .agg(F.count(F.lit(1)).alias("_n"), *[
            F.coalesce(F.sum(source) if op is _PLUS else F.bit_xor(source), F.lit(0)).alias(f"_{name}")
            for name, (source, op) in columns.items() if source
        ])
    )
    past = Window.partitionBy("_key").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    offsets = gathered.select("_key", "_of", *[
        F.coalesce(
            F.sum("_n").over(past) if not source else F.sum(f"_{name}").over(past) if op is _PLUS else F.bit_xor(f"_{name}").over(past),
            F.lit(0),
        ).alias(f"_{name}")
        for name, (source, op) in columns.items()
    ])
    offsets.write.parquet(f"{path}/offsets")
    found = F.broadcast(spark.read.parquet(f"{path}/offsets"))
    joined = rows.join(found, (F.col(key) == F.col("_key")) & (F.col("_part") == F.col("_of")), "left")

    def whole(name: str, op: np.ufunc):
        before = F.coalesce(f"_{name}", F.lit(0))
        return (F.col(name) + before if op is _PLUS else F.col(name).bitwiseXOR(before)).alias(name)

    return joined.select(*df.columns, *[whole(name, op) for name, (_, op) in columns.items()])
