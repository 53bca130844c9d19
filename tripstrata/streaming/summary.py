"""Gold tables from a stream of trips, with a rule for late rows.

The watermark of a batch is the latest event time of the batches before it, less a delay.
Rows before the day of the watermark are late: their days are closed, and they go to a
table of late rows with the watermark that they missed.  All others become a load of the
incremental gold tables, named by the batch.

Watermarks are kept by batch, and a batch looks at earlier ones only.  A batch that
is repeated judges as it did the first time and replaces what it left.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripstrata.plans.incremental import advance_gold
from tripstrata.sources.readers import read_layer
from tripstrata.sources.scratch import scratch_dir
from tripstrata.sources.writers import replace_partitions, stage, stored_schema

_SEEN = "latest timestamp_ntz, batch long"


def watermark_before(spark: SparkSession, root: str, batch: int, delay: str) -> str | None:
    """Latest event time of earlier batches less the delay, as text; None at the start."""
    if stored_schema(spark, f"{root}/seen") is None:
        return None
    seen = read_layer(spark, f"{root}/seen", schema=_SEEN).filter(F.col("batch") < batch)
    mark = F.max("latest") - F.expr(f"INTERVAL {delay}")
    return seen.select(mark.cast("string")).first()[0]


def summary_batch(
    root: str, sources: Sequence[str], delay: str = "2 DAYS", time_column: str = "pickup_datetime"
) -> Callable[[DataFrame, int], None]:
    """What one micro-batch does to the gold tables under ``root``."""

    def write(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        rows = stage(rows, scratch_dir(spark, "micro-batch"))
        mark = watermark_before(spark, root, batch, delay)
        mark = F.lit(mark).cast("timestamp_ntz")  # null, and nothing is late, at the start
        closed = F.to_date(time_column) < mark.cast("date")
        late = F.coalesce(closed, F.lit(False))  # a row without a time is of no day, and never late
        missed = rows.filter(late).withColumn("missed", mark).withColumn("batch", F.lit(batch).cast("long"))
        replace_partitions(missed, f"{root}/late", ["batch"])
        advance_gold(rows.filter(~late), f"batch-{batch}", root, sources, time_column=time_column)
        latest = rows.agg(F.max(F.col(time_column).cast("timestamp_ntz")).alias("latest")).filter("latest IS NOT NULL")
        replace_partitions(latest.withColumn("batch", F.lit(batch).cast("long")), f"{root}/seen", ["batch"])

    return write


def stream_summary(
    rows: DataFrame, root: str, checkpoint: str, sources: Sequence[str], delay: str = "2 DAYS", time_column: str = "pickup_datetime"
) -> StreamingQuery:
    """Start a stream that brings the gold tables up to date with what has arrived, and then ends."""
    return (
        rows.writeStream.foreachBatch(summary_batch(root, sources, delay, time_column))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def late_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows that came after their day was closed, by batch and the watermark they missed."""
    return read_layer(spark, f"{root}/late")
