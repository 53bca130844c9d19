"""Files to bronze as a stream.

Each micro-batch goes to a partition of its own, ``ingest_batch``, which it replaces.  A
batch that Spark repeats after a failure therefore adds nothing, and the stream may stop
anywhere.  Everything else is as in the batch flow: load metadata, evolving columns,
files that every task writes for itself.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tripstrata.operators.enrich import add_ingest_metadata
from tripstrata.sources.writers import append_evolving

BATCH = "ingest_batch"


def read_files(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The files of a folder as a stream; the schema is given, since files are still to come."""
    reader = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def bronze_batch(source: str, path: str, as_of: str | date | None = None) -> Callable[[DataFrame, int], None]:
    """What one micro-batch does: stamp its rows and replace its own partition.

    ``ingest_date`` is the day of the attempt that stays, as in a repeated batch load.
    """

    def write(rows: DataFrame, batch: int) -> None:
        stamped = add_ingest_metadata(rows, source, as_of).withColumn(BATCH, F.lit(batch).cast("long"))
        append_evolving(stamped, path, (BATCH,), mode="replace_partitions")

    return write


def stream_bronze(
    rows: DataFrame, source: str, path: str, checkpoint: str, as_of: str | date | None = None
) -> StreamingQuery:
    """Start a stream that appends what has arrived since it last ran, and then ends.

    ``checkpoint`` lies in the shared folder and belongs to this stream and table alone.
    """
    return (
        rows.writeStream.foreachBatch(bronze_batch(source, path, as_of))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
