"""CSV in bounded batches.

A plain CSV scan is already split over tasks. These functions are for work that has to see
the input a bounded number of files at a time; progress is kept in a checkpoint, so a
restarted run goes on after the last finished batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from panelkit.session import new_path
from panelkit.sources.csv import QUOTES, in_file_order


def csv_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    files_per_batch: int = 1,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Streaming scan of a directory of headered CSV files; columns are found by name."""
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    df = (
        spark.readStream.schema(in_file_order(spark, path, wanted))
        .option("header", True)
        .options(**QUOTES)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(path)
    )
    return df.select(*(wanted.names if columns is None else columns))


def for_each_batch(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str | None = None,
) -> None:
    """Call ``handle(batch, number)`` for every batch that is there now, then return."""
    checkpoint = checkpoint or new_path(stream.sparkSession, "stream-progress")
    (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def stream_to_parquet(stream: DataFrame, path: str, checkpoint: str | None = None) -> DataFrame:
    """Append every batch that is there now to a Parquet table, each file exactly once."""
    spark = stream.sparkSession
    checkpoint = checkpoint or new_path(spark, "stream-progress")
    (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
        .awaitTermination()
    )
    return spark.read.schema(stream.schema).parquet(path)
