"""Run streams over the files that are there now, restartable from a checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from agoralens.sources.scratch import new_folder


def append_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is available in append mode into a Parquet table, exactly once."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def for_each_batch(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str
) -> None:
    """Process what is available, handing each batch to `write(batch, batch_id)`.

    After a failure a batch may come again with the same id, so `write` must overwrite by id.
    """
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest(changes: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The last version of every row of an update-mode result (see `to_table`): what append mode
    has given out so far, and what it would still hold back at the end of the input."""
    newest = [F.max_by(v, "batch_id").alias(v) for v in values]
    return changes.groupBy(*keys).agg(*newest)


def to_table(stream: DataFrame, mode: str = "append", name: str = "stream") -> DataFrame:
    """Run to the end of the available input and return the result table from shared storage.

    "append" gives the rows given out, "complete" the last full result, "update" every changed row
    with its `batch_id`.
    """
    spark = stream.sparkSession
    folder = new_folder(spark, name)
    path, checkpoint = f"{folder}/table", f"{folder}/checkpoint"
    if mode == "append":
        append_to_table(stream, path, checkpoint)
        return spark.read.schema(stream.schema).parquet(path)
    if mode == "complete":
        last: list[int] = []

        def replace(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            last[:] = [batch_id]

        for_each_batch(stream, replace, checkpoint, mode)
        if not last:
            return spark.createDataFrame([], stream.schema)
        return spark.read.schema(stream.schema).parquet(f"{path}/batch_id={last[0]}")
    if mode == "update":

        def put(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

        for_each_batch(stream, put, checkpoint, mode)
        return spark.read.parquet(path)
    raise ValueError("mode must be 'append', 'complete' or 'update'")
