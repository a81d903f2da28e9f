"""Tables that streams keep up to date: keyed rows, and rows that came too late."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralens.functions.calendar import event_time
from agoralens.sources.scratch import drop
from agoralens.streaming.run import for_each_batch


class Stopped(Exception):
    """A stream was told to stop before this batch."""


def _batches(spark: SparkSession, folder: str) -> list[int]:
    """Ids of the batches that are whole in a folder, in order."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    found = []
    for status in files.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("batch=") and files.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found.append(int(name.removeprefix("batch=")))
    return sorted(found)


class KeyedTable:
    """The last version of every key of a stream's changes.

    A batch is written under its id, so one that comes again after a failure replaces itself. Every
    `compact_every` batches, all there is becomes one snapshot and what went into it is deleted, so that
    reading costs the keys and the last few batches, not every version ever written. A crash between the
    two leaves batches that the snapshot holds already; they are older than it and not read.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], compact_every: int = 10) -> None:
        self.spark, self.folder, self.keys, self.compact_every = spark, folder.rstrip("/"), list(keys), compact_every

    def _read(self, upto: int | None = None) -> DataFrame | None:
        snapshots = _batches(self.spark, f"{self.folder}/snapshot")
        base = snapshots[-1] if snapshots else -1
        parts = [self.spark.read.parquet(f"{self.folder}/snapshot/batch={base}")] if snapshots else []
        for n in _batches(self.spark, f"{self.folder}/change"):
            if n > base and (upto is None or n <= upto):
                parts.append(self.spark.read.parquet(f"{self.folder}/change/batch={n}").withColumn("_batch", F.lit(n).cast("long")))
        if not parts:
            return None
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        if len(parts) == 1 and snapshots:
            return rows
        values = [c for c in rows.columns if c not in self.keys]
        newest = F.max_by(F.struct(*values), "_batch").alias("_row")
        return rows.groupBy(*self.keys).agg(newest).select(*self.keys, "_row.*")

    def put(self, batch: DataFrame, batch_id: int) -> None:
        snapshots = _batches(self.spark, f"{self.folder}/snapshot")
        if snapshots and batch_id <= snapshots[-1]:
            return  # came again after it was compacted
        batch.write.mode("overwrite").parquet(f"{self.folder}/change/batch={batch_id}")
        changes = [n for n in _batches(self.spark, f"{self.folder}/change") if not snapshots or n > snapshots[-1]]
        if len(changes) >= self.compact_every:
            self.compact(batch_id)

    def compact(self, batch_id: int) -> None:
        self._read(batch_id).write.mode("overwrite").parquet(f"{self.folder}/snapshot/batch={batch_id}")
        old = [f"{self.folder}/snapshot/batch={n}" for n in _batches(self.spark, f"{self.folder}/snapshot") if n < batch_id]
        old += [f"{self.folder}/change/batch={n}" for n in _batches(self.spark, f"{self.folder}/change") if n <= batch_id]
        drop(self.spark, old)

    def rows(self) -> DataFrame | None:
        """All keys with their last values; None before the first batch."""
        found = self._read()
        return None if found is None else found.drop("_batch")


def upsert(
    stream: DataFrame, table: KeyedTable, checkpoint: str, *, stop_before: int | None = None
) -> None:
    """Process what is available in update mode into a keyed table. `stop_before` ends the stream before
    the batch with that id, which a later run from the same checkpoint then starts with."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if stop_before is not None and batch_id >= stop_before:
            raise Stopped
        table.put(batch, batch_id)

    try:
        for_each_batch(stream, write, checkpoint, "update")
    except Exception as error:
        if stop_before is None or "Stopped" not in str(error):
            raise


def split_late(stream: DataFrame, ts: str, folder: str, checkpoint: str, *, delay_seconds: int = 600) -> None:
    """Write rows behind the watermark to `late`, all others to `kept`, and per batch what was seen.

    The watermark of a batch is the latest time of all batches before it, less the delay. (Spark's own
    aggregations drop by the watermark of one batch earlier, so what they drop is late here.) It is kept
    in the folder (`seen`), so a restart goes on with it and a batch that comes again is split in the
    same way. Rows without a time are late.
    """
    spark = stream.sparkSession
    folder = folder.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        before = [n for n in _batches(spark, f"{folder}/seen") if n < batch_id]
        mark = None
        if before:
            seen = spark.read.parquet(*[f"{folder}/seen/batch={n}" for n in before])
            mark = seen.agg(F.max("latest_us")).first()[0]
        us = F.unix_micros(event_time(ts))
        bound = F.lit(None if mark is None else mark - delay_seconds * 1_000_000).cast("long")
        batch.persist()
        late = us.isNull() | F.coalesce(us < bound, F.lit(False))
        batch.where(late).write.mode("overwrite").parquet(f"{folder}/late/batch={batch_id}")
        batch.where(~late).write.mode("overwrite").parquet(f"{folder}/kept/batch={batch_id}")
        counts = batch.agg(
            F.count("*").alias("n"), F.count_if(late).alias("n_late"), F.max(us).alias("latest_us"), F.max(bound).alias("watermark_us")
        )
        # Last, so that a batch with this entry is whole.
        counts.write.mode("overwrite").parquet(f"{folder}/seen/batch={batch_id}")
        batch.unpersist()

    for_each_batch(stream, write, checkpoint, "append")


def late_rows(spark: SparkSession, folder: str, which: str = "late") -> DataFrame | None:
    """The rows of all whole batches: `late`, `kept` or `seen` (counts per batch)."""
    whole = _batches(spark, f"{folder.rstrip('/')}/seen")
    parts = [f"{folder.rstrip('/')}/{which}/batch={n}" for n in whole]
    return spark.read.parquet(*parts) if parts else None
