"""Sessions on arbitrary state with timers: only closed sessions are given out, open ones are state."""

from __future__ import annotations

from collections.abc import Collection, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from agoralens.functions.calendar import event_time

OPEN = "first_us array<long>, last_us array<long>, n_events array<long>"
CLOSED = "key string, first_us long, last_us long, n_events long"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocks_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, on disk and with changes only per batch."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before is not None else spark.conf.unset(PROVIDER)


class Sessions(StatefulProcessor):
    """Open sessions of one key as one value, and one event-time timer per key, which fires when the
    watermark is past the last row of the session that ends first by the gap. It gives out all sessions
    that are over by then and is set again for the next one, so a key of very many open sessions costs
    one timer and not one each per batch."""

    def __init__(self, gap_us: int) -> None:
        self.gap_us = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", OPEN)

    def _end_ms(self, last_us: int) -> int:
        return (last_us + self.gap_us) // 1_000 + 1

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        known = self._open()
        pieces = known + [(r["first_us"], r["last_us"], r["n_events"]) for r in rows]
        merged: list[list[int]] = []
        for first, last, n in sorted(pieces):
            if merged and first - merged[-1][1] <= self.gap_us:
                merged[-1][1] = max(merged[-1][1], last)
                merged[-1][2] += n
            else:
                merged.append([first, last, n])
        now = timerValues.getCurrentWatermarkInMs()
        yield from self._rows(key, self._close(known, merged, now))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        known = self._open()
        due = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        yield from self._rows(key, self._close(known, known, due, {expiredTimerInfo.getExpiryTimeInMs()}))

    def _open(self) -> list[tuple]:
        known = self.open.get()
        return list(zip(*known)) if known else []

    def _close(self, known: list, pieces: list, now: int, fired: Collection[int] = frozenset()) -> list:
        """Keep those pieces that are still open, with the timer for the first of them to end."""
        still = [tuple(p) for p in pieces if self._end_ms(p[1]) > now]
        before, first = ({min(self._end_ms(p[1]) for p in some)} if some else set() for some in (known, still))
        for end in before - first - set(fired):
            self.handle.deleteTimer(end)
        for end in first - before:
            self.handle.registerTimer(end)
        if still != known:
            self._keep(still)
        return [p for p in pieces if self._end_ms(p[1]) <= now]

    def _keep(self, pieces: list[tuple]) -> None:
        self.open.update(tuple(map(list, zip(*pieces)))) if pieces else self.open.clear()

    @staticmethod
    def _rows(key, pieces: list) -> Iterator[Row]:
        for first, last, n in pieces:
            yield Row(key=key[0], first_us=first, last_us=last, n_events=n)

    def close(self) -> None:
        pass


def timed_sessions(stream: DataFrame, ts: str, key: str, gap_seconds: int, *, delay: str = "10 minutes") -> DataFrame:
    """Every session once, when it is closed (append mode): `key`, `first_us`, `last_us`, `n_events`.

    Rows at most the gap apart belong to one session; it is closed when the watermark is past its last
    row by the gap. Rows are added up per key and gap-long slot inside each Arrow batch before they are
    shuffled, as rows of one slot are always one session, so a key with very many rows sends few. Rows
    without a time belong to none. Start the stream within `rocks_state`; what is still open is in the
    state (see `open_sessions`).
    """
    gap_us = gap_seconds * 1_000_000

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[batch["us"].notna()]
            if len(batch):
                slots = batch.groupby(["key", batch["us"] // gap_us], dropna=False)["us"]
                yield slots.agg(first_us="min", last_us="max", n_events="size").reset_index("key")

    slim = stream.select(F.col(key).cast("string").alias("key"), F.unix_micros(event_time(ts)).alias("us"))
    rows = slim.where("us IS NOT NULL").mapInPandas(add_up, CLOSED)
    # A row's time is its slot's latest, so nothing within the delay is dropped.
    rows = rows.withColumn("ts", F.timestamp_micros("last_us")).withWatermark("ts", delay)
    return rows.groupBy("key").transformWithState(
        statefulProcessor=Sessions(gap_us), outputStructType=CLOSED, outputMode="Append", timeMode="EventTime"
    )


def open_sessions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Sessions that a stopped stream of `timed_sessions` still holds open, read from its state."""
    state = spark.read.format("statestore").option("stateVarName", "open").load(checkpoint)
    pieces = F.arrays_zip(*[F.col("value")[c].alias(c) for c in ("first_us", "last_us", "n_events")])
    return state.select(F.col("key")["key"].alias("key"), F.inline(pieces))
