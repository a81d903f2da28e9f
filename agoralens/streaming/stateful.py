"""Sessions with hand-written state and timeout."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from agoralens.functions.calendar import event_time

OUTPUT = "key string, first_us long, n_events long, last_us long, closed boolean"
STATE = "first_us array<long>, last_us array<long>, n_events array<long>"
PARTIAL = "key string, n_events long, first_us long, last_us long"


def stateful_sessions(
    stream: DataFrame,
    ts: str,
    key: str,
    gap_seconds: int,
    *,
    delay: str = "10 minutes",
    processing_time: bool = False,
) -> DataFrame:
    """Every change of a session (`first_us` is its first row's time), in update mode.

    Rows at most the gap apart belong to one session. State per key is its open sessions in order:
    first and last time and number of rows. A session is closed, and leaves the state, when the
    watermark (or, with `processing_time`, the clock) is past its last row by the gap. Sessions that
    late rows join together stay under the earlier start; the later one comes once more with 0 rows.
    Rows are added up per key and gap-long slot inside each Arrow batch before the shuffle, since
    rows of one slot are always one session: a key with very many rows sends few. Rows without a
    time are not part of any session. Read the end state with `last_versions`.
    """
    gap_ms, gap_us = gap_seconds * 1_000, gap_seconds * 1_000_000

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[batch["us"].notna()]
            if len(batch):
                slots = batch.groupby(["key", batch["us"] // gap_us], dropna=False)["us"]
                yield slots.agg(n_events="size", first_us="min", last_us="max").reset_index("key")

    def step(
        group: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        out: dict[int, tuple[int, int, bool]] = {}
        known = sorted(zip(*state.get)) if state.exists else []
        pieces = list(known)
        if not state.hasTimedOut:
            for batch in batches:
                pieces += zip(batch["first_us"].tolist(), batch["last_us"].tolist(), batch["n_events"].tolist())
        merged: list[list[int]] = []
        for first, last, n in sorted(pieces):
            if merged and first - merged[-1][1] <= gap_us:
                merged[-1][1] = max(merged[-1][1], last)
                merged[-1][2] += n
            else:
                merged.append([first, last, n])
        for first, last, _ in known:
            out[first] = (0, last, True)  # stays only if the session got another start
        now_ms = state.getCurrentProcessingTimeMs() if processing_time else state.getCurrentWatermarkMs()
        still = []
        for first, last, n in merged:
            if processing_time:
                done = state.hasTimedOut
            else:
                done = last // 1_000 + gap_ms < now_ms
            out[first] = (n, last, done)
            if not done:
                still.append((first, last, n))
        if still:
            state.update(tuple(list(column) for column in zip(*still)))
            if processing_time:
                state.setTimeoutDuration(gap_ms)
            else:
                ends = min(last for _, last, _ in still) // 1_000 + gap_ms
                state.setTimeoutTimestamp(max(ends, now_ms) + 1)
        elif state.exists:
            state.remove()
        yield pd.DataFrame(
            {
                "key": [group[0]] * len(out),
                "first_us": list(out),
                "n_events": [n for n, _, _ in out.values()],
                "last_us": [last for _, last, _ in out.values()],
                "closed": [done for _, _, done in out.values()],
            }
        )

    slim = stream.select(F.col(key).cast("string").alias("key"), F.unix_micros(event_time(ts)).alias("us"))
    # A row's time is its slot's latest, so nothing within the delay is dropped.
    rows = slim.where("us IS NOT NULL").mapInPandas(add_up, PARTIAL)
    rows = rows.withColumn("ts", F.timestamp_micros("last_us")).withWatermark("ts", delay)
    timeout = (
        GroupStateTimeout.ProcessingTimeTimeout
        if processing_time
        else GroupStateTimeout.EventTimeTimeout
    )
    return rows.groupBy("key").applyInPandasWithState(step, OUTPUT, STATE, "update", timeout)


def last_versions(changes: DataFrame) -> DataFrame:
    """One row per session, open or closed, of the changes with their `batch_id` (see `to_table`)."""
    newest = changes.groupBy("key", "first_us").agg(
        F.max_by("n_events", "batch_id").alias("n_events"),
        F.max_by("last_us", "batch_id").alias("last_us"),
        F.max_by("closed", "batch_id").alias("closed"),
    )
    return newest.where("n_events > 0")
