"""Ordered work per key that stays safe when one key holds a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def micros(ts: str | Column) -> Column:
    """Timestamp as a count of microseconds."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(ts.cast("timestamp"))


def sessions(
    df: DataFrame, keys: Sequence[str], ts: str, gap_seconds: float
) -> DataFrame:
    """One row per session of a key: rows at most the gap apart belong together.

    Rows are first added up per gap-long slot; rows in one slot are always one session. So the
    ordered step sees at most one row per key and slot, whatever the number of rows of a key.
    `session_end` is the last row's time plus the gap.
    """
    gap = int(gap_seconds * 1_000_000)
    slots = (
        df.select(*keys, micros(ts).alias("_t"))
        .groupBy(*keys, F.floor(F.col("_t") / F.lit(gap)).alias("_slot"))
        .agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"), F.count("*").alias("_n"))
    )
    order = W.partitionBy(*keys).orderBy("_slot")
    before = F.lag("_last").over(order)
    opens = F.coalesce((F.col("_first") - before > gap).cast("int"), F.lit(1))
    numbered = slots.withColumn("_opens", opens).withColumn(
        "_session", F.sum("_opens").over(order.rowsBetween(W.unboundedPreceding, 0))
    )
    first, last = F.min("_first"), F.max("_last")
    return numbered.groupBy(*keys, "_session").agg(
        F.timestamp_micros(first).alias("session_start"),
        F.timestamp_micros(last + gap).alias("session_end"),
        ((last + gap - first) / F.lit(1_000_000.0)).alias("duration_seconds"),
        F.sum("_n").alias("n_events"),
    ).drop("_session")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    ts: str,
    values: Sequence[str],
    slot_seconds: int = 3600,
) -> DataFrame:
    """Left rows with the `values` of the latest right row of the key at or before their time.

    Time is cut into slots. Inside a (key, slot) the latest right row is carried forward; across
    slots only one row per key and slot is carried. A key's rows are thus split by time, and the
    ordered step per key sees slots, not rows. Several right rows at one time: the greatest values
    win.
    """
    slot = F.floor(micros(ts) / F.lit(slot_seconds * 1_000_000)).alias("_slot")
    payload = F.struct(micros(ts).alias("_at"), *[F.col(v) for v in values])
    best = right.groupBy(*keys, ts).agg(F.max(payload).alias("_right"))

    last_in_slot = best.groupBy(*keys, slot).agg(F.max("_right").alias("_right"))
    rest = [c for c in left.columns if c not in keys and c != ts]
    rows = left.select(*keys, slot, F.col(ts), F.struct(*rest, F.lit(1).alias("_row")).alias("_left"))
    marks = best.select(*keys, slot, F.col(ts), "_right")
    both = rows.unionByName(marks, allowMissingColumns=True)

    # Right rows sort before left rows of the same time.
    inside = (
        W.partitionBy(*keys, "_slot")
        .orderBy(F.col(ts), F.col("_left").isNotNull())
        .rowsBetween(W.unboundedPreceding, 0)
    )
    here = both.withColumn("_here", F.last("_right", ignorenulls=True).over(inside))
    here = here.where(F.col("_left").isNotNull())

    # What each (key, slot) inherits from earlier slots of the key.
    wanted = rows.select(*keys, "_slot").distinct()
    slots = wanted.join(last_in_slot, [*keys, "_slot"], "full_outer")
    earlier = W.partitionBy(*keys).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    carried = slots.select(
        *keys, "_slot", F.last("_right", ignorenulls=True).over(earlier).alias("_carried")
    )
    found = here.join(carried, [*keys, "_slot"], "left")
    match = F.coalesce("_here", "_carried")
    return found.select(
        *keys,
        ts,
        *[F.col("_left")[c].alias(c) for c in rest],
        *[match[v].alias(v) for v in values],
    )
