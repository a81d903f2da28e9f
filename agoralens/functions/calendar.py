"""Calendar columns. Weekdays count from Sunday = 1."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

SATURDAY_AND_SUNDAY = (1, 7)


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def event_time(value: str | Column) -> Column:
    """Zoned timestamp, as watermarks need it, from a zone-less one."""
    return as_column(value).cast("timestamp")


def year_month(value: str | Column, pad: bool = False) -> Column:
    """`2023-6`, or `2023-06` when padded."""
    value = as_column(value)
    if pad:
        return F.date_format(value, "yyyy-MM")
    return F.concat_ws("-", F.year(value), F.month(value))


def is_weekend(weekday: str | Column, weekend: tuple[int, ...] = SATURDAY_AND_SUNDAY) -> Column:
    return F.coalesce(as_column(weekday).isin(*weekend).cast("int"), F.lit(0))


def year_angle(value: str | Column, days: float = 365.0) -> Column:
    """Position in the year as an angle, for sine and cosine season terms."""
    return F.lit(2 * math.pi) * F.dayofyear(as_column(value)) / F.lit(days)
