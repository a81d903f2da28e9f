"""Activity over calendar time."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def add_time_keys(df: DataFrame, created: str = "created") -> DataFrame:
    """hour, month, weekday number (Sunday 1) and weekday label of a timestamp."""
    return df.withColumns(
        {
            "hour": F.hour(created),
            "month": F.month(created),
            "weekday_num": F.dayofweek(created),
            "weekday": F.date_format(created, "E"),
        }
    )


def month_counts(posts: DataFrame, created: str = "created") -> DataFrame:
    """Posts per month of the year; the same month of different years counts together."""
    return (
        posts.groupBy(F.month(created).alias("month"))
        .agg(F.count("*").alias("post_count"))
        .orderBy("month")
    )


def hour_counts(df: DataFrame, created: str = "created") -> DataFrame:
    """Rows per hour of the day, busiest first."""
    counts = df.groupBy(F.hour(created).alias("hour_of_day")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "hour_of_day")


def weekday_hour_counts(df: DataFrame, created: str = "created") -> DataFrame:
    return (
        df.groupBy(
            F.dayofweek(created).alias("day_of_week"), F.hour(created).alias("hour_of_day")
        )
        .agg(F.count("*").alias("post_count"))
        .orderBy("day_of_week", "hour_of_day")
    )


def heatmap_matrix(df: DataFrame, created: str = "created") -> DataFrame:
    """Weekday rows by 24 hour columns `h0`..`h23`; an empty cell is 0."""
    hour = F.hour(created)
    cells = [F.count_if(hour == h).alias(f"h{h}") for h in range(24)]
    return df.groupBy(F.dayofweek(created).alias("day_of_week")).agg(*cells).orderBy("day_of_week")


def weekday_summary(posts: DataFrame, comments: DataFrame, created: str = "created") -> DataFrame:
    """Total posts and comments per weekday; a weekday missing on one side is NULL there."""
    def count(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.dayofweek(created).alias("day_of_week")).agg(F.count("*").alias(name))

    both = count(posts, "n_posts").join(count(comments, "n_comments"), "day_of_week", "full_outer")
    return both.orderBy("day_of_week")


def activity_by_kind(tables: Mapping[str, DataFrame], created: str = "created") -> DataFrame:
    """Weekday x hour counts of several tables on top of each other, tagged by `kind`."""
    parts = [
        df.select(F.lit(kind).alias("kind"), F.col(created).alias("created"))
        for kind, df in tables.items()
    ]
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy(
            "kind",
            F.dayofweek("created").alias("day_of_week"),
            F.hour("created").alias("hour_of_day"),
        )
        .agg(F.count("*").alias("n"))
    )


def in_year(df: DataFrame, created: str, year: int) -> DataFrame:
    """Rows of one calendar year, as a range on the raw column so the scan can skip files."""
    kind = df.schema[created].dataType.simpleString()
    start, end = (F.lit(f"{y}-01-01").cast(kind) for y in (year, year + 1))
    return df.where((F.col(created) >= start) & (F.col(created) < end))


def daily_kpis(
    df: DataFrame,
    created: str,
    *,
    count: str = "num_rows",
    mean: str,
    top: str,
    high: str,
    low: str,
    ceiling: str,
    accuracy: int = 10_000,
) -> DataFrame:
    """Per day, newest first: rows, mean, maximum, 95th percentile, minimum, rounded-up mean.

    The percentile is a mergeable sketch, so a busy day needs no sort and no full group in memory.
    """
    days = df.groupBy(
        F.year(created).alias("dt_year"),
        F.month(created).alias("dt_month"),
        F.dayofmonth(created).alias("dt_day"),
    )
    return days.agg(
        F.count("*").alias(count),
        F.avg(mean).alias(f"mean_{mean}"),
        F.max(top).alias(f"max_{top}"),
        F.percentile_approx(high, 0.95, accuracy).alias(f"q95_{high}"),
        F.min(low).alias(f"min_{low}"),
        F.ceil(F.avg(ceiling)).alias(f"mean_{ceiling}"),
    ).orderBy(F.desc("dt_year"), F.desc("dt_month"), F.desc("dt_day"))


def run_totals(daily: DataFrame, count: str = "num_rows") -> DataFrame:
    """One row over a daily table: days, rows, mean rows a day, first and last day."""
    day: Column = F.make_date("dt_year", "dt_month", "dt_day")
    return daily.agg(
        F.count("*").alias("days"),
        F.sum(count).alias("total"),
        F.avg(count).alias("mean_per_day"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
    )
