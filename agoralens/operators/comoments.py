"""Means, deviations and correlations that can be merged: one pass per day, any period from the days.

A day holds its number of rows, means and sums of products about its own means. Two of them merge by
adding the sums and a term for the distance of their means. Nothing large is subtracted from anything
large, so results keep their digits where sums of raw products lose them, however far from zero values
lie. Periods read one small row per day and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

MOMENTS = ("n", "mean_x", "mean_y", "xx", "yy", "xy")


def day_moments(df: DataFrame, x: str, y: str, created: str = "created", by: Sequence[str] = ()) -> DataFrame:
    """One row per day and `by`: `date` and the moments of the rows that have both values."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    rows = df.where(F.col(created).isNotNull() & a.isNotNull() & b.isNotNull())
    n = F.count("*")
    return rows.groupBy(F.to_date(created).alias("date"), *by).agg(
        n.alias("n"), F.avg(a).alias("mean_x"), F.avg(b).alias("mean_y"),
        (F.var_pop(a) * n).alias("xx"), (F.var_pop(b) * n).alias("yy"), (F.covar_pop(a, b) * n).alias("xy"),
    )


def _merged(days: Column) -> Column:
    """Fold an array of moments, in its order."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), *[F.lit(0.0).alias(c) for c in MOMENTS[1:]])

    def add(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        dx, dy = b["mean_x"] - a["mean_x"], b["mean_y"] - a["mean_y"]
        share, both = b["n"] / n, a["n"] * (b["n"] / n)
        return F.struct(
            n.alias("n"), (a["mean_x"] + dx * share).alias("mean_x"), (a["mean_y"] + dy * share).alias("mean_y"),
            (a["xx"] + b["xx"] + dx * dx * both).alias("xx"), (a["yy"] + b["yy"] + dy * dy * both).alias("yy"),
            (a["xy"] + b["xy"] + dx * dy * both).alias("xy"),
        )

    return F.aggregate(days, zero, add)


def over_periods(days: DataFrame, period: Column, by: Sequence[str] = ()) -> DataFrame:
    """Moments per `period` and `by`. A group holds one row per day."""
    listed = F.sort_array(F.collect_list(F.struct("date", *MOMENTS)))
    return days.groupBy(period.alias("period"), *by).agg(_merged(listed).alias("_m")).select("period", *by, "_m.*")


def rolling(days: DataFrame, length: int, by: Sequence[str] = ()) -> DataFrame:
    """Moments of the last `length` calendar days, for every day that has rows."""
    since = F.datediff("date", F.lit("1970-01-01").cast("date"))
    frame = W.partitionBy(*by).orderBy(since).rangeBetween(1 - length, 0)
    listed = F.sort_array(F.collect_list(F.struct("date", *MOMENTS)).over(frame))
    return days.select("date", *by, _merged(listed).alias("_m")).select("date", *by, "_m.*")


def described(moments: DataFrame) -> DataFrame:
    """Replace sums by figures: `n`, means, sample deviations (`std_x`, `std_y`; NULL for one row) and `corr`
    (NULL where a side does not vary)."""
    others = [c for c in moments.columns if c not in MOMENTS]
    free = F.nullif(F.col("n") - 1, F.lit(0))
    return moments.select(
        *others, "n", "mean_x", "mean_y", F.sqrt(F.col("xx") / free).alias("std_x"), F.sqrt(F.col("yy") / free).alias("std_y"),
        F.try_divide(F.col("xy"), F.sqrt(F.col("xx")) * F.sqrt(F.col("yy"))).alias("corr"),
    )
