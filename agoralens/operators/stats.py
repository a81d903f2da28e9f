"""Table-level statistics: summaries, quality counts, correlations, histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from agoralens.functions.calendar import year_month
from agoralens.functions.numbers import safe_corr
from agoralens.operators.ordering import quantile_value, quantiles

BYTES_PER_ROW = 200


def stack_rows(df: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn each input row into several: one output row per mapping name -> expression."""
    structs = [F.struct(*[c.alias(name) for name, c in row.items()]) for row in rows]
    return df.select(F.inline(F.array(*structs)))


def dataset_summary(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, size estimate in GiB and date range of each named (table, date column)."""
    parts = [
        df.agg(
            F.lit(name).alias("data_type"),
            F.count("*").alias("total_rows"),
            F.round(F.count("*") * BYTES_PER_ROW / 1024**3, 2).alias("size_gb"),
            F.min(F.to_date(date_col)).alias("date_range_start"),
            F.max(F.to_date(date_col)).alias("date_range_end"),
        )
        for name, (df, date_col) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _side(df: DataFrame, key: str, score: str, date: str, mark: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("community")).agg(
        F.count("*").alias(f"num_{mark}"),
        F.avg(score).alias(f"avg_{mark}"),
        F.min(F.to_date(date)).alias(f"first_{mark}"),
        F.max(F.to_date(date)).alias(f"last_{mark}"),
    )


def community_stats(
    comments: DataFrame,
    posts: DataFrame,
    *,
    community: str = "community",
    score: str = "score",
    date: str = "created",
) -> DataFrame:
    """Per community: comment and post counts, the score mean over both, the joint date range.

    A community found in one table only counts 0 in the other and keeps its own date range.
    """
    c = _side(comments, community, score, date, "comments")
    p = _side(posts, community, score, date, "submissions")
    both = c.join(p, "community", "full_outer").fillna(0)
    total = F.col("num_comments") + F.col("num_submissions")
    weighted = (
        F.col("avg_comments") * F.col("num_comments")
        + F.col("avg_submissions") * F.col("num_submissions")
    )
    return both.select(
        "community",
        "num_comments",
        "num_submissions",
        total.alias("total_rows"),
        F.when(total > 0, weighted / total).otherwise(F.lit(0.0)).alias("avg_score"),
        F.concat_ws(
            " ~ ",
            F.least("first_comments", "first_submissions"),
            F.greatest("last_comments", "last_submissions"),
        ).alias("date_range"),
    )


def monthly_volume(
    comments: DataFrame, posts: DataFrame, *, date: str = "created", pad: bool = False
) -> DataFrame:
    """Comments and posts per calendar month; `pad` writes 2023-06 for 2023-6."""
    def count(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(year_month(date, pad).alias("year_month")).agg(F.count("*").alias(name))

    both = count(comments, "num_comments").join(
        count(posts, "num_submissions"), "year_month", "full_outer"
    )
    return both.fillna(0).withColumn("total_rows", F.col("num_comments") + F.col("num_submissions"))


def text_quality(
    df: DataFrame, column: str, *, name: str, min_length: int = 3, max_length: int = 5000
) -> DataFrame:
    """One row: how many texts are missing, shorter than the minimum, longer than the maximum."""
    length = F.length(column)
    return df.agg(
        F.lit(name).alias("data_type"),
        F.count_if(F.col(column).isNull()).alias("missing_text"),
        F.count_if(length < min_length).alias("too_short"),
        F.count_if(length > max_length).alias("too_long"),
    )


def describe_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample standard deviation, min and max of each column, one row per column."""
    wide = df.agg(
        *[
            f(c).alias(f"{c}_{stat}")
            for c in columns
            for stat, f in (
                ("count", F.count), ("mean", F.avg), ("stddev", F.stddev_samp),
                ("min", F.min), ("max", F.max),
            )
        ]
    )
    return stack_rows(
        wide,
        [
            {
                "column_name": F.lit(c),
                "count": F.col(f"{c}_count"),
                **{s: F.col(f"{c}_{s}").cast("double") for s in ("mean", "stddev", "min", "max")},
            }
            for c in columns
        ],
    )


def summary_long(df: DataFrame, column: str) -> DataFrame:
    """`describe_long` of one column with its exact quartiles."""
    base = describe_long(df, [column])
    marks = quantiles(df, column, [0.25, 0.5, 0.75]).agg(
        F.struct(
            *[
                F.max(F.when(F.col("probability") == p, F.col("value"))).alias(name)
                for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
            ]
        ).alias("marks")
    )
    # One row on each side; a scalar subquery puts them next to each other.
    return base.withColumn("_marks", marks.scalar()).select(*base.columns, "_marks.*")


def corr_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson correlation of column pairs in long form, all in one pass."""
    wide = df.agg(*[safe_corr(x, y).alias(f"corr_{i}") for i, (x, y) in enumerate(pairs)])
    return stack_rows(
        wide,
        [
            {"var_x": F.lit(x), "var_y": F.lit(y), "pearson_corr": F.col(f"corr_{i}")}
            for i, (x, y) in enumerate(pairs)
        ],
    )


def feature_target_table(df: DataFrame, features: Mapping[str, str], target: str) -> DataFrame:
    """Mean, sample standard deviation and correlation with the target per feature, in one pass.

    `features` maps a column to the label it is shown under.
    """
    wide = df.agg(
        *[
            c.alias(f"{name}_{stat}")
            for name in features
            for stat, c in (
                ("mean", F.avg(name)),
                ("std", F.stddev_samp(name)),
                ("corr", safe_corr(name, target)),
            )
        ]
    )
    return stack_rows(
        wide,
        [
            {
                "feature": F.lit(label),
                "mean": F.col(f"{name}_mean"),
                "std": F.col(f"{name}_std"),
                f"corr_with_{target}": F.col(f"{name}_corr"),
            }
            for name, label in features.items()
        ],
    )


def clip_at_quantile(
    df: DataFrame, limits: Mapping[str, float], *, cap: Mapping[str, float] | None = None
) -> DataFrame:
    """Rows at or below the given exact quantile of each column, and below fixed caps if any."""
    kept = df
    for column, p in limits.items():
        kept = kept.where(F.col(column) <= quantile_value(df, column, p))
    for column, top in (cap or {}).items():
        kept = kept.where(F.col(column) <= top)
    return kept


def histogram(
    df: DataFrame, column: str, bins: int, *, by: str | None = None, group: str | None = None
) -> DataFrame:
    """Counts in equal-width bins between the column's smallest and largest value.

    The last bin includes the maximum. `by` splits the counts by another column.
    """
    seen = df.where(F.col(column).isNotNull())
    ends = F.struct(F.min(column).cast("double").alias("low"), F.max(column).cast("double").alias("high"))
    edges = seen.agg(ends.alias("edges")).scalar()
    low, width = edges["low"], (edges["high"] - edges["low"]) / F.lit(bins)
    place = F.floor(F.try_divide(F.col(column).cast("double") - low, width)).cast("int")
    place = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.coalesce(place, F.lit(0))))
    keys = [place.alias("bin")] + ([F.col(by)] if by else [])
    counted = seen.groupBy(*keys).agg(F.count("*").alias("n"))
    return counted.select(
        *([by] if by else []),
        "bin",
        (low + F.col("bin") * width).alias("bin_start"),
        (low + (F.col("bin") + 1) * width).alias("bin_end"),
        "n",
    )


def binned_mean(df: DataFrame, x: str, y: str, width: float) -> DataFrame:
    """Means of x and y over fixed-width bins of x, the trend line under a scatter plot."""
    place = F.floor(F.col(x) / F.lit(width)).cast("long")
    return df.groupBy(place.alias("bin")).agg(
        F.count("*").alias("n"), F.avg(x).alias("x_avg"), F.avg(y).alias("y_avg")
    )


def unique_counts(df: DataFrame, columns: Mapping[str, str], *, approximate: bool = False) -> DataFrame:
    """One row with the number of distinct values of each column (`columns`: column -> name).

    Exact counts read and de-duplicate one column at a time, so rows are not multiplied by the
    number of columns; `approximate` uses one pass of mergeable sketches.
    """
    if approximate:
        return df.agg(*[F.approx_count_distinct(c).alias(n) for c, n in columns.items()])
    parts = [
        df.select(c).agg(F.lit(n).alias("name"), F.count_distinct(c).alias("n"))
        for c, n in columns.items()
    ]
    both = reduce(DataFrame.unionByName, parts)
    return both.agg(
        *[F.max(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in columns.values()]
    )


def top_groups(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The k most frequent values of a column; equal counts in key order."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(key)).limit(k)
