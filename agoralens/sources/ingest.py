"""First job of a run: cut a dump down to the communities and columns of interest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def select_available(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Keep the wanted columns this table has, in the wanted order."""
    return df.select(*[name for name in wanted if name in df.columns])


def epoch_date(seconds: str | Column) -> Column:
    """Calendar date (session time zone) of an epoch-seconds column."""
    column = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.to_date(F.timestamp_seconds(column))


def filter_and_project(
    df: DataFrame,
    communities: Sequence[str],
    columns: Sequence[str],
    *,
    community_col: str = "subreddit",
    created_col: str = "created_utc",
) -> DataFrame:
    """Rows of the given communities, available columns only, plus their calendar `date`."""
    kept = select_available(df.where(F.col(community_col).isin(*communities)), columns)
    if created_col in kept.columns:
        kept = kept.withColumn("date", epoch_date(created_col))
    return kept
