"""Vectorised Python where it is the feature, and built-in forms of grouped Python patterns.

Python sees Arrow batches of bounded size here, never a whole group: grouped and cogrouped
patterns are expressed with aggregates, lookups and windows instead (`demean`, and
`sequences.asof_join`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from agoralens.operators.lookups import lookup_join


def map_series(function: Callable[[pd.Series], pd.Series], returns: str) -> Callable[..., Column]:
    """Series-to-series function as a column function."""
    def one(values: pd.Series) -> pd.Series:
        return function(values)

    return F.pandas_udf(one, returns)


def map_series_with_setup(
    setup: Callable[[], Callable[[pd.Series], pd.Series]], returns: str
) -> Callable[..., Column]:
    """As `map_series`, where `setup` runs once per task and gives the function to apply."""
    def many(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        function = setup()
        for batch in batches:
            yield function(batch)

    return F.pandas_udf(many, returns)


def filter_batches(df: DataFrame, keep: Callable[[pd.DataFrame], pd.Series]) -> DataFrame:
    """Rows for which a vectorised predicate holds."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[keep(batch)]

    return df.mapInPandas(run, df.schema)


def demean(df: DataFrame, keys: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    """Value minus its group mean. Means are aggregated and looked up; groups are not gathered."""
    means = df.groupBy(*keys).agg(F.avg(value).alias("_mean"))
    joined = lookup_join(df, means, keys, "left")
    return joined.withColumn(name or value, F.col(value) - F.col("_mean")).drop("_mean")
