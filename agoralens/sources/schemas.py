"""Logical table contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


SUBMISSIONS = _table(
    ("id", T.StringType()),
    ("subreddit", T.StringType()),
    ("author", T.StringType()),
    ("title", T.StringType()),
    ("selftext", T.StringType()),
    ("url", T.StringType()),
    ("score", T.IntegerType()),
    ("num_comments", T.IntegerType()),
    ("created_utc", T.LongType()),
    ("over_18", T.BooleanType()),
)

COMMENTS = _table(
    ("id", T.StringType()),
    ("subreddit", T.StringType()),
    ("author", T.StringType()),
    ("body", T.StringType()),
    ("parent_id", T.StringType()),
    ("link_id", T.StringType()),
    ("score", T.IntegerType()),
    ("controversiality", T.IntegerType()),
    ("gilded", T.IntegerType()),
    ("created_utc", T.LongType()),
)

LEXICON = _table(
    ("word", T.StringType()),
    ("emotion", T.StringType()),
    ("value", T.StringType()),
)

TRIPS = _table(
    ("tpep_pickup_datetime", T.TimestampType()),
    ("trip_distance", T.DoubleType()),
    ("mta_tax", T.DoubleType()),
    ("fare_amount", T.DoubleType()),
    ("tip_amount", T.DoubleType()),
    ("passenger_count", T.DoubleType()),
)


def require_columns(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Return `df` unchanged, or raise naming every contract column it lacks."""
    missing = [name for name in contract.names if name not in df.columns]
    if missing:
        raise ValueError(f"table lacks columns {missing}; it has {df.columns}")
    return df


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Project to the contract's columns and types.

    Text that does not parse as the wanted type becomes NULL instead of failing the job;
    `unparsed` counts such values.
    """
    require_columns(df, contract)
    return df.select(*[df[f.name].try_cast(f.dataType).alias(f.name) for f in contract.fields])


def unparsed(df: DataFrame, contract: T.StructType) -> DataFrame:
    """One row: for each contract column, how many values `conform` turns into NULL."""
    require_columns(df, contract)
    lost = [df[f.name].isNotNull() & df[f.name].try_cast(f.dataType).isNull() for f in contract.fields]
    return df.agg(*[F.count_if(c).alias(f.name) for c, f in zip(lost, contract.fields)])
