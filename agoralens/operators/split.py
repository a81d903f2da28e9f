"""Repeatable samples and train/test splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from agoralens.functions.keys import md5_bucket
from agoralens.operators.ordering import running_totals, value_counts

FINE = 10_000


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """About `fraction` of the rows, chosen by key: the same rows in every run and layout."""
    return df.where(md5_bucket(key, FINE, f"s{seed}") < round(fraction * FINE))


def assign_split(df: DataFrame, key: str, train: float = 0.8, seed: int = 42) -> DataFrame:
    """Add `split`: "train" or "test" by key."""
    inside = md5_bucket(key, FINE, f"s{seed}") < round(train * FINE)
    return df.withColumn("split", F.when(inside, "train").otherwise("test"))


def hash_split(
    df: DataFrame, key: str, train: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    tagged = assign_split(df, key, train, seed)
    return tuple(tagged.where(F.col("split") == s).drop("split") for s in ("train", "test"))


def assign_fold(df: DataFrame, key: str, folds: int = 3, seed: int = 42) -> DataFrame:
    """Add `fold` 0..folds-1 by key, for cross-validation that does not depend on file layout."""
    return df.withColumn("fold", md5_bucket(key, folds, f"f{seed}"))


def chronological_split(
    df: DataFrame, order: str = "date", train: float = 0.7, validation: float = 0.15
) -> DataFrame:
    """Add `split` ("train", "validation", "test") by position in time.

    `order` must be unique and not NULL. Positions come from distributed running totals.
    """
    run = running_totals(value_counts(df, order), "value", ["n"])
    place, total = F.col("before_n") + 1, F.col("total_n")
    train_end = F.floor(total * F.lit(train))
    validation_end = F.floor(total * F.lit(train + validation))
    label = (
        F.when(place <= train_end, "train")
        .when(place <= validation_end, "validation")
        .otherwise("test")
    )
    return df.join(run.select(F.col("value").alias(order), label.alias("split")), order)
