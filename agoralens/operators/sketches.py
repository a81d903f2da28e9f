"""Mergeable sketches: stored once per day, united over any period without reading rows again.

Theta sketches count distinct values and can be united and intersected; KLL sketches give quantiles. A
day's sketch is a few kilobytes whatever the day holds, so months and quarters are made from one small
row per day. What each estimate may be off is stated as a function of the sketch's size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from agoralens.operators.lookups import lookup_join

#: 2**THETA_BITS values are kept per theta sketch.
THETA_BITS = 12
#: Size of KLL sketches: larger is finer.
KLL_SIZE = 400
#: Standard errors that a stated bound allows: one estimate in 15,000 lies beyond.
SIGMAS = 4.0


# ---- distinct values -------------------------------------------------------------------------

def people_sketches(
    df: DataFrame, person: str, created: str = "created", by: Sequence[str] = (), bits: int = THETA_BITS
) -> DataFrame:
    """One row per day and `by`: `date`, `n` rows and the theta sketch `people` of distinct `person`s.
    NULL persons are not counted; rows without a time are left out."""
    return (
        df.where(F.col(created).isNotNull())
        .groupBy(F.to_date(created).alias("date"), *by)
        .agg(F.count("*").alias("n"), F.theta_sketch_agg(person, bits).alias("people"))
    )


def people_over(sketches: DataFrame, period: Column, by: Sequence[str] = (), bits: int = THETA_BITS) -> DataFrame:
    """Unite daily sketches: one row per `period` and `by` with `n` and the sketch `people`."""
    return sketches.groupBy(period.alias("period"), *by).agg(F.sum("n").alias("n"), F.theta_union_agg("people", bits).alias("people"))


def estimated(people: str | Column) -> Column:
    """The estimated number of distinct values of a theta sketch."""
    return F.theta_sketch_estimate(people)


def theta_error(bits: int = THETA_BITS) -> float:
    """Largest relative error of one sketch's or a union's estimate at `SIGMAS` standard errors; below
    2**bits distinct values estimates are exact."""
    return SIGMAS / (2**bits - 1) ** 0.5


def active_in_both(united: DataFrame, by: str, first: object, second: object) -> DataFrame:
    """People in both of two groups per period, from united sketches: `period`, the estimates `first`,
    `second`, `either` and `both`.

    The error of an intersection is relative to the union: at most `theta_error` times the root of
    `both` times `either`.
    """
    def side(value, name):
        return united.where(F.col(by) == value).select("period", F.col("people").alias(name))

    joined = side(first, "_first").join(side(second, "_second"), "period", "full")
    met = F.when(F.col("_first").isNotNull() & F.col("_second").isNotNull(), F.theta_sketch_estimate(F.theta_intersection("_first", "_second")))
    either = F.theta_sketch_estimate(F.when(F.col("_first").isNull(), F.col("_second")).when(F.col("_second").isNull(), F.col("_first")).otherwise(F.theta_union("_first", "_second")))
    zero = F.lit(0).cast("long")
    return joined.select(
        "period",
        F.coalesce(F.theta_sketch_estimate("_first"), zero).alias("first"),
        F.coalesce(F.theta_sketch_estimate("_second"), zero).alias("second"),
        either.alias("either"), F.coalesce(met, zero).alias("both"),
    )


# ---- quantiles -------------------------------------------------------------------------------

def value_sketches(df: DataFrame, column: str, created: str = "created", by: Sequence[str] = (), size: int = KLL_SIZE) -> DataFrame:
    """One row per day and `by`: `date`, `n` values and their KLL sketch `values`. NULLs are left out."""
    value = F.col(column).cast("double")
    rows = df.where(F.col(created).isNotNull() & value.isNotNull())
    return rows.groupBy(F.to_date(created).alias("date"), *by).agg(F.count("*").alias("n"), F.kll_sketch_agg_double(value, size).alias("values"))


def values_over(sketches: DataFrame, period: Column, by: Sequence[str] = (), size: int = KLL_SIZE) -> DataFrame:
    """Merge daily sketches: one row per `period` and `by` with `n` and the sketch `values`."""
    return sketches.groupBy(period.alias("period"), *by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("values", size).alias("values"))


def sketched_quantiles(merged: DataFrame, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """`period`, `by`, `n`, `probability` and `value`, one row per probability."""
    found = [
        F.struct(F.lit(float(p)).alias("probability"), F.kll_sketch_get_quantile_double("values", F.lit(float(p))).alias("value"))
        for p in probabilities
    ]
    return merged.select("period", *by, "n", F.inline(F.array(*found)))


def kll_error(size: int = KLL_SIZE) -> float:
    """Largest rank error of a quantile, as a share of all values. The published error of KLL at 99 %
    confidence (2.6 standard errors) is 2.296 / size**0.9021; this is at `SIGMAS` of them."""
    return 2.296 / size**0.9021 * SIGMAS / 2.576


def rank_errors(df: DataFrame, column: str, period: Column, quantiles: DataFrame) -> DataFrame:
    """How far the true ranks of sketched quantiles are from their probabilities.

    Adds `rank_error` to `quantiles` (one row per period and probability): 0 if the probability lies
    between the shares of values below and up to the sketched one, else the distance to the nearer end.
    The rows are read once; quantiles go along as an array per period.
    """
    per_period = quantiles.groupBy("period").agg(F.sort_array(F.collect_list(F.struct("probability", "value"))).alias("_asked"))
    rows = df.where(F.col(column).isNotNull()).select(period.alias("period"), F.col(column).cast("double").alias("_value"))
    # Equal values are one row, and each period's few quantiles are looked up.
    counted = lookup_join(rows.groupBy("period", "_value").agg(F.count("*").alias("_n")), per_period, ["period"])
    asked = counted.select("period", "_value", "_n", F.explode("_asked").alias("_q")).select("period", "_value", "_n", "_q.*")
    found = asked.groupBy("period", "probability", "value").agg(
        F.sum("_n").alias("_all"),
        F.sum(F.when(F.col("_value") < F.col("value"), F.col("_n")).otherwise(0)).alias("_below"),
        F.sum(F.when(F.col("_value") <= F.col("value"), F.col("_n")).otherwise(0)).alias("_upto"),
    )
    low, high, p = F.col("_below") / F.col("_all"), F.col("_upto") / F.col("_all"), F.col("probability")
    error = F.greatest(low - p, p - high, F.lit(0.0))
    return found.select("period", "probability", "value", F.col("_all").alias("n"), error.alias("rank_error"))
