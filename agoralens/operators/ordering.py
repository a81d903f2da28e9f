"""Running totals, ranks and exact quantiles over a whole table without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from agoralens.sources.scratch import stored

RANGES = 4096
BLOCK = 64


def value_counts(df: DataFrame, column: str, *sums: Column) -> DataFrame:
    """One row per distinct non-NULL value: `value`, its row count `n` and further sums."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n"), *sums)
    )


def running_totals(
    counted: DataFrame,
    key: str,
    measures: Sequence[str],
    *,
    descending: bool = False,
    ranges: int = RANGES,
) -> DataFrame:
    """Add `before_<m>` (total over keys that come earlier) and `total_<m>` for each measure.

    `counted` has one row per distinct key and is stored first, since it is read several times and
    may be costly to make. Keys are cut into value ranges at up to `ranges - 1` keys picked by
    smallest hash, which is the same pick in every run and on every retry. Each range is then
    sorted on its own, and only the per-range totals (at most `ranges` rows) meet in one task. No
    task sees all keys.
    """
    counted = stored(counted)
    order = F.desc if descending else F.asc
    picks = counted.select(key).orderBy(F.xxhash64(key), key).limit(ranges - 1)
    cuts = picks.agg(F.sort_array(F.collect_list(key)).alias("fine")).select(
        F.struct(
            "fine", F.filter("fine", lambda c, i: i % BLOCK == BLOCK - 1).alias("coarse")
        ).alias("cuts")
    ).scalar()
    # Look among every 64th cut first, and then only inside one block of 64.
    skipped = F.size(F.filter("_cuts.coarse", lambda c: c < F.col(key))) * BLOCK
    block = F.slice("_cuts.fine", F.col("_skipped") + 1, F.lit(BLOCK))
    place = F.col("_skipped") + F.size(F.filter(block, lambda c: c < F.col(key)))
    ranged = (
        counted.withColumn("_cuts", cuts)
        .withColumn("_skipped", skipped)
        .withColumn("_range", F.coalesce(place, F.lit(0)))
        .drop("_cuts", "_skipped")
    )

    sums = ranged.groupBy("_range").agg(*[F.sum(m).alias(f"_sum_{m}") for m in measures])
    earlier = W.orderBy(order("_range")).rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy(order("_range")).rowsBetween(
        W.unboundedPreceding, W.unboundedFollowing
    )
    offsets = sums.select(
        "_range",
        *[F.coalesce(F.sum(f"_sum_{m}").over(earlier), F.lit(0)).alias(f"_off_{m}") for m in measures],
        *[F.sum(f"_sum_{m}").over(everything).alias(f"total_{m}") for m in measures],
    )

    inside = W.partitionBy("_range").orderBy(order(key)).rowsBetween(W.unboundedPreceding, -1)
    return ranged.join(F.broadcast(offsets), "_range").select(
        *counted.columns,
        *[
            (F.coalesce(F.sum(m).over(inside), F.lit(0)) + F.col(f"_off_{m}")).alias(f"before_{m}")
            for m in measures
        ],
        *[f"total_{m}" for m in measures],
    )


def average_ranks(df: DataFrame, column: str) -> DataFrame:
    """`value` and its `rank` among all rows, ties sharing the mean rank."""
    return ranks_of_counts(value_counts(df, column))


def ranks_of_counts(counted: DataFrame) -> DataFrame:
    """`value` and its mean `rank`, from distinct values and their number of rows `n`."""
    run = running_totals(counted, "value", ["n"])
    return run.select("value", (F.col("before_n") + (F.col("n") + 1) / F.lit(2.0)).alias("rank"))


def quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> DataFrame:
    """One row (`probability`, `value`) per probability: exact, linear between neighbours."""
    run = running_totals(value_counts(df, column), "value", ["n"])
    value = F.col("value").cast("double")
    ends: list[Column] = []
    for i, p in enumerate(probabilities):
        place = F.lit(p) * (F.col("total_n") - 1)
        for side, at in (("low", F.floor(place)), ("high", F.ceil(place))):
            here = (F.col("before_n") <= at) & (at < F.col("before_n") + F.col("n"))
            ends.append(F.max(F.when(here, value)).alias(f"{side}_{i}"))
        ends.append(F.max(place - F.floor(place)).alias(f"part_{i}"))
    found = run.agg(*ends)
    rows = [
        F.struct(
            F.lit(float(p)).alias("probability"),
            (F.col(f"low_{i}") + (F.col(f"high_{i}") - F.col(f"low_{i}")) * F.col(f"part_{i}")).alias(
                "value"
            ),
        )
        for i, p in enumerate(probabilities)
    ]
    return found.select(F.inline(F.array(*rows)))


def approximate_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], accuracy: int = 10_000
) -> DataFrame:
    """As `quantiles`, in one pass with rank error up to rows/accuracy; returns values that occur."""
    probabilities = [float(p) for p in probabilities]
    found = df.agg(F.percentile_approx(column, probabilities, accuracy).alias("values"))
    wanted = F.array(*[F.lit(p) for p in probabilities])
    pairs = F.arrays_zip(wanted.alias("probability"), F.col("values").alias("value"))
    return found.select(F.inline(pairs)).select(
        "probability", F.col("value").cast("double").alias("value")
    )


def quantile_value(df: DataFrame, column: str, probability: float, *, exact: bool = True) -> Column:
    """The quantile as a scalar subquery, to compare other columns with."""
    find = quantiles if exact else approximate_quantiles
    return find(df, column, [probability]).select("value").scalar()
