"""How length, topic and sentiment go with comments and score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from agoralens.functions.numbers import ratio, safe_corr
from agoralens.functions.text import first_match, word_count
from agoralens.operators.lookups import lookup_join
from agoralens.operators.ordering import quantile_value, ranks_of_counts
from agoralens.sources.scratch import stored

# Title keywords per topic, first match wins.
TOPIC_RULES = (
    ("breakup", "break.?up|separat|divorc"),
    ("marriage", "marri|wife|husband|spouse"),
    ("dating", "boyfriend|girlfriend|dating|crush"),
    ("family", "family|parent|mom|dad|sibling"),
    ("confession", "confess|secret|truth"),
)
DEFAULT_TOPIC = "other"

# Names and word limits of the length bins.
SHORT, MEDIUM, LONG = "short_<100", "medium_100_500", "long_>500"
SHORT_BELOW, MEDIUM_UP_TO = 100, 500


def post_length(df: DataFrame, title: str = "title", body: str = "selftext") -> DataFrame:
    """Add `post_length` in words of title and body; NULL engagement counts become 0."""
    filled = {c: F.coalesce(c, F.lit(0)) for c in ("score", "num_comments") if c in df.columns}
    return df.withColumns({"post_length": word_count(title, body), **filled})


def length_bin(length: str | Column) -> Column:
    length = F.col(length) if isinstance(length, str) else length
    return (
        F.when(length < SHORT_BELOW, SHORT).when(length <= MEDIUM_UP_TO, MEDIUM).otherwise(LONG)
    )


def length_bin_stats(df: DataFrame, length: str = "post_length") -> DataFrame:
    return (
        df.groupBy(length_bin(length).alias("length_bin"))
        .agg(
            F.count("*").alias("n_posts"),
            F.avg("num_comments").alias("avg_num_comments"),
            F.avg("score").alias("avg_score"),
            F.avg(length).alias("avg_post_length"),
        )
        .orderBy("length_bin")
    )


def classify(
    text: str | Column,
    rules: Sequence[tuple[str, str]] = TOPIC_RULES,
    default: str = DEFAULT_TOPIC,
) -> Column:
    """Topic of a text by ordered keyword rules; NULL and unmatched texts get the default."""
    return first_match(text, rules, default)


def topic_stats(df: DataFrame, topic: str = "topic_label") -> DataFrame:
    return (
        df.groupBy(topic)
        .agg(
            F.count("*").alias("count"),
            F.avg("num_comments").alias("avg_num_comments"),
            F.avg("score").alias("avg_score"),
        )
        .orderBy(F.desc("avg_num_comments"), topic)
    )


def topic_year_share(df: DataFrame, topic: str = "topic_label", created: str = "created") -> DataFrame:
    """Posts per topic and year, and their share of the year."""
    counts = df.groupBy(topic, F.year(created).alias("year")).agg(F.count("*").alias("n"))
    year_total = F.sum("n").over(W.partitionBy("year"))
    return counts.withColumn("share", F.col("n") / year_total)


def topic_year_changes(
    df: DataFrame, topic: str = "topic_label", created: str = "created"
) -> DataFrame:
    """One row per topic and year with posts: `n`, and `growth` over the year before.

    Growth is NULL where the year before has no posts.
    """
    counts = df.groupBy(topic, F.year(created).alias("year")).agg(F.count("*").alias("n"))
    order = W.partitionBy(topic).orderBy("year")
    before = F.when(F.lag("year").over(order) == F.col("year") - 1, F.lag("n").over(order))
    return counts.withColumn("growth", ratio(F.col("n") - before, before))


def topic_year_growth(
    df: DataFrame, years: Sequence[int], topic: str = "topic_label", created: str = "created"
) -> DataFrame:
    """Topic rows by columns `n_<year>` of the given years, with growth over the year before.

    Growth is NULL where the year before has no posts. `topic_year_changes` has all years.
    """
    year = F.year(created)
    wide = df.groupBy(topic).agg(*[F.count_if(year == y).alias(f"n_{y}") for y in years])
    growth = [
        ratio(F.col(f"n_{y}") - F.col(f"n_{before}"), F.col(f"n_{before}")).alias(f"growth_{y}")
        for before, y in zip(years, years[1:])
    ]
    return wide.select("*", *growth)


def corr_over_time(
    df: DataFrame, unit: str, lengths: Sequence[str], created: str = "created"
) -> DataFrame:
    """Per period ("month", "quarter", ...): mean and deviation of each text length and its
    correlation with score and comments. NULL where a period does not vary."""
    period = F.to_date(F.date_trunc(unit, created)).alias("period")
    per_length = [
        c
        for name in lengths
        for c in (
            F.avg(name).alias(f"avg_{name}"),
            F.stddev_samp(name).alias(f"std_{name}"),
            safe_corr(name, "score").alias(f"corr_{name}_score"),
            safe_corr(name, "num_comments").alias(f"corr_{name}_comments"),
        )
    ]
    return df.groupBy(period).agg(F.count("*").alias("n_posts"), *per_length)


def split_at_quantile(
    df: DataFrame,
    column: str = "num_comments",
    probability: float = 0.5,
    *,
    exact: bool = True,
    name: str = "engagement",
) -> DataFrame:
    """Label rows at or above the quantile "high", all others (and NULL) "low"."""
    border = quantile_value(df, column, probability, exact=exact)
    return df.withColumn(name, F.when(F.col(column) >= border, "high").otherwise("low"))


def sentiment_correlation(df: DataFrame, sentiment: str, metrics: Sequence[str]) -> DataFrame:
    """Pearson and Spearman correlation and the least-squares line of each metric on sentiment.

    One row per metric, over the rows that have both values.
    """
    out = None
    for metric in metrics:
        both = df.select(F.col(sentiment).alias("x"), F.col(metric).alias("y")).dropna()
        pearson = safe_corr("x", "y")
        row = both.agg(
            F.lit(metric).alias("metric"),
            F.count("*").alias("n"),
            pearson.alias("pearson"),
            F.try_divide(F.regr_sxy("y", "x"), F.regr_sxx("y", "x")).alias("slope"),
            (pearson * pearson).alias("r2"),
        ).withColumn("spearman", spearman(both, "x", "y").scalar())
        out = row if out is None else out.unionByName(row)
    return out


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row with the rank correlation `spearman` of two columns without NULLs.

    Ranks come from distributed running totals, and equal (x, y) pairs are collapsed to counts
    before they meet their ranks, so a value held by many rows is not sent to one task.
    """
    pairs = stored(df.groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(F.count("*").alias("n")), "pairs")
    for side in ("x", "y"):
        ranks = ranks_of_counts(pairs.groupBy(F.col(side).alias("value")).agg(F.sum("n").alias("n")))
        ranks = stored(ranks.withColumnsRenamed({"value": side, "rank": f"rank_{side}"}), "ranks")
        pairs = lookup_join(pairs, ranks, [side])
    n, a, b = F.col("n"), F.col("rank_x"), F.col("rank_y")
    moments = pairs.agg(
        F.sum(n).cast("double").alias("n"),
        F.sum(n * a).alias("a"),
        F.sum(n * b).alias("b"),
        F.sum(n * a * a).alias("aa"),
        F.sum(n * b * b).alias("bb"),
        F.sum(n * a * b).alias("ab"),
    )

    def centred(product: str, one: str, two: str) -> Column:
        return F.col(product) - F.col(one) * F.col(two) / F.col("n")

    spread = F.sqrt(centred("aa", "a", "a") * centred("bb", "b", "b"))
    return moments.select(F.try_divide(centred("ab", "a", "b"), spread).alias("spearman"))
