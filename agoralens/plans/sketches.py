"""Sketches on the test tables, each held against exact figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from agoralens.operators import sketches
from agoralens.plans import roles
from agoralens.plans.registry import question
from agoralens.sources.scratch import stored

#: Small enough that the test tables' months hold more people than a sketch keeps.
BITS, SIZE = 6, 200
QUANTILES = (0.5, 0.9, 0.95, 0.99)


def _period(unit: str, column: str = "date") -> Column:
    return F.date_trunc(unit, column).cast("date")


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who wrote a post or a comment, and when."""
    posts = roles.bare_posts(spark, sf_dir).select("author", "created", F.lit("post").alias("kind"))
    comments = roles.comments(spark, sf_dir).select("author", "created", F.lit("comment").alias("kind"))
    return posts.unionByName(comments)


_PEOPLE = """activity AS (
  SELECT o_custkey AS author, o_orderdate AS created, 'post' AS kind FROM orders
  UNION ALL SELECT l_suppkey, l_shipdate, 'comment' FROM lineitem)"""


@question(f"""
WITH {_PEOPLE}
SELECT date_trunc('month', created)::DATE AS period, kind, count(*) AS n, count(DISTINCT author) AS people, true AS within
FROM activity GROUP BY 1, 2""")
def people_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct authors per month from daily sketches, next to the exact number: `within` tells whether
    the estimate is as near as stated."""
    rows = _activity(spark, sf_dir)
    days = stored(sketches.people_sketches(rows, "author", by=["kind"], bits=BITS))
    united = sketches.people_over(days, _period("month"), ["kind"], BITS)
    exact = rows.groupBy(_period("month", "created").alias("period"), "kind").agg(F.count_distinct("author").alias("people"))
    off = F.abs(sketches.estimated("_sketch") - F.col("people"))
    joined = united.withColumnRenamed("people", "_sketch").join(exact, ["period", "kind"])
    # An estimate is a whole number.
    return joined.select("period", "kind", "n", "people", (off <= F.ceil(sketches.theta_error(BITS) * F.col("people"))).alias("within"))


@question(f"""
WITH {_PEOPLE},
per AS (SELECT date_trunc('quarter', created)::DATE AS period, author, bool_or(kind = 'post') AS p, bool_or(kind = 'comment') AS c
  FROM activity GROUP BY 1, 2)
SELECT period, count(*) FILTER (p AND c) AS both_kinds, count(*) AS either, true AS within FROM per GROUP BY 1""")
def people_in_both_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors of posts as well as of comments per quarter, by intersecting the same daily sketches."""
    rows = _activity(spark, sf_dir)
    days = stored(sketches.people_sketches(rows, "author", by=["kind"], bits=BITS))
    found = sketches.active_in_both(sketches.people_over(days, _period("quarter"), ["kind"], BITS), "kind", "post", "comment")
    kinds = F.collect_set("kind")
    exact = rows.groupBy(_period("quarter", "created").alias("period"), "author").agg(F.size(kinds).alias("kinds"))
    exact = exact.groupBy("period").agg(F.count_if(F.col("kinds") == 2).alias("both_kinds"), F.count("*").alias("all"))
    bound = F.ceil(sketches.theta_error(BITS) * F.sqrt(F.greatest(F.col("both_kinds"), F.lit(1)) * F.col("all")))
    near = F.abs(F.col("both") - F.col("both_kinds")) <= bound
    union_near = F.abs(F.col("either") - F.col("all")) <= F.ceil(sketches.theta_error(BITS) * F.col("all"))
    return exact.join(found, "period").select("period", "both_kinds", F.col("all").alias("either"), (near & union_near).alias("within"))


def _quantiles_sql(unit: str) -> str:
    return f"""
SELECT date_trunc('{unit}', l_shipdate)::DATE AS period, probability, count(l_extendedprice) AS n, true AS within
FROM lineitem, (SELECT unnest([{", ".join(str(p) for p in QUANTILES)}])::DOUBLE AS probability) GROUP BY 1, 2"""


def _sketched_quantiles(spark: SparkSession, sf_dir: str, unit: str) -> DataFrame:
    """Quantiles of comment scores from daily sketches, and whether their true ranks are as near as
    stated. The days are sketched once; months and quarters are merged from them."""
    comments = roles.comments(spark, sf_dir).select("score", "created")
    days = stored(sketches.value_sketches(comments, "score", size=SIZE))
    merged = sketches.values_over(days, _period(unit), size=SIZE)
    # Sketches draw lots, so the values that are checked are the ones that were read.
    asked = stored(sketches.sketched_quantiles(merged, QUANTILES))
    found = sketches.rank_errors(comments, "score", _period(unit, "created"), asked)
    return found.select("period", "probability", "n", (F.col("rank_error") <= sketches.kll_error(SIZE)).alias("within"))


@question(_quantiles_sql("month"))
def monthly_sketched_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sketched_quantiles(spark, sf_dir, "month")


@question(_quantiles_sql("quarter"))
def quarterly_sketched_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sketched_quantiles(spark, sf_dir, "quarter")
