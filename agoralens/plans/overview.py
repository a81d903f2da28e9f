"""Tables, time and engagement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralens.functions.numbers import settle
from agoralens.functions.text import word_count
from agoralens.operators import engagement, ordering, sequences, split, stats, temporal
from agoralens.plans import roles
from agoralens.plans.registry import question
from agoralens.sources import ingest, tables
from agoralens.sources.scratch import stored, new_folder


def settled(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: settle(F.col(c), digits) for c in columns})


# ---- statistics ------------------------------------------------------------------------------

@question("""
SELECT 'comments' AS data_type, count(*) AS total_rows,
       round(count(*) * 200 / 1024.0 ^ 3, 2) AS size_gb,
       min(l_shipdate)::date AS date_range_start, max(l_shipdate)::date AS date_range_end
FROM lineitem
UNION ALL
SELECT 'submissions', count(*), round(count(*) * 200 / 1024.0 ^ 3, 2),
       min(o_orderdate)::date, max(o_orderdate)::date
FROM orders""")
def dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.dataset_summary(
        {
            "comments": (roles.comments(spark, sf_dir), "created"),
            "submissions": (roles.bare_posts(spark, sf_dir), "created"),
        }
    )


@question("""
WITH c AS (SELECT l_suppkey AS k, count(*) AS n, avg(l_extendedprice) AS a,
                  min(l_shipdate)::date AS lo, max(l_shipdate)::date AS hi
           FROM lineitem GROUP BY 1),
     p AS (SELECT o_custkey AS k, count(*) AS n, avg(o_totalprice) AS a,
                  min(o_orderdate)::date AS lo, max(o_orderdate)::date AS hi
           FROM orders GROUP BY 1)
SELECT coalesce(c.k, p.k) AS community, coalesce(c.n, 0) AS num_comments,
       coalesce(p.n, 0) AS num_submissions, coalesce(c.n, 0) + coalesce(p.n, 0) AS total_rows,
       round((coalesce(c.a * c.n, 0) + coalesce(p.a * p.n, 0))
             / (coalesce(c.n, 0) + coalesce(p.n, 0)) + 1e-9, 4) AS avg_score,
       least(c.lo, p.lo)::varchar || ' ~ ' || greatest(c.hi, p.hi)::varchar AS date_range
FROM c FULL JOIN p ON c.k = p.k""")
def community_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.community_stats(roles.comments(spark, sf_dir), roles.bare_posts(spark, sf_dir))
    return settled(out, 4, "avg_score")


@question("""
WITH c AS (SELECT year(l_shipdate) || '-' || month(l_shipdate) AS k, count(*) AS n
           FROM lineitem GROUP BY 1),
     p AS (SELECT year(o_orderdate) || '-' || month(o_orderdate) AS k, count(*) AS n
           FROM orders GROUP BY 1)
SELECT coalesce(c.k, p.k) AS year_month, coalesce(c.n, 0) AS num_comments,
       coalesce(p.n, 0) AS num_submissions, coalesce(c.n, 0) + coalesce(p.n, 0) AS total_rows
FROM c FULL JOIN p ON c.k = p.k""")
def monthly_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.monthly_volume(roles.comments(spark, sf_dir), roles.bare_posts(spark, sf_dir))


@question("""
SELECT 'comments' AS data_type, count(*) FILTER (text IS NULL) AS missing_text,
       count(*) FILTER (length(text) < 3) AS too_short,
       count(*) FILTER (length(text) > 5000) AS too_long
FROM conversations
UNION ALL
SELECT 'submissions', count(*) FILTER (t IS NULL), count(*) FILTER (length(t) < 3),
       count(*) FILTER (length(t) > 500)
FROM (SELECT split_part(text, chr(10), 1) AS t FROM documents)""")
def text_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = roles.table(spark, sf_dir, "conversations")
    posts = roles.post_texts(spark, sf_dir)
    return stats.text_quality(said, "text", name="comments").unionByName(
        stats.text_quality(posts, "title", name="submissions", max_length=500)
    )


@question(f"""
{roles.with_tables(roles.POSTS)}
SELECT 'score' AS column_name, count(score) AS count, round(avg(score) + 1e-9, 4) AS mean,
       round(stddev_samp(score) + 1e-9, 4) AS stddev, min(score) AS min, max(score) AS max
FROM posts
UNION ALL
SELECT 'num_comments', count(num_comments), round(avg(num_comments) + 1e-9, 4),
       round(stddev_samp(num_comments) + 1e-9, 4), min(num_comments)::double,
       max(num_comments)::double
FROM posts""")
def describe_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.describe_long(roles.posts(spark, sf_dir), ["score", "num_comments"])
    return settled(out, 4, "mean", "stddev")


@question("""
SELECT 'score' AS column_name, count(o_totalprice) AS count,
       round(avg(o_totalprice) + 1e-9, 4) AS mean,
       round(stddev_samp(o_totalprice) + 1e-9, 4) AS stddev,
       min(o_totalprice) AS min, max(o_totalprice) AS max,
       round(quantile_cont(o_totalprice, 0.25) + 1e-9, 4) AS p25,
       round(quantile_cont(o_totalprice, 0.5) + 1e-9, 4) AS p50,
       round(quantile_cont(o_totalprice, 0.75) + 1e-9, 4) AS p75
FROM orders""")
def summary_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.summary_long(roles.bare_posts(spark, sf_dir), "score")
    return settled(out, 4, "mean", "stddev", "p25", "p50", "p75")


_LENGTH_SQL = (
    "len(string_split_regex(regexp_replace(title || ' ' || selftext, "
    "'[^A-Za-z0-9]+', ' ', 'g'), '\\s+'))::int"
)


def _lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of each text post with its engagement; the text itself is not shuffled."""
    lengths = roles.post_texts(spark, sf_dir).select(
        "id",
        engagement.classify("selftext", roles.DEMO_TOPIC_RULES).alias("topic_label"),
        word_count("title", "selftext").alias("post_length"),
        F.length(F.concat_ws(" ", "title", "selftext")).alias("chars"),
    )
    return lengths.join(roles.post_meta(spark, sf_dir), "id", "left")


def _stored_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, written once: questions that pass over lengths several times read texts once."""
    return stored(_lengths(spark, sf_dir).select("post_length", "num_comments"))


LENGTHS = f"""lengths AS (
  SELECT t.id, {_LENGTH_SQL} AS post_length, length(title || ' ' || selftext)::int AS chars,
         CASE WHEN regexp_matches(lower(selftext), 'the.?re|tion') THEN 'the'
              WHEN regexp_matches(lower(selftext), 'ing') THEN 'ing'
              WHEN regexp_matches(lower(selftext), 'ou') THEN 'ou' ELSE 'other' END AS topic_label,
         author, score, num_comments, created
  FROM post_texts t LEFT JOIN post_meta m ON m.id = t.id)"""
_WITH_LENGTHS = roles.with_tables(roles.POST_TEXTS, roles.POST_META, LENGTHS)


@question(f"""
{_WITH_LENGTHS}
SELECT p AS probability, round(v + 1e-9, 4) AS value
FROM (SELECT unnest([0.5::double, 0.9, 0.95, 0.99]) AS p,
             unnest(quantile_cont(post_length, [0.5, 0.9, 0.95, 0.99])) AS v FROM lengths)""")
def quantiles_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ordering.quantiles(_stored_lengths(spark, sf_dir), "post_length", [0.5, 0.9, 0.95, 0.99])
    return settled(out, 4, "value")


@question(f"""
{_WITH_LENGTHS}
SELECT p AS probability, v::double AS value
FROM (SELECT unnest([0.5::double, 0.9, 0.95, 0.99]) AS p,
             unnest(quantile_disc(post_length, [0.5, 0.9, 0.95, 0.99])) AS v FROM lengths)""")
def quantiles_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.approximate_quantiles(
        _lengths(spark, sf_dir), "post_length", [0.5, 0.9, 0.95, 0.99], accuracy=100_000
    )


@question(f"""
{_WITH_LENGTHS}
SELECT 'post_length' AS var_x, 'score' AS var_y, round(corr(post_length, score) + 1e-9, 6) AS pearson_corr
FROM lengths
UNION ALL
SELECT 'post_length', 'num_comments', round(corr(post_length, num_comments) + 1e-9, 6) FROM lengths
UNION ALL
SELECT 'score', 'num_comments', round(corr(score, num_comments) + 1e-9, 6) FROM lengths""")
def corr_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = [("post_length", "score"), ("post_length", "num_comments"), ("score", "num_comments")]
    return settled(stats.corr_pairs(_lengths(spark, sf_dir), pairs), 6, "pearson_corr")


@question(f"""
{_WITH_LENGTHS}
SELECT 'postlength' AS feature, round(avg(post_length) + 1e-9, 4) AS mean,
       round(stddev_samp(post_length) + 1e-9, 4) AS std,
       round(corr(post_length, num_comments) + 1e-9, 6) AS corr_with_num_comments
FROM lengths
UNION ALL
SELECT 'characters', round(avg(chars) + 1e-9, 4), round(stddev_samp(chars) + 1e-9, 4),
       round(corr(chars, num_comments) + 1e-9, 6)
FROM lengths""")
def feature_target_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.feature_target_table(
        _lengths(spark, sf_dir), {"post_length": "postlength", "chars": "characters"}, "num_comments"
    )
    return settled(settled(out, 4, "mean", "std"), 6, "corr_with_num_comments")


@question(f"""
{_WITH_LENGTHS}, kept AS (
  SELECT post_length AS x FROM lengths
  WHERE post_length <= (SELECT quantile_cont(post_length, 0.95) FROM lengths)),
edges AS (SELECT min(x)::double AS lo, max(x)::double AS hi, (max(x) - min(x)) / 40.0::double AS w FROM kept)
SELECT bin, round(lo + bin * w + 1e-9, 4) AS bin_start, round(lo + (bin + 1) * w + 1e-9, 4) AS bin_end, n
FROM (SELECT least(39, floor((x - lo) / w))::int AS bin, count(*) AS n FROM kept, edges GROUP BY 1), edges""")
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = stats.clip_at_quantile(_stored_lengths(spark, sf_dir), {"post_length": 0.95})
    return settled(stats.histogram(kept, "post_length", 40), 4, "bin_start", "bin_end")


@question(f"""
{_WITH_LENGTHS}
SELECT floor(post_length / 25.0)::bigint AS bin, count(*) AS n,
       round(avg(post_length) + 1e-9, 4) AS x_avg, round(avg(num_comments) + 1e-9, 4) AS y_avg
FROM lengths
WHERE post_length > 0 AND post_length <= (SELECT quantile_cont(post_length, 0.95) FROM lengths)
GROUP BY 1""")
def binned_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = stats.clip_at_quantile(_stored_lengths(spark, sf_dir), {"post_length": 0.95})
    kept = kept.where(F.col("post_length") > 0)
    return settled(stats.binned_mean(kept, "post_length", "num_comments", 25), 4, "x_avg", "y_avg")


@question(f"""
{roles.with_tables(roles.POSTS)}
SELECT id, num_comments, score FROM posts
WHERE num_comments <= (SELECT quantile_cont(num_comments, 0.99) FROM posts)
  AND score <= (SELECT quantile_cont(score, 0.99) FROM posts)""")
def clip_at_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = stored(roles.posts(spark, sf_dir).select("id", "num_comments", "score"))
    kept = stats.clip_at_quantile(posts, {"num_comments": 0.99, "score": 0.99})
    return kept.select("id", "num_comments", "score")


@question("""
SELECT count(DISTINCT event_id) AS unique_comments, count(DISTINCT user_id) AS unique_users
FROM events""")
def activity_unique_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = roles.activity(spark, sf_dir)
    return stats.unique_counts(events, {"event_id": "unique_comments", "user_id": "unique_users"})


@question("""
SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 10""")
def activity_top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.top_groups(roles.activity(spark, sf_dir), "user_id", 10)


@question("""
SELECT hour(ts)::int AS hour_of_day, count(*) AS n FROM events GROUP BY 1""")
def activity_peak_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.hour_counts(roles.activity(spark, sf_dir))


@question("""
SELECT event_id, event_type, user_id, ts, ts::date AS date
FROM events WHERE event_type IN ('click', 'view')""")
def ingest_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ["event_id", "event_type", "user_id", "ts", "flair"]
    events = roles.table(spark, sf_dir, "events")
    kept = ingest.filter_and_project(
        events, ["click", "view"], wanted, community_col="event_type", created_col=""
    )
    return kept.withColumn("date", F.to_date("ts"))


@question("""
SELECT o_orderkey AS id FROM orders
WHERE ('0x' || substr(md5(o_orderkey::varchar || 's42'), 1, 8))::bigint % 10000 < 500""")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.hash_sample(roles.bare_posts(spark, sf_dir), "id", 0.05).select("id")


@question("""
SELECT year(o_orderdate)::int AS yyyy, month(o_orderdate)::int AS mm, count(*) AS n
FROM orders WHERE o_orderdate >= '1996-03-01' AND o_orderdate < '1997-02-01' GROUP BY 1, 2""")
def partitioned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write posts by year and month, then read a month range of them."""
    path = new_folder(spark, "posts-by-month")
    posts = roles.bare_posts(spark, sf_dir).withColumns(
        {"yyyy": F.year("created"), "mm": F.month("created")}
    )
    # One task per month (split further by key) instead of a file per task and month.
    part = F.pmod(F.xxhash64("id"), F.lit(8))
    tables.write_table(posts.repartition("yyyy", "mm", part), path, partition_by=["yyyy", "mm"])
    months = tables.read_months(spark, path, (1996, 3), (1997, 1))
    return months.groupBy("yyyy", "mm").agg(F.count("*").alias("n"))


@question("""
SELECT o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice) + 1e-9, 2) AS total
FROM orders GROUP BY 1""")
def sql_view_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over a temporary view."""
    roles.table(spark, sf_dir, "orders").createOrReplaceTempView("post_view")
    return spark.sql(
        "SELECT o_orderstatus AS status, count(*) AS n, "
        "round(sum(o_totalprice) + 1e-9, 2) AS total FROM post_view GROUP BY o_orderstatus"
    )


# ---- time ------------------------------------------------------------------------------------

@question("""
SELECT month(o_orderdate)::int AS month, count(*) AS post_count FROM orders GROUP BY 1""")
def month_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.month_counts(roles.bare_posts(spark, sf_dir))


@question("""
SELECT (dayofweek(ts) + 1)::int AS day_of_week, hour(ts)::int AS hour_of_day,
       count(*) AS post_count
FROM events GROUP BY 1, 2""")
def weekday_hour_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.weekday_hour_counts(roles.activity(spark, sf_dir))


@question("""
WITH p AS (SELECT (dayofweek(o_orderdate) + 1)::int AS k, count(*) AS n FROM orders GROUP BY 1),
     c AS (SELECT (dayofweek(l_shipdate) + 1)::int AS k, count(*) AS n FROM lineitem GROUP BY 1)
SELECT coalesce(p.k, c.k) AS day_of_week, p.n AS n_posts, c.n AS n_comments
FROM p FULL JOIN c ON p.k = c.k""")
def weekday_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.weekday_summary(roles.bare_posts(spark, sf_dir), roles.comments(spark, sf_dir))


_CELLS = ", ".join(f"count(*) FILTER (hour(ts) = {h}) AS h{h}" for h in range(24))


@question(f"""
SELECT (dayofweek(ts) + 1)::int AS day_of_week, {_CELLS} FROM events GROUP BY 1""")
def heatmap_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.heatmap_matrix(roles.activity(spark, sf_dir))


@question("""
SELECT kind, (dayofweek(t) + 1)::int AS day_of_week, hour(t)::int AS hour_of_day, count(*) AS n
FROM (SELECT 'post' AS kind, o_orderdate AS t FROM orders
      UNION ALL SELECT 'comment', ts FROM events)
GROUP BY 1, 2, 3""")
def activity_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.activity_by_kind(
        {"post": roles.bare_posts(spark, sf_dir), "comment": roles.activity(spark, sf_dir)}
    )


_KPIS = """
SELECT year(l_shipdate)::int AS dt_year, month(l_shipdate)::int AS dt_month,
       day(l_shipdate)::int AS dt_day, count(*) AS num_trips,
       round(avg(l_quantity) + 1e-9, 4) AS mean_l_quantity, max(l_tax) AS max_l_tax,
       quantile_disc(l_extendedprice, 0.95) AS q95_l_extendedprice,
       min(l_discount) AS min_l_discount, ceil(avg(l_linenumber))::bigint AS mean_l_linenumber
FROM lineitem WHERE l_shipdate >= '1997-01-01' AND l_shipdate < '1998-01-01' GROUP BY 1, 2, 3"""


def _kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = temporal.in_year(roles.table(spark, sf_dir, "lineitem"), "l_shipdate", 1997)
    return temporal.daily_kpis(
        rows, "l_shipdate", count="num_trips", mean="l_quantity", top="l_tax",
        high="l_extendedprice", low="l_discount", ceiling="l_linenumber",
    )


@question(_KPIS)
def daily_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(_kpis(spark, sf_dir), 4, "mean_l_quantity")


@question(f"""
SELECT count(*) AS days, sum(num_trips)::bigint AS total,
       round(avg(num_trips) + 1e-9, 4) AS mean_per_day,
       min(make_date(dt_year, dt_month, dt_day)) AS first_day,
       max(make_date(dt_year, dt_month, dt_day)) AS last_day
FROM ({_KPIS})""")
def daily_kpi_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(temporal.run_totals(_kpis(spark, sf_dir), "num_trips"), 4, "mean_per_day")


@question("""
WITH marked AS (
  SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w > INTERVAL 30 MINUTE
                             OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS opens
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts
             ROWS UNBOUNDED PRECEDING) AS s FROM marked)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end,
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 + 1800, 6) AS duration_seconds,
       count(*) AS n_events
FROM numbered GROUP BY user_id, s""")
def activity_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sequences.sessions(roles.table(spark, sf_dir, "events"), ["user_id"], "ts", 1800)
    return out.withColumns(
        {
            **{c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")},
            "duration_seconds": F.round("duration_seconds", 6),
        }
    )


@question("""
WITH r AS (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'view'
           GROUP BY 1, 2)
SELECT l.event_id, l.user_id, l.ts, r.value AS last_view_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') l
ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts""")
def asof_last_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the value of the same user's latest view."""
    events = roles.table(spark, sf_dir, "events")
    views = events.where(F.col("event_type") == "view").select(
        "user_id", "ts", F.col("value").alias("last_view_value")
    )
    buys = events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    return sequences.asof_join(buys, views, ["user_id"], "ts", ["last_view_value"])


# ---- engagement ------------------------------------------------------------------------------

@question(f"""
{roles.with_tables(roles.POST_TEXTS)}
SELECT id, {_LENGTH_SQL} AS post_length FROM post_texts""")
def post_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engagement.post_length(roles.post_texts(spark, sf_dir)).select("id", "post_length")


@question(f"""
{_WITH_LENGTHS}
SELECT CASE WHEN post_length < 100 THEN 'short_<100' WHEN post_length <= 500 THEN 'medium_100_500'
            ELSE 'long_>500' END AS length_bin,
       count(*) AS n_posts, round(avg(num_comments) + 1e-9, 4) AS avg_num_comments,
       round(avg(score) + 1e-9, 4) AS avg_score, round(avg(post_length) + 1e-9, 4) AS avg_post_length
FROM lengths GROUP BY 1""")
def length_bin_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = engagement.length_bin_stats(_lengths(spark, sf_dir))
    return settled(out, 4, "avg_num_comments", "avg_score", "avg_post_length")


@question(f"""
{_WITH_LENGTHS}
SELECT topic_label, count(*) AS count, round(avg(num_comments) + 1e-9, 4) AS avg_num_comments,
       round(avg(score) + 1e-9, 4) AS avg_score
FROM lengths GROUP BY 1""")
def topic_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = engagement.topic_stats(_lengths(spark, sf_dir))
    return settled(out, 4, "avg_num_comments", "avg_score")


@question("""
SELECT o_orderpriority AS topic, year(o_orderdate)::int AS year, count(*) AS n,
       round(count(*) / sum(count(*)) OVER (PARTITION BY year(o_orderdate)) + 1e-9, 6) AS share
FROM orders GROUP BY o_orderpriority, year(o_orderdate)""")
def topic_year_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = engagement.topic_year_share(roles.bare_posts(spark, sf_dir), "topic")
    return settled(out, 6, "share")


@question("""
WITH c AS (SELECT o_orderpriority AS topic, year(o_orderdate)::int AS year, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT c.topic, c.year, c.n, round((c.n - b.n) / b.n + 1e-9, 6) AS growth
FROM c LEFT JOIN c b ON b.topic = c.topic AND b.year = c.year - 1""")
def topic_year_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(engagement.topic_year_changes(roles.bare_posts(spark, sf_dir), "topic"), 6, "growth")


_CORR_OVER_TIME = """
SELECT date_trunc('{unit}', created)::date AS period, count(*) AS n_posts,
       {columns}
FROM ({rows}) GROUP BY 1"""


def _corr_sql(unit: str, names: list[str], rows: str, with_clause: str) -> str:
    columns = ",\n       ".join(
        f"round(avg({n}) + 1e-9, 4) AS avg_{n}, round(stddev_samp({n}) + 1e-9, 4) AS std_{n}, "
        f"round(corr({n}, score) + 1e-9, 6) AS corr_{n}_score, "
        f"round(corr({n}, num_comments) + 1e-9, 6) AS corr_{n}_comments"
        for n in names
    )
    return with_clause + _CORR_OVER_TIME.format(unit=unit, columns=columns, rows=rows)


def _corr_settled(df: DataFrame, names: list[str]) -> DataFrame:
    means = [f"{s}_{n}" for n in names for s in ("avg", "std")]
    corrs = [f"corr_{n}_{t}" for n in names for t in ("score", "comments")]
    return settled(settled(df, 4, *means), 6, *corrs)


@question(_corr_sql("day", ["chars", "post_length"], "SELECT * FROM lengths", _WITH_LENGTHS))
def corr_over_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["chars", "post_length"]
    return _corr_settled(engagement.corr_over_time(_lengths(spark, sf_dir), "day", names), names)


@question(
    _corr_sql(
        "quarter",
        ["length"],
        "SELECT score, num_comments, created, author AS length FROM posts",
        roles.with_tables(roles.POSTS),
    )
)
def corr_over_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = roles.posts(spark, sf_dir).withColumn("length", F.col("author"))
    return _corr_settled(engagement.corr_over_time(posts, "quarter", ["length"]), ["length"])


@question(f"""
{roles.with_tables(roles.POSTS)}
SELECT id, num_comments, CASE WHEN num_comments >= (SELECT quantile_cont(num_comments, 0.5) FROM posts)
                              THEN 'high' ELSE 'low' END AS engagement
FROM posts""")
def split_at_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = stored(roles.posts(spark, sf_dir).select("id", "num_comments"))
    out = engagement.split_at_quantile(posts)
    return out.select("id", "num_comments", "engagement")
