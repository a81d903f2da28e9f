"""Graph questions and vectorised functions on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralens.functions.keys import strip_kind
from agoralens.operators import graph, replies, vectorized
from agoralens.plans import roles
from agoralens.plans.overview import settled
from agoralens.plans.registry import question

_ROUNDS = 5


def _ranks_sql() -> str:
    steps = ["r0 AS (SELECT DISTINCT src AS node, 1.0::double AS rank FROM edges)"]
    for i in range(_ROUNDS):
        steps.append(
            f"r{i + 1} AS (SELECT dst AS node, 0.85 * sum(rank / n) + 0.15 AS rank "
            f"FROM edges JOIN r{i} ON node = edges.src JOIN degree ON degree.src = edges.src GROUP BY 1)"
        )
    return ",\n".join(steps)


@question(f"""
WITH pairs AS (SELECT DISTINCT 'p' || l_partkey AS a, 's' || l_suppkey AS b FROM lineitem),
edges AS (SELECT a AS src, b AS dst FROM pairs UNION ALL SELECT b, a FROM pairs),
degree AS (SELECT src, count(*) AS n FROM edges GROUP BY 1),
{_ranks_sql()}
SELECT node, round(rank + 1e-9, 6) AS rank FROM r{_ROUNDS}""")
def pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and suppliers that are traded together, linked both ways."""
    pairs = roles.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("p"), "l_partkey").alias("src"),
        F.concat(F.lit("s"), "l_suppkey").alias("dst"),
    )
    back = pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return settled(graph.pagerank(pairs.union(back), _ROUNDS), 6, "rank")


@question("""
WITH RECURSIVE edges AS (
  SELECT conv_id || '_' || turn AS src, conv_id || '_' || (turn - 1) AS dst
  FROM conversations WHERE turn > 0),
reach AS (SELECT src, dst FROM edges
          UNION SELECT r.src, e.dst FROM reach r JOIN edges e ON e.src = r.dst)
SELECT src, dst FROM reach""")
def transitive_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every comment with all comments above it in its thread."""
    replies = roles.replies(spark, sf_dir).where(F.col("parent_id").startswith("t1_"))
    edges = replies.select(F.col("id").alias("src"), strip_kind("parent_id").alias("dst"))
    return graph.transitive_closure(edges)


@question("""
WITH RECURSIVE edges AS (
  SELECT conv_id || '_' || (turn - 1) AS src, conv_id || '_' || turn AS dst
  FROM conversations WHERE turn > 0),
reach AS (SELECT conv_id || '_0' AS node, 0 AS steps FROM conversations WHERE turn = 0
          UNION SELECT e.dst, r.steps + 1 FROM reach r JOIN edges e ON e.src = r.node)
SELECT node, min(steps)::int AS steps FROM reach GROUP BY 1""")
def thread_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every comment below a thread's first one, and how many replies lie between."""
    replies = roles.replies(spark, sf_dir)
    below = replies.where(F.col("parent_id").startswith("t1_"))
    edges = below.select(strip_kind("parent_id").alias("src"), F.col("id").alias("dst"))
    return graph.reach(edges, replies.where(~F.col("parent_id").startswith("t1_")).select(F.col("id").alias("node")))


_ABOVE = """
WITH RECURSIVE said AS (
  SELECT conv_id || '_' || turn AS id, conv_id || '_' || (turn - 1) AS up, length(text) AS length FROM conversations),
above AS (
  SELECT id, id AS top, 0 AS steps FROM said
  UNION ALL SELECT a.id, s.up, steps + 1 FROM above a JOIN said s ON s.id = a.top JOIN said p ON p.id = s.up)"""


def _reply_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = roles.comment_texts(spark, sf_dir)
    return replies.reply_index(texts.select("id", "parent_id", F.length("body").alias("length")), ["length"])


@question(f"""{_ABOVE},
tops AS (SELECT id, arg_max(top, steps) AS root, max(steps) + 1 AS depth FROM above GROUP BY 1),
inside AS (SELECT top AS id, count(*) AS size, sum(length) AS total_length FROM above a JOIN said s ON s.id = a.id GROUP BY 1)
SELECT id, root, depth::BIGINT AS depth, size, total_length::BIGINT AS total_length FROM tops JOIN inside USING (id)""")
def reply_subtrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every comment with its topmost one, depth, and the number and length of the comments below it."""
    return _reply_index(spark, sf_dir).select("id", "root", "depth", "size", "total_length")


@question(f"{_ABOVE} SELECT top AS seed, id FROM above WHERE top LIKE '%\\_2' ESCAPE '\\' AND steps > 0")
def replies_below(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All comments below the third one of each thread, by a range join on the index."""
    index = _reply_index(spark, sf_dir)
    return replies.below(index, index.where("depth = 3").select("id"))


@question("""
SELECT event_id, round(value - avg(value) OVER (PARTITION BY user_id) + 1e-9, 6) AS value FROM events""")
def demeaned_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = roles.table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    out = vectorized.demean(events, ["user_id"], "value")
    return settled(out, 6, "value").select("event_id", "value")


@question("""
SELECT event_id, event_type, value FROM events WHERE value > 50 AND event_type LIKE '%i%'""")
def filtered_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vectorised predicate over Arrow batches."""
    events = roles.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return vectorized.filter_batches(
        events, lambda b: (b["value"] > 50) & b["event_type"].str.contains("i")
    )


@question("""
SELECT event_id, round(value * 1.5 + 1, 6) AS scaled, upper(event_type) AS kind FROM events""")
def mapped_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vectorised function per batch, and one with a set-up per task."""
    scale = vectorized.map_series(lambda s: s * 1.5 + 1, "double")
    upper = vectorized.map_series_with_setup(lambda: lambda s: s.str.upper(), "string")
    events = roles.table(spark, sf_dir, "events")
    return events.select(
        "event_id", F.round(scale("value"), 6).alias("scaled"), upper("event_type").alias("kind")
    )
