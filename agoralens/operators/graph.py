"""Iterative joins over edge tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from agoralens.operators.lookups import HOT_SHARE, spread_join, spread_lookup, spread_rows
from agoralens.sources.scratch import cut_lineage, new_folder, stored
from agoralens.sources.tables import write_bucketed


#: Edges that one bucket should hold at most; what a round looks up in a bucket is held in memory.
BUCKET_ROWS = 2_000_000


def pagerank(
    edges: DataFrame,
    iterations: int = 10,
    damping: float = 0.85,
    *,
    keep_unlinked: bool = False,
    checkpoint_every: int = 5,
) -> DataFrame:
    """(node, rank) after a fixed number of rounds over distinct (src, dst) edges.

    Every node with outgoing edges starts at 1. A round gives each node (1 - damping) plus damping
    times the shares sent to it. Nodes nobody links to drop out after the first round, unless
    `keep_unlinked` keeps them at 1 - damping.

    The edges are written once as a table bucketed by source, with those of very large sources
    spread over parts; that is their only shuffle, and equal ones meet there. A round moves one row per
    source and, added up beforehand, one per task and target; the shares are hashed, so that edges are
    not sorted. Ranks are stored every `checkpoint_every` rounds.
    """
    spark = edges.sparkSession
    drawn = edges.select("src", "dst")
    raw = stored(drawn.groupBy("src").agg(F.count("*").alias("_rows")), "degrees")
    total = raw.agg(F.sum("_rows").alias("total")).first()["total"] or 0
    hot = raw.where(F.col("_rows") * F.lit(HOT_SHARE) > total).select("src", F.lit(True).alias("_hot"))
    table = f"links_{uuid.uuid4().hex}"
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_ROWS))
    # Equal edges have one source and part, so they are in one bucket.
    links = spread_rows(drawn, hot, ["src"]).repartition(tasks, "src", "_part").distinct()
    write_bucketed(links, table, ["src", "_part"], tasks, path=new_folder(spark, "links"))
    try:
        links = spark.table(table)
        sources = stored(links.groupBy("src").agg(F.count("*").alias("_out")), "sources")
        return _ranks(links, sources, hot, iterations, damping, keep_unlinked, checkpoint_every)
    finally:
        spark.sql(f"DROP TABLE {table}")


def _ranks(
    links: DataFrame, sources: DataFrame, hot: DataFrame, iterations: int, damping: float, keep_unlinked: bool,
    checkpoint_every: int,
) -> DataFrame:
    nodes = links.select(F.col("src").alias("node")).union(links.select("dst")).distinct()

    ranks = sources.select(F.col("src").alias("node"), F.lit(1.0).alias("rank"))
    for step in range(1, iterations + 1):
        shares = sources.join(ranks.withColumnRenamed("node", "src"), "src").select(
            "src", (F.col("rank") / F.col("_out")).alias("_share")
        )
        sent = links.join(spread_lookup(shares, hot, ["src"]).hint("shuffle_hash"), ["src", "_part"])
        received = sent.groupBy(F.col("dst").alias("node")).agg(F.sum("_share").alias("_sum"))
        if keep_unlinked:
            received = nodes.join(received, "node", "left").fillna(0.0, subset=["_sum"])
        ranks = received.select(
            "node", (F.col("_sum") * damping + F.lit(1 - damping)).alias("rank")
        )
        if step % checkpoint_every == 0 or step == iterations:
            ranks = stored(ranks, "ranks")
    return ranks


def transitive_closure(edges: DataFrame, max_rounds: int = 1_000) -> DataFrame:
    """All (src, dst) pairs connected by a path. Only newly found pairs are extended each round.

    The result grows with the square of path lengths; for large graphs ask for the nodes within
    `reach` of given ones.
    """
    base = cut_lineage(edges.select("src", "dst").distinct())
    found, new = base, base
    for _ in range(max_rounds):
        step = base.select(F.col("src").alias("dst"), F.col("dst").alias("_next"))
        longer = spread_join(new, step, ["dst"]).select("src", F.col("_next").alias("dst"))
        new = cut_lineage(longer.distinct().join(found, ["src", "dst"], "left_anti"))
        if new.isEmpty():
            return found
        found = found.union(new)
    raise RuntimeError(f"closure not reached in {max_rounds} rounds")


def reach(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """`node`, `steps`: all nodes that a path leads to from one of the seeds (`node`), and the
    length of the shortest one. Each round follows the edges of the nodes found last; every node is
    kept once, so the result is at most one row per node, whatever the paths."""
    base = stored(edges.select("src", "dst").distinct())
    new = stored(seeds.select("node").distinct().withColumn("steps", F.lit(0)))
    found, steps = new, 0
    while not new.isEmpty():
        steps += 1
        next_ones = spread_join(base, new.select(F.col("node").alias("src")), ["src"]).select(F.col("dst").alias("node"))
        new = stored(next_ones.distinct().join(found, "node", "left_anti").withColumn("steps", F.lit(steps)))
        found = stored(found.union(new))
    return found
