"""Connected components of a large graph by union-find inside batches and star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from agoralens.sources.scratch import Scratch


def _forest(edges: DataFrame) -> DataFrame:
    """Within each Arrow batch, replace the edges by one from every node to its smallest one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parent: dict = {}

            def root(x):
                while parent.setdefault(x, x) != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            pairs = [(x, root(x)) for x in list(parent) if root(x) != x]
            types = batch.schema.types
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], types[i]) for i in (0, 1)], names=["a", "b"])

    return edges.mapInArrow(run, edges.schema)


def components(edges: DataFrame) -> DataFrame:
    """`node`, `root` (the smallest node of its component) of every node in `edges` (`a`, `b`).

    Rounds of large and small stars (every node's larger neighbours, then it and its smaller ones,
    are linked to its smallest neighbour) until nothing changes; a path of n nodes takes some
    log(n) rounds. Nodes must be of one orderable type without NULL. Each round aggregates by node
    and joins the stored smallest neighbours back, so a node with any number of edges is never one
    group and its join can be split. Rounds are stored in the shared folder; older ones are deleted.
    """
    tables = Scratch(edges.sparkSession)

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = tables.stored(_forest(edges.select("a", "b").where("a != b")), "edges")
    before = None
    while before != (before := mark(now)):
        both = now.union(now.select("b", "a"))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        lowest = tables.stored(lowest, "lowest")
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = tables.stored(large, "edges")
        lowest = tables.stored(large.groupBy("a").agg(F.min("b").alias("low")), "lowest")
        linked = large.join(lowest, "a").where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        now = tables.stored(linked.union(lowest.select("a", F.col("low").alias("b"))).distinct(), "edges")
        tables.drop(now)
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
