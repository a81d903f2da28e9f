import pytest

from agoralens.operators import graph
from tests.conftest import rows


def plain_ranks(edges, rounds, damping=0.85):
    out = {}
    for s, d in set(edges):
        out.setdefault(s, []).append(d)
    ranks = {s: 1.0 for s in out}
    for _ in range(rounds):
        got = {}
        for s, targets in out.items():
            for d in targets:
                if s in ranks:
                    got[d] = got.get(d, 0.0) + ranks[s] / len(targets)
        ranks = {n: v * damping + 1 - damping for n, v in got.items()}
    return ranks


def test_ranks_with_a_hot_source_and_a_hot_target(spark):
    edges = [("hub", f"n{i}") for i in range(300)] + [(f"n{i}", "hub") for i in range(300)]
    edges += [(f"n{i}", f"n{(i * 7) % 300}") for i in range(300)] + [("lone", "hub"), ("lone", "hub")]
    df = spark.createDataFrame(edges, "src string, dst string")
    got = {r.node: r["rank"] for r in graph.pagerank(df, 4, checkpoint_every=2).collect()}
    assert got == pytest.approx(plain_ranks(edges, 4))
    assert "lone" not in got
    kept = {r.node: r["rank"] for r in graph.pagerank(df, 4, keep_unlinked=True).collect()}
    assert kept["lone"] == pytest.approx(0.15) and len(kept) == 302


def test_closure(spark):
    edges = [(1, 2), (2, 3), (3, 1), (4, 5), (5, 6), (5, 6)]
    df = spark.createDataFrame(edges, "src int, dst int")
    assert rows(graph.transitive_closure(df)) == rows(spark.createDataFrame(
        [(a, b) for a in (1, 2, 3) for b in (1, 2, 3)] + [(4, 5), (4, 6), (5, 6)], "src int, dst int"))
    with pytest.raises(RuntimeError):
        graph.transitive_closure(df, max_rounds=1)


def test_closure_of_no_edges(spark):
    assert graph.transitive_closure(spark.createDataFrame([], "src int, dst int")).count() == 0


def test_reach(spark):
    edges = [(1, 2), (2, 3), (3, 1), (3, 4), (1, 4), (7, 8)]
    df = spark.createDataFrame(edges, "src int, dst int")
    seeds = spark.createDataFrame([(1,), (1,), (9,)], "node int")
    assert rows(graph.reach(df, seeds)) == [(1, 0), (2, 1), (3, 2), (4, 1), (9, 0)]
    assert graph.reach(df, seeds.limit(0)).count() == 0


def test_rounds_neither_sort_nor_shuffle_edges(spark, monkeypatch):
    """Equal edges count once, in hot sources too, without a second shuffle of edges; a round hashes the
    shares and leaves the bucketed edges as they lie."""
    edges = [("hub", f"n{i % 50}") for i in range(300)] + [(f"n{i % 50}", "hub") for i in range(300)]
    df = spark.createDataFrame(edges, "src string, dst string")
    plans, stored = [], graph.stored

    def spy(table, name="table"):
        plans.append(table._jdf.queryExecution().sparkPlan().toString())
        return stored(table, name)

    monkeypatch.setattr(graph, "stored", spy)
    got = {r.node: r["rank"] for r in graph.pagerank(df, 1).collect()}
    assert got == pytest.approx(plain_ranks(edges, 1))
    assert "ShuffledHashJoin [src" in plans[-1] and "SortMergeJoin" not in plans[-1].split("ShuffledHashJoin")[0]
