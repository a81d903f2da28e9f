import random
from collections import Counter

import pytest

from agoralens.operators import heavy
from agoralens.operators.language import top_words, word_counts
from tests.conftest import plan, rows


@pytest.fixture(scope="module")
def texts(spark):
    """Zipf-like words in two groups and one without a name, empty tokens, and a flat group."""
    draw = random.Random(3)
    words = [f"w{i}" for i in range(3_000)]
    weights = [1 / (i + 1) for i in range(3_000)]
    data = [(g, draw.choices(words, weights, k=60) + ["", None]) for g in ("a", "b", None) for _ in range(200)]
    data += [("flat", [f"x{i}" for i in range(n, n + 50)]) for n in range(0, 2_000, 50)] + [("none", []), ("none", None)]
    return spark.createDataFrame(data, "engagement string, tokens array<string>").repartition(6).cache()


@pytest.mark.parametrize("capacity", [5, 40, 400, 10_000])
def test_like_full_counts(texts, capacity):
    expected = rows(top_words(word_counts(texts), 20))
    assert rows(heavy.most_frequent(texts, 20, capacity=capacity)) == expected


def test_proofs(texts):
    """Skewed groups are proven with small summaries, flat ones are not; what is left out stays below the k-th."""
    found = heavy.summaries(texts, "engagement", "tokens", 200)
    chosen, rest = heavy.candidates(found, 5)
    assert {r.group for r in rest.collect()} == {"flat"}
    exact = {(r.engagement, r.word): r["count"] for r in word_counts(texts).collect()}
    for r in found.where("item IS NOT NULL").groupBy("group", "item").sum("low").collect():
        error = found.groupBy("group").sum("error").where(f"group <=> {repr(r.group) if r.group else 'NULL'}").first()[1] if r["item"] == "w0" else None
        n = exact[r.group, r["item"]]
        assert r["sum(low)"] <= n and (error is None or n <= r["sum(low)"] + error)
    for g in ("a", "b", None):
        best = sorted((n for (own, _), n in exact.items() if own == g), reverse=True)[4]
        kept = {r["item"] for r in chosen.collect() if r.group == g}
        assert all(w in kept for (own, w), n in exact.items() if own == g and n >= best)


def test_summary():
    words = [f"w{i % 7}" for i in range(100)] + [f"rare{i}" for i in range(60)]
    summary, exact = heavy.Summary(10), Counter(words)
    for w in words:
        summary.add([w], [1])
    summary.cut()
    assert len(summary.counts) <= 10 and summary.error <= len(words) / 11
    assert all(n <= exact[w] <= n + summary.error for w, n in summary.counts.items())
    assert all(n <= summary.error for w, n in exact.items() if w not in summary.counts)


def test_empty(spark):
    df = spark.createDataFrame([], "engagement string, tokens array<string>")
    assert heavy.most_frequent(df).count() == 0


def test_second_pass_shuffles_candidates_only(texts):
    shown = plan(heavy.most_frequent(texts, 20))
    assert "BroadcastHashJoin" in shown
