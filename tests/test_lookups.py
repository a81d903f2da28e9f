import pytest
from pyspark.sql import functions as F

from agoralens.operators import emotion, lookups
from agoralens.operators.vectorized import demean, filter_batches, map_series, map_series_with_setup
from tests.conftest import plan, rows


def hot_table(spark, n=6000):
    """A third of the rows hold key 0, the rest are spread over 2,000 keys."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 2000 + 1)
    return spark.range(n).select("id", key.alias("k"))


def test_hot_keys_are_found_and_bounded(spark):
    assert rows(lookups.hot_keys(hot_table(spark), ["k"], share=100)) == [(0, True)]
    assert lookups.hot_keys(hot_table(spark), ["k"]).count() < lookups.HOT_SHARE


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_join(spark, how):
    facts = hot_table(spark)
    lookup = spark.range(0, 1500).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    double = lookup.union(lookup.where("k = 0").withColumn("v", F.lit(-1)))
    got = lookups.spread_join(facts, double, ["k"], how)
    assert got.columns == ["k", "id", "v"]
    assert rows(got) == rows(facts.join(double, "k", how))


def test_a_hot_key_is_split_over_parts(spark):
    facts = hot_table(spark)
    hot = lookups.hot_keys(facts, ["k"])
    spread = lookups.spread_rows(facts, hot, ["k"]).where("k = 0").groupBy("_part").count()
    counts = [r["count"] for r in spread.collect()]
    assert len(counts) == lookups.HOT_PARTS and max(counts) < 3 * 2000 / lookups.HOT_PARTS


def test_lookup_is_broadcast_only_when_counted_to_fit(spark):
    facts, lookup = hot_table(spark), spark.range(100).select(F.col("id").alias("k"))
    small = lookups.lookup_join(facts, lookup, ["k"])
    assert "BroadcastHashJoin" in plan(small)
    large = lookups.lookup_join(facts, lookup, ["k"], max_broadcast_rows=99)
    assert "_part" in large._jdf.queryExecution().optimizedPlan().toString()
    assert rows(small) == rows(large)
    with pytest.raises(ValueError):
        lookups.lookup_join(facts, lookup, ["k"], "full")


def test_broadcast_bounds(spark):
    df = spark.createDataFrame([("x" * 100, [1, 2]), (None, None)], "s string, a array<int>")
    assert lookups.fits_broadcast(df) and lookups.fits_broadcast(df.limit(0))
    assert not lookups.fits_broadcast(df, max_bytes=100)
    assert not lookups.fits_broadcast(df, max_rows=1)


LEXICON = [("love", "joy"), ("love", "positive"), ("hate", "anger"), ("hate", "negative"), ("x", "other")]


def docs(spark):
    return spark.createDataFrame(
        [(1, ["love", "love", "cat", ""]), (2, ["cat"]), (3, []), (4, ["hate", "love"])],
        "id int, tokens array<string>",
    )


def lexicon(spark):
    return spark.createDataFrame(LEXICON, "word string, emotion string")


def test_long_counts(spark):
    got = rows(emotion.counts(docs(spark), lexicon(spark)))
    assert got == [(1, "joy", 2), (1, "positive", 2), (4, "anger", 1), (4, "joy", 1), (4, "negative", 1), (4, "positive", 1)]
    assert "BroadcastHashJoin" in plan(emotion.counts(docs(spark), lexicon(spark)))


def test_densities_of_matches(spark):
    wide = emotion.wide_counts(docs(spark), lexicon(spark))
    got = {r.id: r for r in emotion.densities(wide, "matched").collect()}
    assert (got[1].joy_density, got[1].positive_density, got[1].fear_density) == (0.5, 0.5, 0.0)
    assert (got[2].joy_density, got[2].emotion_token_count, got[2].total_tokens) == (None, 0, 1)
    for r in got.values():
        if r.emotion_token_count:
            assert sum(r[f"{e}_density"] for e in emotion.EMOTIONS) == pytest.approx(1)
    average = emotion.temporal_profile(emotion.densities(wide, "matched").withColumn("hour", F.lit(1)), "hour")
    assert average.first().joy_avg == pytest.approx((0.5 + 0.25) / 2)


def test_densities_of_tokens(spark):
    wide = emotion.wide_counts(docs(spark), lexicon(spark), max_broadcast_rows=0)
    got = {r.id: r for r in emotion.densities(wide, "tokens").collect()}
    assert got[1].n_tokens == 3 and got[1].joy_density == pytest.approx(2 / 3)
    assert got[1].emotional_vocab_density == pytest.approx(4 / 3)
    assert (got[3].total_tokens, got[3].emotional_vocab_density, got[3].joy_density) == (1, 0.0, None)
    with pytest.raises(ValueError):
        emotion.densities(wide, "words")


def test_polarity(spark):
    wide = emotion.wide_counts(docs(spark), lexicon(spark))
    got = {r.id: (r.polarity, r.polarity_score) for r in emotion.polarity(emotion.densities(wide)).collect()}
    assert got == {1: (1, 0.5), 2: (0, 0.0), 3: (0, 0.0), 4: (0, 0.0)}


def test_mean_density_and_stemmed_lexicon(spark):
    scored = emotion.densities(emotion.wide_counts(docs(spark), lexicon(spark)), "tokens")
    first = emotion.mean_density(scored).first()
    assert first.emotion_density in ("joy_density", "positive_density")
    words = spark.createDataFrame([("loved", "joy"), ("loves", "joy")], "word string, emotion string")
    assert rows(emotion.stem_lexicon(words)) == [("love", "joy")]


def test_vectorised_functions(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 5.0)], "k int, v double")
    assert rows(demean(df, ["k"], "v")) == [(1, -1.0), (1, 1.0), (2, 0.0)]
    assert rows(filter_batches(df, lambda b: b["v"] > 3)) == [(1, 4.0), (2, 5.0)]
    double = map_series(lambda s: s * 2, "double")
    shift = map_series_with_setup(lambda: lambda s: s + 1, "double")
    assert rows(df.select(double("v"), shift("v"))) == [(10.0, 6.0), (4.0, 3.0), (8.0, 5.0)]
    assert "Python" not in plan(demean(df, ["k"], "v"))


def test_most_used_keys_are_not_shuffled(spark):
    """A lookup too large to broadcast: rows of its most used keys join without a shuffle, none is lost."""
    words = [(i, w) for i in range(40) for w in ("the", "a", f"w{i}", f"v{i % 20}", "x" * 50)] + [(99, None)]
    df = spark.createDataFrame(words, "id int, word string")
    lookup = lookups.stored(df.groupBy("word").agg(F.count("*").alias("n")).withColumn("extra", F.upper("word")))
    whole = rows(df.join(lookup, "word").select("id", "word", "n", "extra"))
    for most in (1, 2, 3, 5, 22, 1_000):
        got = lookups.frequent_join(df, lookup, "word", "n", most)
        assert rows(got.select("id", "word", "n", "extra")) == whole
    shuffled = lookups.frequent_join(df, lookup, "word", "n", 3)
    known = shuffled._jdf.queryExecution().optimizedPlan().toString().split("Project")[1]
    assert "strategy=broadcast" in known
