import numpy as np
import pytest
from pyspark.sql import functions as F

from agoralens.operators import topics
from tests.conftest import plan, rows


@pytest.fixture(scope="module")
def docs(spark):
    texts = [(i, "cat@dog@pet@cat" if i % 2 else "tax@law@vote@law") for i in range(40)] + [(99, None)]
    return topics.word_tokens(spark.createDataFrame(texts, "id int, clean_text string")).cache()


@pytest.fixture(scope="module")
def model(docs):
    return topics.fit_topics(docs, k=2, max_iter=20, min_docs=2)


def test_topics(docs, model):
    assert docs.count() == 40
    described = topics.describe(model, 3)
    assert described.count() == 6 and rows(described.select("rank").distinct()) == [(1,), (2,), (3,)]
    assigned = topics.assign(model, docs)
    sides = assigned.groupBy("clean_text").agg(F.count_distinct("top_topic").alias("n"))
    assert {r.n for r in sides.collect()} == {1}
    assert assigned.agg(F.count_distinct("top_topic")).first()[0] == 2
    assert sum(r.n for r in topics.prevalence(assigned).collect()) == 40
    first = topics.samples(assigned)
    assert {r.id for r in first.collect()} == {0, 1}
    table = topics.summary_with_sample(topics.summary(described), first).collect()
    assert [r.topic for r in table] == [0, 1]
    assert {r.sample_submission for r in table} == {"cat dog pet cat", "tax law vote law"}


def test_same_seed_gives_the_same_topics(docs, model):
    again = topics.fit_topics(docs, k=2, max_iter=20, min_docs=2)
    assert rows(topics.describe(again, 3).select("topic", "rank", "word")) == rows(topics.describe(model, 3).select("topic", "rank", "word"))


def _written(spark, tmp_path):
    """Three files of documents, some of them empty, equal or long, as vectors."""
    from pyspark.ml.feature import CountVectorizerModel

    def tokens(i):
        return [] if i % 11 == 0 else [f"w{(i % 3) * 10 + (i * j) % 10}" for j in range(1 + i % 9 * (30 if i % 50 == 7 else 1))]

    df = spark.createDataFrame([(i, tokens(i)) for i in range(200)], "id int, tokens array<string>").repartitionByRange(3, "id")
    words = CountVectorizerModel.from_vocabulary([f"w{n}" for n in range(30)], inputCol="tokens", outputCol="counts")
    words.transform(df).write.parquet(str(tmp_path / "counts"))
    return spark.read.parquet(str(tmp_path / "counts"))


@pytest.mark.parametrize("share, learn", [(1.0, True), (0.5, True), (1.0, False)])
def test_topics_are_those_of_lda(spark, tmp_path, share, learn):
    from pyspark.ml.clustering import LDA

    from agoralens.operators import variational
    from agoralens.sources import scratch

    counts = _written(spark, tmp_path)
    lda = LDA(k=3, maxIter=4, featuresCol="counts", seed=7, subsamplingRate=share, optimizeDocConcentration=learn)
    weights, priors = variational.fit(counts, lda)
    # Draws and starts go by partition, so both learn from the same files.
    known = lda.fit(spark.read.parquet(scratch.made_since(0)[-1]))
    assert np.allclose(weights, known.topicsMatrix().toArray(), rtol=1e-6)
    assert np.allclose(priors, known.estimatedDocConcentration().toArray(), rtol=1e-6)


def test_documents_drawn_again(spark):
    """A pass draws as many documents as there are, so it draws some of them two or three times."""
    from agoralens.operators import variational

    counts = spark.range(30).selectExpr("id AS row", "array(0, 1) AS indices", "array(2D, 1D) AS values")
    drawn = counts.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3)))).drop("copy").coalesce(1)
    factors, starts, alpha = np.full((2, 3), 0.4) + np.arange(6).reshape(2, 3) / 10, np.ones((1, 3)), np.full(3, 0.3)
    once = variational._pass(counts.coalesce(1), factors, starts, alpha)
    thrice = variational._pass(drawn, factors, starts, alpha)
    assert np.allclose(3 * once[0], thrice[0]) and np.allclose(3 * once[1], thrice[1])
    assert (3 * once[2], 3 * once[3]) == thrice[2:]


def test_settled_documents_do_not_depend_on_their_block():
    from agoralens.operators import variational

    random = np.random.default_rng(1)
    words, times = random.gamma(1, 1, (40, 3, 12)), random.integers(0, 4, (40, 12)).astype(float)
    start, alpha = np.tile(random.gamma(100, 0.01, 3), (40, 1)), np.full(3, 0.1)
    settled, weights, thetas, ratios = variational.settle(words, times, start, alpha)
    assert settled.all()
    for i in range(40):
        alone = variational.settle(words[[i]], times[[i]], start[[i]], alpha)
        for got, want in zip((weights, thetas, ratios), alone[1:]):
            assert np.allclose(got[i], want[0])
    some, half, *_ = variational.settle(words, times, start, alpha, 20)
    assert 20 <= some.sum() < 40 and np.allclose(half[some], weights[some])
    rest = variational.settle(words[~some], times[~some], half[~some], alpha)
    assert np.allclose(rest[1], weights[~some])


def test_frequent_words_count_in_batches(spark):
    """Tokens are added up before they are rows; documents with a word count once, in any batch."""
    texts = [(["a", "a", "b"],), (["b", None, ""],), (None,), ([],), (["a", "c", "c", "c"],), (["d"],)]
    df = spark.createDataFrame(texts * 30, "tokens array<string>").coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = topics.frequent_words(df, "tokens", 3, 31)
        assert [tuple(r) for r in found.collect()] == [("a", 90), ("b", 60)]
        assert "Generate" not in plan(found)
        found = topics.frequent_words(df, "tokens", 3, 30)
        assert [tuple(r) for r in found.collect()] == [("a", 90), ("c", 90), ("b", 60)]
        assert topics.frequent_words(df.limit(0), "tokens", 3, 0).count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_few_calls_per_step(monkeypatch):
    """A step takes one exponential of digammas and two products for a whole block, and blocks hold so many
    documents that those calls are few."""
    from agoralens.operators import variational

    random = np.random.default_rng(1)
    words, times = random.gamma(1, 1, (40, 3, 12)), random.integers(1, 4, (40, 12)).astype(float)
    calls = []
    plain = variational.exp_digamma
    monkeypatch.setattr(variational, "exp_digamma", lambda x: (calls.append(len(x)), plain(x))[1])
    monkeypatch.setattr(variational, "expected_logs", None)
    settled, *_ = variational.settle(words, times, np.ones((40, 3)), np.full(3, 0.1))
    assert settled.all() and calls[0] == 40
    assert len(next(variational._blocks(np.full(500, 220), 15))) > 150


def test_digamma():
    from agoralens.operators import variational

    euler = 0.57721566490153286
    assert variational.digamma(np.array([1.0, 2.0, 0.5])) == pytest.approx([-euler, 1 - euler, -euler - 2 * np.log(2)], abs=1e-13)
    assert variational.trigamma(np.array([1.0, 0.5])) == pytest.approx([np.pi**2 / 6, np.pi**2 / 2], abs=1e-12)
    x = np.array([1e-8, 1e-3, 0.1, 3.0, 1e3, 1e8])
    assert variational.digamma(x + 1) - variational.digamma(x) == pytest.approx(1 / x, rel=1e-6)


def test_exp_digamma():
    from agoralens.operators import variational

    x = np.array([[1e-3, 0.0667, 0.5], [3.0, 1e3, 1e8]])
    assert variational.exp_digamma(x) == pytest.approx(np.exp(variational.digamma(x)), rel=1e-12, abs=1e-300)


def test_ranked_words(spark):
    df = spark.createDataFrame([(0, "a, b,c"), (1, "x")], "topic int, topic_words string")
    assert rows(topics.ranked_words(df, 2)) == [(0, 1, "a"), (0, 2, "b"), (1, 1, "x")]
    joined = spark.createDataFrame([(" a@@b ",), (None,)], "t string")
    assert [r[0] for r in joined.select(topics.readable("t")).collect()] == ["a b", None]


def test_a_topic_without_documents_has_no_sample(spark):
    summary = spark.createDataFrame([(0, "a"), (1, "b")], "topic int, topic_words string")
    samples = spark.createDataFrame([(1, 7, "x@y")], "top_topic int, id int, clean_text string")
    assert rows(topics.summary_with_sample(summary, samples)) == [(0, "a", None), (1, "b", "x y")]


def test_term_weights_equal_hashed_weights(spark):
    from pyspark.ml.functions import vector_to_array

    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, [])], "id int, tokens array<string>")
    long = {}
    for r in topics.term_weights(df).collect():
        long.setdefault(r.id, []).append(r.weight)
    hashed = topics.tfidf(df).select("id", F.filter(vector_to_array("tfidf"), lambda w: w > 0).alias("w"))
    for r in hashed.collect():
        assert sorted(r.w) == pytest.approx(sorted(long.get(r.id, [])))


def test_tfidf_weighs_rare_words_more(docs):
    got = topics.tfidf(docs, features=1 << 10)
    assert got.count() == 40 and "tfidf" in got.columns


def test_known_topics(spark):
    model = topics.known_topics(spark, ["a", "b", "c"], [[3.0, 1.0, 0.001], [0.001, 0.001, 5.0]])
    words = {(r.topic, r["rank"]): (r.word, round(r.weight, 3)) for r in topics.describe(model, 2).collect()}
    assert words[0, 1] == ("a", 0.75) and words[0, 2] == ("b", 0.25) and words[1, 1] == ("c", 1.0)
    df = spark.createDataFrame([(1, ["a", "b", "x"]), (2, ["c", "c", "a"]), (3, [])], "id int, tokens array<string>")
    got = {r.id: (r.top_topic, round(r.top_share, 3)) for r in topics.assign(model, df).collect()}
    assert got == {1: (0, round(2.1 / 2.2, 3)), 2: (1, round(2.1 / 3.2, 3)), 3: (0, 0.0)}


def test_saved_topics(spark, tmp_path):
    model = topics.known_topics(spark, ["a", "b"], [[3.0, 1.0], [1.0, 3.0]])
    topics.save_topics(model, str(tmp_path / "m"))
    again = topics.load_topics(str(tmp_path / "m"))
    df = spark.createDataFrame([(1, ["a", "b", "b"])], "id int, tokens array<string>")
    assert rows(topics.assign(again, df)) == rows(topics.assign(model, df))


def test_summary_works_topics_out_once(spark, monkeypatch):
    """Samples are looked for in two passes over what was assigned, not by assigning twice."""
    from agoralens.plans import topic_models as plans

    model = topics.known_topics(spark, ["a", "b", "c"], [[3.0, 1.0, 0.001], [0.001, 0.001, 5.0]])
    docs = topics.word_tokens(spark.createDataFrame([(1, "a@b"), (2, "c@c"), (3, "b@a")], "id int, clean_text string"))
    monkeypatch.setattr(plans, "_docs", lambda *_: docs)
    monkeypatch.setattr(plans, "_model", lambda *_: model)
    seen, samples = [], topics.samples
    monkeypatch.setattr(topics, "samples", lambda df: (seen.append(df), samples(df))[1])
    table = plans.topic_summary(spark, "").collect()
    assert [(r.topic, r.sample_submission) for r in table] == [(0, "a b"), (1, "c c")]
    assert "UDF" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
