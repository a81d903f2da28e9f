import pytest
from pyspark.sql import functions as F

from agoralens.operators import features, ml
from tests.conftest import plan, rows

COMMENTS = "link_id string, author string, score int, length int, controversiality int"


def test_comment_features(spark):
    comments = spark.createDataFrame(
        [
            ("t3_a", "ann", 4, 10, 0), ("t3_a", "bob", 2, 20, 1), ("t3_a", "bob", None, 30, 1),
            ("t3_a", None, 0, 40, 0), ("t3_b", "eve", 1, 5, 0),
        ],
        COMMENTS,
    )
    posts = spark.createDataFrame([("a", "bob"), ("b", None), ("c", "eve")], "id string, author string")
    got = {r.link_id: r for r in features.comment_features(comments, posts).collect()}
    a = got["a"]
    assert set(got) == {"a", "b"}
    assert (a.comment_score_mean, a.comment_score_max, a.comment_score_sum) == (2.0, 4, 6)
    assert (a.comment_len_mean, a.comment_len_max, a.comment_len_sum) == (25.0, 40, 100)
    assert (a.comment_author_nunique, a.comment_is_op_ratio, a.comment_contro_mean) == (2, 0.5, 0.5)
    assert got["b"].comment_is_op_ratio == 0.0
    joined = {r.id: r for r in features.with_comment_features(posts, features.comment_features(comments, posts)).collect()}
    assert joined["c"].comment_author_nunique == 0 and joined["c"].comment_score_mean == 0.0
    assert joined["b"].author is None
    assert {r.comment_is_op_ratio for r in features.comment_features(comments).collect()} == {0.0}


def test_a_hot_thread_is_counted_whole(spark):
    hot = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "t3_hot").otherwise(F.concat(F.lit("t3_"), F.col("id"))).alias("link_id"),
        (F.col("id") % 500).cast("string").alias("author"),
        F.lit(1).alias("score"), F.lit(2).alias("length"), F.lit(0).alias("controversiality"),
    )
    got = features.comment_features(hot).where("link_id = 'hot'").first()
    assert (got.comment_score_sum, got.comment_author_nunique) == (3000, 500)
    assert "Join" not in plan(features.comment_features(hot))


def test_comments_within(spark):
    comments = spark.sql(
        "SELECT * FROM VALUES ('t3_a', timestamp'2024-01-01 00:30:00'), ('t3_a', timestamp'2024-01-01 02:00:00'), "
        "('t3_a', timestamp'2023-12-31 00:00:00') AS t(link_id, created)"
    )
    posts = spark.sql("SELECT 'a' id, timestamp'2024-01-01 00:00:00' created")
    assert features.comments_within(comments, posts, 3600).count() == 1


def test_post_features_of_empty_texts(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 'How? So.', array('how', 'so'), 'How?', 'So.', timestamp'2024-01-06 13:00:00'), "
        "(2, null, null, null, null, null) AS t(id, raw_text, tokens, title, selftext, created)"
    ).withColumn("tokens", F.col("tokens").cast("array<string>"))
    got = {r.id: r for r in features.post_features(df).collect()}
    assert (got[1].token_count, got[1].sentence_count, got[1].has_question_mark) == (2, 2, 1)
    assert (got[1].title_has_question_mark, got[1].post_hour, got[1].post_dow, got[1].is_weekend) == (1, 13, 7, 1)
    assert (got[2].token_count, got[2].title_token_count, got[2].char_len_clean, got[2].post_hour) == (0, 1, 0, 0)


def test_comment_rows(spark):
    df = spark.sql(
        "SELECT 'Toxic, why?  really' body, 't3_a' parent_id, 1 controversiality, 0 gilded, 3 score, "
        "timestamp'2024-01-06 13:00:00' created"
    )
    got = features.comment_row_features(df).first()
    assert (got.num_words, got.punctuation_count, got.contains_question, got.negativity) == (3, 1, 1, 1)
    assert (got.is_top_level, got.hour, got.label, got.body_length) == (1, 13, 1, 19)
    assert features.comment_row_features(df, first_word=True).first().num_words == 6


def test_thread_depth(spark):
    chain = [(str(i), "t3_p" if i == 0 else f"t1_{i - 1}") for i in range(20)]
    extra = [("w", "t1_gone"), ("v", "t1_w")] + [(f"r{i}", "t1_0") for i in range(200)]
    df = spark.createDataFrame(chain + extra, "id string, parent_id string")
    got = {r.id: r.depth for r in features.thread_depth(df).collect()}
    assert len(got) == 222
    assert all(got[str(i)] == i + 1 for i in range(20))
    assert (got["w"], got["v"], got["r7"]) == (1, 2, 2)


def test_thread_depth_of_a_reply_cycle(spark):
    df = spark.createDataFrame([("a", "t1_b"), ("b", "t1_a"), ("c", "t3_p")], "id string, parent_id string")
    assert rows(features.thread_depth(df, max_rounds=3)) == [("a", None), ("b", None), ("c", 1)]


def scored(spark):
    return spark.createDataFrame(
        [(1, 1.0, 0.9, 1.0), (2, 0.0, 0.8, 1.0), (3, 1.0, 0.8, 1.0), (4, 0.0, 0.1, 0.0), (5, 1.0, 0.05, 0.0)],
        "id int, label double, p double, prediction double",
    )


def test_roc(spark):
    points = rows(ml.roc_points(scored(spark), "p"))
    assert len(points) == 5 and (float("inf"), 0.0, 0.0) in points and (0.05, 1.0, 1.0) in points
    # Pairs of a positive and a negative in right order, ties one half: 4 of 6 with one tie.
    pairs = [(p, n) for p in (0.9, 0.8, 0.05) for n in (0.8, 0.1)]
    expected = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in pairs) / len(pairs)
    assert ml.roc_auc(scored(spark), "p").first().auc == pytest.approx(expected)


def test_auc_of_one_class_is_null(spark):
    assert ml.roc_auc(scored(spark).where("label = 1"), "p").first().auc is None


def test_metrics(spark):
    got = ml.binary_metrics(scored(spark)).first()
    assert (got.n, got.accuracy) == (5, 0.6)
    assert got.precision == pytest.approx(2 / 3) and got.recall == pytest.approx(2 / 3)
    assert got.f1 == pytest.approx((3 * (2 / 3) + 2 * 0.5) / 5)
    assert rows(ml.confusion_matrix(scored(spark))) == [(0.0, 0.0, 1), (0.0, 1.0, 1), (1.0, 0.0, 1), (1.0, 1.0, 2)]


def test_top_scored_breaks_ties_by_id(spark):
    top = ml.top_scored(scored(spark), ["id", "p"], "p", k=2)
    assert [tuple(r) for r in top.collect()] == [(1, 0.9), (2, 0.8)]
    assert "TakeOrderedAndProject" in plan(top)


def test_labels_and_weights(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "num_comments int")
    labelled = ml.quantile_label(df)
    assert {r[0]: r[1] for r in labelled.collect()} == {1: 0.0, 2: 0.0, 3: 0.0, 4: 1.0, None: 0.0}
    assert rows(ml.class_weights(labelled)) == [(0.0, 4, 1.0), (1.0, 1, 4.0)]
    assert {r.weight for r in ml.with_class_weights(labelled.where("label = 0")).collect()} == {1.0}
    even = ml.oversample(labelled.withColumn("id", F.col("num_comments")), "id")
    assert {r.label: r["count"] for r in even.groupBy("label").count().collect()} == {0.0: 4, 1.0: 4}


def test_controversy_model_learns_and_reloads(spark, tmp_path):
    n = F.col("id")
    rows_ = spark.range(400).select(
        n.cast("string").alias("id"), (n % 7).cast("int").alias("score"), (n % 50).cast("int").alias("body_length"),
        (n % 2).cast("int").alias("punctuation_count"), (n % 9).cast("int").alias("num_words"),
        (n % 3 == 0).cast("int").alias("is_top_level"), F.lit(0).alias("gilded"), (n % 24).cast("int").alias("hour"),
        ((n % 2 == 1) & (n % 5 != 0)).cast("int").alias("label"),
    )
    model = ml.controversy_pipeline().fit(rows_)
    result = ml.evaluate_binary(ml.score(model, rows_), "all").first()
    assert result.auc > 0.8 and 0 <= result.f1 <= 1
    path = str(tmp_path / "model")
    ml.save_model(model, path)
    again = ml.score(ml.load_model(path), rows_)
    assert rows(again.select("id", "probability_positive")) == rows(ml.score(model, rows_).select("id", "probability_positive"))
    table = ml.coefficients_table(spark, features.COMMENT_ROW_FEATURES, model.stages[-1].coefficients.toArray())
    assert table.first().feature == "punctuation_count"
    forest = ml.controversy_pipeline(trees=True).fit(rows_).stages[-1]
    shares = ml.importances_table(spark, features.COMMENT_ROW_FEATURES, forest.featureImportances.toArray())
    assert shares.agg(F.sum("importance")).first()[0] == pytest.approx(1)


def test_majority_baseline(spark):
    base = ml.majority_baseline(scored(spark))
    assert {r.prediction for r in base.collect()} == {1.0}
    assert ml.roc_auc(base, "probability_positive").first().auc == pytest.approx(0.5)


def test_thread_depth_ends_on_cycles_by_itself(spark):
    chain = [(f"n{i}", f"t1_n{i - 1}" if i else "t3_p", "t3_p") for i in range(40)]
    cycle = [("a", "t1_b", "t3_p"), ("b", "t1_a", "t3_p"), ("below", "t1_a", "t3_p")]
    df = spark.createDataFrame(chain + cycle, "id string, parent_id string, link_id string")
    depth = {r["id"]: r["depth"] for r in features.thread_depth(df).collect()}
    assert depth == {f"n{i}": i + 1 for i in range(40)} | {"a": None, "b": None, "below": None}


def test_controversy_model_scores_rows_without_features(spark):
    from agoralens.operators import ml

    rows_in = [(i, None if i % 4 == 0 else float(i % 7), float(i % 3), float(i % 2)) for i in range(80)]
    df = spark.createDataFrame(rows_in, "id int, a double, b double, label double")
    for trees in (False, True):
        model = ml.controversy_pipeline(["a", "b"], trees=trees).fit(df)
        scored = ml.score(model, df)
        assert scored.where("probability_positive IS NOT NULL").count() == 80


def test_post_features_join_no_texts(spark, tmp_path):
    """What is shuffled for the time of a post is numbers, in the query as well."""
    from agoralens.plans import models

    docs = spark.createDataFrame([(i, f"title {i}\nA body. Is it?", "a") for i in range(5)], "doc_id long, text string, source string")
    events = spark.createDataFrame([(i, i, 1.0) for i in range(4)], "event_id long, user_id long, value double")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    events.withColumn("ts", F.timestamp_seconds(F.col("event_id") * 3_600)).write.parquet(str(tmp_path / "events.parquet"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (models.post_features(spark, str(tmp_path)), models._post_features(spark, str(tmp_path))):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert not any(f"{c}#" in plan.split("Join LeftOuter")[0] for c in ("selftext", "raw_text", "tokens"))
            got = {r.id: (r.sentence_count, r.title_token_count, r.post_hour) for r in df.collect()}
            assert got == {i: (2, 2, i if i < 4 else 0) for i in range(5)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_forest_rows_in_bounded_parts(spark, monkeypatch):
    """However few parts the training table has, trees are grown on parts of bounded size, on all rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    df = spark.range(200).coalesce(1).select(*[(F.col("id") * k).cast("double").alias(f"x{k}") for k in (1, 2)], (F.col("id") >= 100).cast("double").alias("label"))
    pipeline = Pipeline(stages=[VectorAssembler(inputCols=["x1", "x2"], outputCol="features"), RandomForestClassifier(numTrees=3, seed=1)])
    seen, fit = [], RandomForestClassifier.fit

    def spy(self, data, *more):
        seen.append([n for n in data.rdd.glom().map(len).collect()])
        return fit(self, data, *more)

    monkeypatch.setattr(RandomForestClassifier, "fit", spy)
    same = [ml.fit_forest(pipeline, df).stages[-1].toDebugString, pipeline.fit(df).stages[-1].toDebugString]
    assert same[0].split("\n", 1)[1] == same[1].split("\n", 1)[1]
    monkeypatch.setattr(ml, "TREE_VALUES", 100)
    model = ml.fit_forest(pipeline, df)
    assert seen[0] == [200] and len(seen[2]) == 4 and sum(seen[2]) == 200 and max(seen[2]) <= 100
    assert model.transform(df).where("prediction = label").count() > 180
