import random
import statistics

import pytest
from pyspark.sql import functions as F

from agoralens.functions.keys import is_direct_reply, md5_bucket, strip_kind
from agoralens.functions.numbers import ratio, safe_corr
from agoralens.operators import engagement, ml, ordering, split, stats, temporal
from tests.conftest import plan, rows


def skewed(n=3000, seed=3):
    """Values of which a third are equal."""
    pick = random.Random(seed)
    return [7.0 if pick.random() < 1 / 3 else pick.gauss(0, 50) for _ in range(n)]


@pytest.mark.parametrize("ranges", [1, 2, 16, 256])
def test_running_totals_against_plain_python(spark, ranges):
    values = skewed()
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for descending in (False, True):
        counted = ordering.value_counts(df, "x")
        run = ordering.running_totals(counted, "value", ["n"], descending=descending, ranges=ranges)
        got = {r.value: (r.before_n, r.total_n) for r in run.collect()}
        ordered = sorted(values, reverse=descending)
        expected = {}
        for place, v in enumerate(ordered):
            expected.setdefault(v, (place, len(values)))
        assert got == expected


def test_quantiles_match_linear_interpolation(spark):
    values = skewed()
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    got = {r.probability: r.value for r in ordering.quantiles(df, "x", [0.0, 0.5, 0.95, 1.0]).collect()}
    assert got[0.0] == min(values) and got[1.0] == max(values)
    assert got[0.5] == pytest.approx(statistics.median(values))
    place = 0.95 * (len(values) - 1)
    ordered = sorted(values)
    low = int(place)
    assert got[0.95] == pytest.approx(ordered[low] + (ordered[low + 1] - ordered[low]) * (place - low))


def test_quantiles_of_nothing_are_null(spark):
    df = spark.createDataFrame([], "x double")
    assert rows(ordering.quantiles(df, "x", [0.5])) == [(0.5, None)]


def test_approximate_quantiles_return_values_that_occur(spark):
    df = spark.range(1, 101).withColumnRenamed("id", "x")
    got = {r.probability: r.value for r in ordering.approximate_quantiles(df, "x", [0.5, 0.99]).collect()}
    assert got == {0.5: 50.0, 0.99: 99.0}


def test_average_ranks_share_ties(spark):
    df = spark.createDataFrame([(v,) for v in (10, 20, 20, 30)], "x int")
    assert rows(ordering.average_ranks(df, "x")) == [(10, 1.0), (20, 2.5), (30, 4.0)]


def test_safe_corr(spark):
    df = spark.createDataFrame([(1, 2.0, 5), (2, 4.0, 5), (3, 6.5, 5), (4, None, 5)], "a int, b double, c int")
    r = df.agg(safe_corr("a", "b").alias("ab"), safe_corr("a", "c").alias("ac")).first()
    assert r.ab == pytest.approx(df.dropna().agg(F.corr("a", "b")).first()[0])
    assert r.ac is None


def test_ratio_by_zero_is_null(spark):
    assert spark.range(1).select(ratio(F.lit(1), F.lit(0))).first()[0] is None


def test_keys(spark):
    df = spark.createDataFrame([("t3_abc",), ("t1_x",), ("abc",), (None,)], "k string")
    got = [tuple(r) for r in df.select(strip_kind("k"), is_direct_reply("k")).collect()]
    assert got == [("abc", 1), ("x", 0), ("abc", 0), (None, 0)]


def test_splits_are_repeatable_and_complete(spark):
    df = spark.range(5000)
    train, test = split.hash_split(df, "id")
    other, _ = split.hash_split(df.repartition(13), "id")
    assert rows(train) == rows(other)
    assert train.count() + test.count() == 5000 and abs(train.count() - 4000) < 150
    assert train.join(test, "id", "left_semi").count() == 0
    assert abs(split.hash_sample(df, "id", 0.05).count() - 250) < 60
    folds = split.assign_fold(df, "id").groupBy("fold").count()
    assert {r.fold for r in folds.collect()} == {0, 1, 2}
    assert df.where(~md5_bucket("id", 7).between(0, 6)).count() == 0


def test_chronological_split(spark):
    days = spark.range(100).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date"))
    tagged = split.chronological_split(days)
    got = {r.split: (r.n, str(r.lo), str(r.hi)) for r in tagged.groupBy("split").agg(
        F.count("*").alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi")).collect()}
    assert got["train"] == (70, "2024-01-01", "2024-03-10")
    assert got["validation"][0] == 15 and got["test"][0] == 15
    assert got["train"][2] < got["validation"][1] and got["validation"][2] < got["test"][1]


COMMUNITY = "community string, score int, created timestamp_ntz"


def test_community_stats_with_one_sided_communities(spark):
    comments = spark.sql("SELECT 'a' community, 1 score, timestamp_ntz'2024-01-02 00:00:00' created")
    posts = spark.sql(
        "SELECT * FROM VALUES ('a', 4, timestamp_ntz'2024-01-01 00:00:00'), "
        "('a', 6, timestamp_ntz'2024-01-01 05:00:00'), ('b', 9, timestamp_ntz'2023-05-05 00:00:00') "
        "AS t(community, score, created)"
    )
    got = rows(stats.community_stats(comments, posts))
    assert got[0][:4] == ("a", 1, 2, 3) and got[0][4] == pytest.approx(11 / 3)
    assert got[0][5] == "2024-01-01 ~ 2024-01-02"
    assert got[1] == ("b", 0, 1, 1, 9.0, "2023-05-05 ~ 2023-05-05")


def test_dataset_summary_size(spark):
    df = spark.range(1000).select(F.lit("2024-01-01").cast("date").alias("d"))
    big = stats.dataset_summary({"x": (df, "d")}).first()
    assert (big.data_type, big.total_rows, big.size_gb) == ("x", 1000, 0.0)
    assert round(8_674_611 * stats.BYTES_PER_ROW / 1024**3, 2) == 1.62


def test_text_quality(spark):
    df = spark.createDataFrame([(None,), ("",), ("abc",), ("x" * 11,)], "t string")
    got = stats.text_quality(df, "t", name="c", max_length=10).first()
    assert tuple(got) == ("c", 1, 1, 1)


def test_histogram_of_one_value_and_of_a_group(spark):
    same = spark.createDataFrame([(5.0,)] * 4, "x double")
    assert rows(stats.histogram(same, "x", 10)) == [(0, 5.0, 5.0, 4)]
    df = spark.createDataFrame([(0.0, "a"), (1.0, "a"), (0.99, "b"), (None, "b")], "x double, g string")
    got = rows(stats.histogram(df, "x", 2, by="g").select("g", "bin", "n"))
    assert got == [("a", 0, 1), ("a", 1, 1), ("b", 1, 1)]


def test_unique_counts(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (2, None)], "i int, s string")
    assert tuple(stats.unique_counts(df, {"i": "ni", "s": "ns"}).first()) == (2, 1)
    assert tuple(stats.unique_counts(df, {"i": "ni", "s": "ns"}, approximate=True).first()) == (2, 1)


def test_length_bins(spark):
    df = spark.createDataFrame([(n,) for n in (0, 99, 100, 500, 501)], "n int")
    got = [r[0] for r in df.select(engagement.length_bin("n")).collect()]
    assert got == ["short_<100", "short_<100", "medium_100_500", "medium_100_500", "long_>500"]


def test_split_at_quantile_edges(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "num_comments int")
    got = {r[0]: r[1] for r in engagement.split_at_quantile(df).collect()}
    assert got == {1: "low", 2: "high", 3: "high", None: "low"}
    same = spark.createDataFrame([(4,)] * 3, "num_comments int")
    assert {r.engagement for r in engagement.split_at_quantile(same).collect()} == {"high"}
    sketch = engagement.split_at_quantile(df, exact=False)
    assert {r[0]: r[1] for r in sketch.collect()} == got


def test_topic_growth_without_an_earlier_year(spark):
    df = spark.sql("SELECT 'a' topic_label, timestamp'2024-02-01 00:00:00' created")
    got = engagement.topic_year_growth(df, [2023, 2024]).first()
    assert (got.n_2023, got.n_2024, got.growth_2024) == (0, 1, None)


def test_spearman_against_plain_python(spark):
    pick = random.Random(5)
    pairs = [(pick.choice([-1, 0, 0, 0, 1]), pick.randrange(20)) for _ in range(400)]
    df = spark.createDataFrame(pairs, "x int, y int")

    def ranks(values):
        ordered = sorted(values)
        return [ordered.index(v) + (ordered.count(v) + 1) / 2 for v in values]

    expected = statistics.correlation(ranks([p[0] for p in pairs]), ranks([p[1] for p in pairs]))
    assert engagement.spearman(df, "x", "y").first()[0] == pytest.approx(expected)
    got = engagement.sentiment_correlation(df, "x", ["y"]).first()
    assert got.spearman == pytest.approx(expected)
    assert got.pearson == pytest.approx(statistics.correlation(*map(list, zip(*pairs))))
    assert got.slope == pytest.approx(statistics.linear_regression(*map(list, zip(*pairs))).slope)


def test_month_counts_join_years(spark):
    df = spark.sql(
        "SELECT explode(array(timestamp'2023-06-01 00:00:00', timestamp'2024-06-30 23:00:00')) created"
    )
    assert rows(temporal.month_counts(df)) == [(6, 2)]
    matrix = temporal.heatmap_matrix(df).collect()
    assert [r.day_of_week for r in matrix] == [1, 5]
    assert matrix[0].h23 == 1 and matrix[1].h0 == 1 and matrix[0].h0 == 0


def test_year_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT timestamp_ntz'2021-01-01 00:00:00' t UNION ALL SELECT timestamp_ntz'2022-01-01 00:00:00'").write.parquet(path)
    kept = temporal.in_year(spark.read.parquet(path), "t", 2021)
    assert kept.count() == 1
    assert "GreaterThanOrEqual(t," in plan(kept) and "LessThan(t," in plan(kept)


def test_cross_validation_over_stored_vectors(spark):
    """The chosen strength is the better one, and the model scores raw rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import RegexTokenizer, StandardScaler, VectorAssembler

    draw = F.pmod(F.xxhash64("id"), F.lit(100))
    df = spark.range(400).select("id", (draw / 100).alias("x"), (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(100)) / 100).alias("noise"), F.lit("a b").alias("t"))
    df = df.withColumn("label", (F.col("x") > 0.5).cast("double")).withColumn("weight", F.lit(1.0))
    pipeline = Pipeline(stages=[
        RegexTokenizer(inputCol="t", outputCol="words"),
        VectorAssembler(inputCols=["x", "noise"], outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features"),
        LogisticRegression(labelCol="label", weightCol="weight", elasticNetParam=1.0),
    ])
    model = ml.cross_validate(pipeline, df, "id", reg_params=(5.0, 0.01), folds=2)
    assert model.stages[-1].getRegParam() == 0.01 and len(model.stages) == 4
    assert ml.roc_auc(ml.score(model, df), "probability_positive").first().auc > 0.99


def test_evaluation_scores_every_row_once(spark):
    asked = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def scored(x):
        asked.add(1)
        return x / 10

    df = spark.range(10).selectExpr("double(id) AS x", "double(id > 4) AS label", "double(id > 5) AS prediction")
    got = ml.evaluate_binary(df.withColumn("probability_positive", scored("x")), "test").first()
    assert (got.split, got.n, got.accuracy, got.auc) == ("test", 10, 0.9, 1.0)
    assert asked.value == 10


def test_known_logistic(spark):
    df = spark.createDataFrame([(1, 2.0, 1.0), (2, 0.0, 0.0)], "id int, a double, b double")
    got = {r.id: r.probability_positive for r in ml.score(ml.known_logistic(spark, ["a", "b"], [1.0, -2.0], 0.5), df).collect()}
    assert got[1] == pytest.approx(1 / (1 + 2.718281828 ** -0.5)) and got[2] == pytest.approx(1 / (1 + 2.718281828 ** -0.5))
