import datetime as dt

import pytest
from pyspark.sql import functions as F

from agoralens.operators import forecast
from tests.conftest import rows


def series(spark, days=120):
    start = F.lit("2024-01-01").cast("date")
    day = F.col("id").cast("int")
    return spark.range(days).select(
        F.date_add(start, day).alias("date"), (F.lit(20) + day % 7 * 5 + F.pmod(day * 13, F.lit(4))).cast("long").alias("n_posts")
    )


def test_daily_counts_and_missing_days(spark):
    df = spark.sql(
        "SELECT explode(array(timestamp'2024-01-01 01:00:00', timestamp'2024-01-01 02:00:00', timestamp'2024-01-03 00:00:00')) created"
    )
    daily = forecast.daily_counts(df)
    d = dt.date
    assert rows(daily) == [(d(2024, 1, 1), 2), (d(2024, 1, 3), 1)]
    assert rows(forecast.with_missing_days(daily)) == [(d(2024, 1, 1), 2), (d(2024, 1, 2), 0), (d(2024, 1, 3), 1)]


def test_groups_are_separate_series(spark):
    df = series(spark, 10).withColumn("g", F.explode(F.array(F.lit("a"), F.lit("b"))))
    lagged = forecast.add_lags(df, [1], by=["g"])
    assert lagged.where("lag_1 IS NULL").count() == 2
    filled = forecast.with_missing_days(df.where("NOT (g = 'a' AND n_posts = 21)"), ["g"])
    assert filled.groupBy("g").count().where("count = 10").count() == 2


def test_lags_and_frames(spark):
    daily = series(spark, 40)
    values = [r.n_posts for r in daily.orderBy("date").collect()]
    lagged = forecast.add_lags(daily).orderBy("date").collect()
    assert lagged[28].lag_28 == values[0] and lagged[27].lag_28 is None and lagged[9].lag_7 == values[2]
    with_day = forecast.add_rolling(daily).orderBy("date").collect()
    assert with_day[9].rolling_mean_7 == pytest.approx(sum(values[3:10]) / 7)
    assert with_day[0].rolling_std_7 is None
    before = forecast.add_rolling(daily, include_current=False).orderBy("date").collect()
    assert before[9].rolling_mean_7 == pytest.approx(sum(values[2:9]) / 7)
    assert before[0].rolling_mean_7 is None


def test_constant_series_has_no_spread(spark):
    flat = series(spark, 40).withColumn("n_posts", F.lit(5).cast("long"))
    got = forecast.daily_features(flat)
    assert got.count() == 12 and {r.rolling_std_7 for r in got.collect()} == {0.0}


def test_weekend_is_a_parameter(spark):
    friday = spark.sql("SELECT date'2024-01-05' date, 1L n_posts")
    assert forecast.add_calendar(friday).first().is_weekend == 0
    assert forecast.add_calendar(friday, (6, 7)).first().is_weekend == 1


def test_models_beat_the_mean_on_a_weekly_pattern(spark):
    features = forecast.daily_features(series(spark)).coalesce(1).cache()
    train, test = features.where("date < '2024-04-15'"), features.where("date >= '2024-04-15'")
    models = {n: p.fit(train) for n, p in forecast.estimators().items() if n != "GBTRegressor"}
    table = forecast.compare_models(forecast.predictions(models, test)).collect()
    assert [r.rmse for r in table] == sorted(r.rmse for r in table)
    assert table[0].r2 > 0.5 and table[0].mae <= table[0].rmse
    features.unpersist()


def test_forest_tuning(spark):
    features = forecast.daily_features(series(spark, 60)).coalesce(1).cache()
    model = forecast.tune_forest(features, depths=(2, 3), trees=(3,), folds=2)
    assert model.stages[-1].getNumTrees == 3
    features.unpersist()
