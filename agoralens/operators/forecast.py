"""Daily volume: series, features, models, comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window as W, WindowSpec, functions as F

from agoralens.functions.calendar import SATURDAY_AND_SUNDAY, is_weekend, year_angle
from agoralens.operators.split import assign_fold

TARGET = "n_posts"
LAGS = (1, 2, 3, 7, 14, 21, 28)
MEAN_DAYS = (7, 14, 30)
SPREAD_DAYS = (7, 14)
# Names of the daily features, in the order of the models' inputs.
FEATURES = (
    "day_of_week", "month", "day_of_year", "is_weekend",
    *[f"lag_{k}" for k in LAGS],
    *[f"rolling_mean_{d}" for d in MEAN_DAYS],
    *[f"rolling_std_{d}" for d in SPREAD_DAYS],
    "fourier_sin_1", "fourier_cos_1",
)


def daily_counts(df: DataFrame, created: str = "created", by: Sequence[str] = ()) -> DataFrame:
    """Rows per calendar day, per group if `by` is given. Everything below works on this table."""
    return df.groupBy(*by, F.to_date(created).alias("date")).agg(F.count("*").alias(TARGET))


def with_missing_days(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add the days without rows between first and last day, with count 0."""
    days = daily.groupBy(*by).agg(F.min("date").alias("first"), F.max("date").alias("last"))
    days = days.select(*by, F.explode(F.sequence("first", "last")).alias("date"))
    return days.join(daily, [*by, "date"], "left").fillna(0, subset=[TARGET])


def _by_day(by: Sequence[str]) -> WindowSpec:
    # A day-level table has one row per day and group, so this order is over thousands of rows.
    return W.partitionBy(*by).orderBy("date")


def add_calendar(daily: DataFrame, weekend: tuple[int, ...] = SATURDAY_AND_SUNDAY) -> DataFrame:
    """Weekday, month, day of year, weekend flag and one pair of yearly season terms."""
    angle = year_angle("date")
    return daily.withColumns(
        {
            "day_of_week": F.dayofweek("date"),
            "month": F.month("date"),
            "day_of_year": F.dayofyear("date"),
            "is_weekend": is_weekend(F.dayofweek("date"), weekend),
            "fourier_sin_1": F.sin(angle),
            "fourier_cos_1": F.cos(angle),
        }
    )


def add_lags(daily: DataFrame, lags: Sequence[int] = LAGS, by: Sequence[str] = ()) -> DataFrame:
    """`lag_k`: the value k rows earlier. Fill missing days first to make rows calendar days."""
    return daily.withColumns({f"lag_{k}": F.lag(TARGET, k).over(_by_day(by)) for k in lags})


def add_rolling(
    daily: DataFrame, *, include_current: bool = True, by: Sequence[str] = ()
) -> DataFrame:
    """Rolling means and sample deviations. A forecast must not include the day it predicts."""
    last = 0 if include_current else -1

    def frame(days: int) -> WindowSpec:
        return _by_day(by).rowsBetween(last - days + 1, last)

    return daily.withColumns(
        {f"rolling_mean_{d}": F.avg(TARGET).over(frame(d)) for d in MEAN_DAYS}
        | {f"rolling_std_{d}": F.stddev_samp(TARGET).over(frame(d)) for d in SPREAD_DAYS}
    )


def daily_features(
    daily: DataFrame,
    *,
    include_current: bool = False,
    weekend: tuple[int, ...] = SATURDAY_AND_SUNDAY,
    by: Sequence[str] = (),
) -> DataFrame:
    """All features; days whose history is too short are left out."""
    out = add_rolling(add_lags(add_calendar(daily, weekend), by=by), include_current=include_current, by=by)
    return out.dropna(subset=list(FEATURES)).select(*by, "date", TARGET, *FEATURES)


def _regression(stage, features: Sequence[str]) -> Pipeline:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="raw_features"),
            StandardScaler(
                inputCol="raw_features", outputCol="features", withMean=True, withStd=True
            ),
            stage,
        ]
    )


def estimators(features: Sequence[str] = FEATURES, seed: int = 42) -> dict[str, Pipeline]:
    # Model settings.
    common = {"featuresCol": "features", "labelCol": TARGET}
    return {
        name: _regression(stage, features)
        for name, stage in {
            "RandomForestRegressor": RandomForestRegressor(
                numTrees=200, maxDepth=10, seed=seed, **common
            ),
            "RidgeRegression": LinearRegression(regParam=0.1, elasticNetParam=0.0, **common),
            "ElasticNet": LinearRegression(regParam=0.1, elasticNetParam=0.5, **common),
            "GBTRegressor": GBTRegressor(maxIter=50, maxDepth=5, seed=seed, **common),
        }.items()
    }


def tune_forest(
    train: DataFrame,
    features: Sequence[str] = FEATURES,
    depths: Sequence[int] = (8, 10, 12),
    trees: Sequence[int] = (100, 200),
    folds: int = 3,
    parallelism: int = 2,
) -> PipelineModel:
    """Random forest chosen by cross-validated error, folds by date."""
    pipeline = estimators(features)["RandomForestRegressor"]
    forest = pipeline.getStages()[-1]
    grid = (
        ParamGridBuilder()
        .addGrid(forest.maxDepth, list(depths))
        .addGrid(forest.numTrees, list(trees))
        .build()
    )
    validator = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=grid,
        evaluator=RegressionEvaluator(labelCol=TARGET, metricName="rmse"),
        numFolds=folds,
        parallelism=parallelism,
        foldCol="fold",
    )
    return validator.fit(assign_fold(train, "date", folds)).bestModel


def fit_models(
    train: DataFrame, features: Sequence[str] = FEATURES, *, tune: bool = False, seed: int = 42
) -> dict[str, PipelineModel]:
    """Fit every model on training and validation days; `tune` searches the forest's grid."""
    models = {}
    for name, pipeline in estimators(features, seed).items():
        if tune and name == "RandomForestRegressor":
            models[name] = tune_forest(train, features)
        else:
            models[name] = pipeline.fit(train)
    return models


def predictions(models: Mapping[str, PipelineModel], test: DataFrame) -> DataFrame:
    """Actual and predicted value per day and model."""
    parts = [
        model.transform(test).select(F.lit(name).alias("model"), "date", TARGET, "prediction")
        for name, model in models.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def compare_models(predicted: DataFrame) -> DataFrame:
    """rmse, mae and r2 per model in one aggregation, lowest rmse first."""
    error = F.col("prediction") - F.col(TARGET)
    spread = F.var_pop(TARGET) * F.count(TARGET)
    return (
        predicted.groupBy("model")
        .agg(
            F.sqrt(F.avg(error * error)).alias("rmse"),
            F.avg(F.abs(error)).alias("mae"),
            (F.lit(1.0) - F.try_divide(F.sum(error * error), spread)).alias("r2"),
        )
        .orderBy("rmse", "model")
    )
