import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from agoralens.operators import regression
from agoralens.operators.split import assign_fold

FEATURES = ("a", "b", "c", "flat")


@pytest.fixture(scope="module")
def sample(spark):
    """Correlated features far from zero, a constant one, NULLs in some rows."""
    draw = np.random.default_rng(5)
    a = draw.normal(1e4, 3, 400)
    b = 0.7 * a + draw.normal(0, 2, 400)
    c = draw.integers(0, 5, 400).astype(float)
    y = 3 * a - 2 * b + 0.5 * c + draw.normal(0, 1, 400)
    rows = [(i, *map(float, r), 2.0) for i, r in enumerate(zip(a, b, c, y))]
    rows += [(400, None, 1.0, 1.0, 1.0, 2.0), (401, 1.0, 1.0, 1.0, None, 2.0)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, y double, flat double")
    return assign_fold(df, "id").repartition(5).cache()


def spark_model(df, reg, mix):
    rows = VectorAssembler(inputCols=["a", "b", "c"], outputCol="x").transform(df.dropna())
    return LinearRegression(featuresCol="x", labelCol="y", regParam=reg, elasticNetParam=mix, tol=1e-12, maxIter=1000).fit(rows)


@pytest.mark.parametrize("reg, mix", [(0.0, 0.0), (0.1, 0.0), (5.0, 0.0), (0.1, 0.5), (0.5, 1.0)])
def test_like_spark(sample, reg, mix):
    theirs = spark_model(sample, reg, mix)
    ours = regression.fit(regression.collect_moments(sample, FEATURES, "y"), reg, mix)
    assert ours.coefficients[:3] == pytest.approx(theirs.coefficients.toArray(), abs=1e-6)
    assert ours.intercept == pytest.approx(theirs.intercept, abs=1e-2)
    assert ours.coefficients[3] == 0.0


def test_errors_without_rows(sample):
    """Held-out errors from sums equal those of predicted rows, for models fitted on the other folds."""
    moments = regression.collect_moments(sample, FEATURES, "y", "fold")
    table = regression.grid_errors(moments, [(0.1, 0.0), (0.1, 0.5)])
    assert len(table) == 6 and sum(r[3] for r in table) == 2 * 400
    for fold, reg, mix, n, rmse in table:
        model = regression.fit(regression.collect_moments(sample.where(F.col("fold") != fold), FEATURES, "y"), reg, mix)
        held = sample.where(F.col("fold") == fold).dropna()
        error = model.prediction() - F.col("y")
        found = held.agg(F.count("*"), F.sqrt(F.avg(error * error))).first()
        assert (n, pytest.approx(rmse, rel=1e-6)) == tuple(found)


def test_best_parameters(sample):
    rows = [(0, 0.1, 0.0, 5, 2.0), (1, 0.1, 0.0, 5, 4.0), (0, 1.0, 0.0, 5, 3.0), (1, 1.0, 0.0, 5, 3.0), (0, 9.0, 0.0, 5, 9.0), (1, 9.0, 0.0, 5, 9.0)]
    assert regression.best_of(rows) == (0.1, 0.0)
    model = regression.cross_validate(sample, FEATURES, "y", "fold", [(1e-6, 0.0), (100.0, 0.0)])
    assert model.coefficients[:3] == pytest.approx([3, -2, 0.5], abs=0.2)


def test_moments_are_one_row_per_fold_and_pair(sample):
    found = regression.fold_moments(sample, FEATURES, "y", "fold")
    assert found.count() == 3 * 21
    ones = {r.fold: r.value for r in found.where("i = 0 AND j = 0").collect()}
    assert sum(ones.values()) == 400


def test_no_rows(spark):
    empty = spark.createDataFrame([], "a double, b double, c double, flat double, y double")
    with pytest.raises(ValueError, match="no rows"):
        regression.fit(regression.collect_moments(empty, FEATURES, "y"))
    with pytest.raises(ValueError, match="features"):
        regression.fold_moments(empty, [f"f{i}" for i in range(500)], "y")


def test_constant_target(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (4.0, 2.0)], "a double, y double")
    model = regression.fit(regression.collect_moments(df, ["a"], "y"), 0.1, 0.5)
    assert (model.intercept, list(model.coefficients)) == (2.0, [0.0])
