"""Daily volume of posts and its forecast on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralens.operators import forecast, ml, regression, split
from agoralens.plans import roles
from agoralens.plans.overview import settled
from agoralens.plans.registry import question
from agoralens.sources.scratch import stored

_DAILY = "daily AS (SELECT o_orderdate::date AS date, count(*) AS n_posts FROM orders GROUP BY 1)"
_FILLED = """filled AS (
  SELECT d.date, coalesce(n_posts, 0) AS n_posts
  FROM (SELECT unnest(generate_series((SELECT min(date) FROM daily), (SELECT max(date) FROM daily),
                                      INTERVAL 1 DAY))::date AS date) d LEFT JOIN daily USING (date))"""


def _features_sql(source: str, last: int, *, rounded: bool = True) -> str:
    def cut(value: str) -> str:
        return f"round({value} + 1e-9, 6)" if rounded else value

    lags = ", ".join(f"lag(n_posts, {k}) OVER w AS lag_{k}" for k in forecast.LAGS)

    def frame(days: int) -> str:
        bound = "CURRENT ROW" if last == 0 else "1 PRECEDING"
        return f"(ORDER BY date ROWS BETWEEN {days - 1 - last} PRECEDING AND {bound})"

    means = ", ".join(
        f"{cut(f'avg(n_posts) OVER {frame(d)}')} AS rolling_mean_{d}" for d in forecast.MEAN_DAYS
    )
    spreads = ", ".join(
        f"{cut(f'stddev_samp(n_posts) OVER {frame(d)}')} AS rolling_std_{d}"
        for d in forecast.SPREAD_DAYS
    )
    return f"""features AS (
  SELECT * FROM (
    SELECT date, n_posts, (dayofweek(date) + 1)::int AS day_of_week, month(date)::int AS month,
           dayofyear(date)::int AS day_of_year, (dayofweek(date) IN (0, 6))::int AS is_weekend,
           {lags}, {means}, {spreads},
           {cut("sin(2 * pi() * dayofyear(date) / 365.0)")} AS fourier_sin_1,
           {cut("cos(2 * pi() * dayofyear(date) / 365.0)")} AS fourier_cos_1
    FROM {source} WINDOW w AS (ORDER BY date))
  WHERE lag_28 IS NOT NULL)"""


_ROUNDED = [c for c in forecast.FEATURES if c.startswith(("rolling", "fourier"))]


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.daily_counts(roles.bare_posts(spark, sf_dir))


@question(f"WITH {_DAILY} SELECT * FROM daily")
def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir)


@question(f"WITH {_DAILY}, {_features_sql('daily', 0)} SELECT * FROM features")
def daily_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags by row and rolling frames that include the day itself."""
    return settled(forecast.daily_features(_daily(spark, sf_dir), include_current=True), 6, *_ROUNDED)


def _forecast_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags by calendar day and rolling frames that end the day before."""
    return forecast.daily_features(forecast.with_missing_days(_daily(spark, sf_dir)))


@question(f"WITH {_DAILY}, {_FILLED}, {_features_sql('filled', -1)} SELECT * FROM features")
def daily_forecast_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(_forecast_features(spark, sf_dir), 6, *_ROUNDED)


@question(f"""
WITH {_DAILY}, {_FILLED}, {_features_sql('filled', -1)},
placed AS (SELECT date, row_number() OVER (ORDER BY date) AS r, count(*) OVER () AS n FROM features)
SELECT date, CASE WHEN r <= floor(n * 0.7) THEN 'train' WHEN r <= floor(n * 0.85) THEN 'validation'
                  ELSE 'test' END AS split
FROM placed""")
def chronological_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = split.chronological_split(_forecast_features(spark, sf_dir))
    return out.select("date", "split")


def _parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and validation days together, and test days. Day-level, written once."""
    days = stored(split.chronological_split(_forecast_features(spark, sf_dir)))
    names = F.col("split")
    train = days.where(names == "train").unionByName(days.where(names == "validation"))
    return train, days.where(names == "test")


@question()
def forecast_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _parts(spark, sf_dir)
    return forecast.compare_models(forecast.predictions(forecast.fit_models(train), test))


@question()
def forecast_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _parts(spark, sf_dir)
    fitted = forecast.estimators()["RandomForestRegressor"].fit(train).stages[-1]
    return ml.importances_table(spark, forecast.FEATURES, fitted.featureImportances.toArray())


# ---- linear models from sufficient statistics ------------------------------------------------

_SIZE = len(forecast.FEATURES)
_X = "[" + ", ".join(f"{c}::DOUBLE" for c in forecast.FEATURES) + "]"
#: Days with features as lists: `x`, the target `y`, `split` and `fold`.
_DAYS = f"""{_DAILY}, {_FILLED}, {_features_sql('filled', -1, rounded=False)},
days AS (
  SELECT date, {_X} AS x, n_posts::DOUBLE AS y,
    ('0x' || substr(md5(date::varchar || 'f42'), 1, 8))::bigint % 3 AS fold,
    CASE WHEN r <= floor(n * 0.85) THEN 'train' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY date) AS r, count(*) OVER () AS n FROM features))"""


def _systems_sql(sets: str) -> str:
    """Standardised normal equations per set of rows: `g` (correlations) and `q` (with the target), means
    and deviations. `sets` gives (`part`, `x`, `y`)."""
    return f"""
sets AS ({sets}),
columns AS (SELECT part, i, avg(v[i]) AS mean, stddev_pop(v[i]) AS spread
  FROM (SELECT part, list_append(x, y) AS v FROM sets), range(1, {_SIZE + 2}) r(i) GROUP BY 1, 2),
scales AS (SELECT part, list(mean ORDER BY i) AS mean, list(spread ORDER BY i) AS spread FROM columns GROUP BY 1),
scaled AS (SELECT part, list_transform(list_append(x, y), lambda e, i: (e - mean[i]) / spread[i]) AS z FROM sets JOIN scales USING (part)),
cells AS (SELECT part, i, j, avg(z[i] * z[j]) AS c FROM scaled, range(1, {_SIZE + 1}) a(i), range(1, {_SIZE + 2}) b(j) GROUP BY 1, 2, 3),
lines AS (SELECT part, i, list(c ORDER BY j) FILTER (j <= {_SIZE}) AS line, max(c) FILTER (j > {_SIZE}) AS q FROM cells GROUP BY 1, 2),
systems AS (SELECT part, list(line ORDER BY i) AS g, list(q ORDER BY i) AS q FROM lines GROUP BY 1)"""


def _ridge_sql(regs: str) -> str:
    """Coefficients `b` on standardised columns per part and `reg`, by elimination."""
    return f"""
solved AS (
  SELECT part, reg, 1 AS k, list_transform(g, lambda line, i: list_append(
      list_transform(line, lambda c, j: CASE WHEN i = j THEN c + reg / spread[{_SIZE + 1}] ELSE c END), q[i])) AS m
  FROM systems JOIN scales USING (part), (SELECT unnest([{regs}])::DOUBLE AS reg)
  UNION ALL
  SELECT part, reg, k + 1, list_transform(m, lambda line, i: CASE WHEN i = k
      THEN list_transform(line, lambda c: c / m[k][k])
      ELSE list_transform(line, lambda c, j: c - line[k] / m[k][k] * m[k][j]) END)
  FROM solved WHERE k <= {_SIZE}),
fitted AS (SELECT part, reg, list_transform(m, lambda line: line[{_SIZE + 1}]) AS b FROM solved WHERE k = {_SIZE + 1})"""


def _net_sql(reg: float, mix: float, sweeps: int = 2_000) -> str:
    """The same by coordinate descent: every element of a long list is one step at one coordinate."""
    return f"""
fitted AS (
  SELECT part, {reg}::DOUBLE AS reg, list_reduce(
    list_prepend(list_transform(q, lambda e: 0.0::DOUBLE), list_transform(range({sweeps} * {_SIZE}), lambda s: [s % {_SIZE} + 1.0::DOUBLE])),
    lambda b, step: list_transform(b, lambda e, i: CASE WHEN i <> step[1] THEN e ELSE
      sign(q[i] - list_dot_product(g[i], b) + g[i][i] * e)
      * greatest(abs(q[i] - list_dot_product(g[i], b) + g[i][i] * e) - {mix} * {reg} / spread[{_SIZE + 1}], 0)
      / (g[i][i] + (1 - {mix}) * {reg} / spread[{_SIZE + 1}]) END)) AS b
  FROM systems JOIN scales USING (part))"""


_PREDICTED = (
    f"mean[{_SIZE + 1}] + list_sum(list_transform(x, lambda e, i: b[i] * (e - mean[i]) / spread[i])) * spread[{_SIZE + 1}]"
)
_TRAIN = "SELECT 0 AS part, x, y FROM days WHERE split = 'train'"
# The penalties of the two linear models, and those tried for the grid.
RIDGE, NET = (0.1, 0.0), (0.1, 0.5)
GRID = tuple((reg, 0.0) for reg in (0.01, 0.1, 1.0, 10.0))


@question(f"""
WITH {_DAYS},
rows AS (SELECT fold, [1.0::DOUBLE] || x || [y] AS v FROM days WHERE split = 'train')
SELECT fold::INT AS fold, i::INT AS i, j::INT AS j, round(sum(v[i + 1] * v[j + 1]) + 1e-9, 3) AS value
FROM rows, range({_SIZE + 2}) a(i), range({_SIZE + 2}) b(j) WHERE i <= j GROUP BY 1, 2, 3""")
def forecast_fold_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of products per fold, all that linear models and their cross-validation read."""
    train, _ = _parts(spark, sf_dir)
    folds = split.assign_fold(train, "date")
    return settled(regression.fold_moments(folds, forecast.FEATURES, forecast.TARGET, "fold"), 3, "value")


@question(f"""
WITH RECURSIVE {_DAYS}, {_systems_sql(_TRAIN)}, {_ridge_sql(str(RIDGE[0]))}
SELECT 'RidgeRegression' AS model, date, y::BIGINT AS n_posts, round({_PREDICTED} + 1e-9, 5) AS prediction
FROM days, fitted JOIN scales USING (part) WHERE split = 'test'""")
def forecast_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual and predicted posts per test day of the ridge model, from one pass over the training days."""
    train, test = _parts(spark, sf_dir)
    model = regression.fit(regression.collect_moments(train, forecast.FEATURES, forecast.TARGET), *RIDGE)
    predicted = test.select(F.lit("RidgeRegression").alias("model"), "date", forecast.TARGET, model.prediction().alias("prediction"))
    return settled(predicted, 5, "prediction").orderBy("date")


@question(f"""
WITH {_DAYS}, {_systems_sql(_TRAIN)}, {_net_sql(*NET)}
SELECT feature, round(c + 1e-9, 5) AS coefficient, abs(c) > 1e-9 AS used FROM (
  SELECT unnest({list(forecast.FEATURES)}) AS feature, unnest(list_transform(b, lambda e, i: e * spread[{_SIZE + 1}] / spread[i])) AS c
  FROM fitted JOIN scales USING (part))""")
def forecast_net_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the elastic net keeps of the features: coefficients that are exactly 0 are not used."""
    train, _ = _parts(spark, sf_dir)
    model = regression.fit(regression.collect_moments(train, forecast.FEATURES, forecast.TARGET), *NET)
    table = ml.coefficients_table(spark, forecast.FEATURES, model.coefficients)
    out = table.select("feature", "coefficient", (F.col("abs_coef") > 1e-9).alias("used"))
    return settled(out, 5, "coefficient")


@question(f"""
WITH RECURSIVE {_DAYS}, {_systems_sql("SELECT f.i AS part, x, y FROM days, range(3) f(i) WHERE split = 'train' AND fold <> f.i")},
{_ridge_sql(", ".join(str(reg) for reg, _ in GRID))}
SELECT part::INT AS fold, reg, 0.0::DOUBLE AS mix, count(*) AS n, round(sqrt(avg(({_PREDICTED} - y) ^ 2)) + 1e-9, 6) AS rmse
FROM fitted JOIN scales USING (part) JOIN days ON days.fold = part AND split = 'train' GROUP BY 1, 2""")
def forecast_ridge_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error of every penalty on every held-out fold, without a pass over the days per model."""
    train, _ = _parts(spark, sf_dir)
    folds = split.assign_fold(train, "date")
    moments = regression.collect_moments(folds, forecast.FEATURES, forecast.TARGET, "fold")
    return settled(regression.grid_table(spark, regression.grid_errors(moments, GRID)), 6, "rmse")
