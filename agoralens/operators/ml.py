"""Labels, weights, models and their evaluation tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import (
    CountVectorizer,
    RegexTokenizer,
    SQLTransformer,
    StandardScaler,
    StopWordsRemover,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralens.functions.keys import md5_bucket
from agoralens.functions.numbers import ratio
from agoralens.operators.features import COMMENT_FEATURES, COMMENT_ROW_FEATURES, POST_FEATURES
from agoralens.operators.ordering import quantile_value, running_totals
from agoralens.operators.split import FINE, assign_fold
from agoralens.sources.scratch import stored

LABEL = "label"
WEIGHT = "weight"


# ---- labels and balance ----------------------------------------------------------------------

def quantile_label(
    df: DataFrame,
    column: str = "num_comments",
    probability: float = 0.75,
    *,
    exact: bool = True,
    label: str = LABEL,
) -> DataFrame:
    """Label 1.0 at or above the quantile, 0.0 below it and for NULL."""
    border = quantile_value(df, column, probability, exact=exact)
    return df.withColumn(label, F.when(F.col(column) >= border, 1.0).otherwise(0.0))


def _class_sizes(df: DataFrame, label: str) -> DataFrame:
    return df.agg(
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
    )


def _positive_weight(df: DataFrame, label: str):
    """Negatives per positive as a scalar; 1 when a class is empty."""
    both = (F.col("positives") > 0) & (F.col("negatives") > 0)
    weight = F.when(both, ratio(F.col("negatives"), F.col("positives"))).otherwise(1.0)
    return _class_sizes(df, label).select(weight.alias("weight")).scalar()


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """(label, n, weight): positives weigh negatives/positives, negatives 1."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    weight = F.when(F.col(label) == 1, _positive_weight(df, label)).otherwise(1.0)
    return counts.withColumn(WEIGHT, weight)


def with_class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    weight = F.when(F.col(label) == 1, _positive_weight(df, label)).otherwise(1.0)
    return df.withColumn(WEIGHT, weight)


def oversample(df: DataFrame, key: str, label: str = LABEL) -> DataFrame:
    """Repeat positive rows until the classes are about even; the same repeats in every run.

    Each positive appears floor(w) times, and once more for the share of keys that makes up the
    fraction of w, where w is negatives/positives.
    """
    weight = F.greatest(_positive_weight(df, label), F.lit(1.0))
    extra = (md5_bucket(key, FINE, "o") < (weight - F.floor(weight)) * FINE).cast("int")
    copies = F.when(F.col(label) == 1, F.floor(weight).cast("int") + extra).otherwise(1)
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


# ---- models ----------------------------------------------------------------------------------

def engagement_pipeline(
    numeric: Sequence[str] = POST_FEATURES + COMMENT_FEATURES,
    text: str = "clean_text",
    vocabulary: int = 10_000,
    min_docs: int = 20,
) -> Pipeline:
    """Bag of words and numeric features, scaled, into a weighted L2 logistic regression."""
    return Pipeline(
        stages=[
            *_bag_of_words(text, vocabulary, min_docs),
            VectorAssembler(inputCols=[*numeric, "bow"], outputCol="raw_features"),
            StandardScaler(
                inputCol="raw_features", outputCol="features", withMean=False, withStd=True
            ),
            LogisticRegression(
                labelCol=LABEL, weightCol=WEIGHT, maxIter=50, elasticNetParam=0.0, family="binomial"
            ),
        ]
    )


def engagement_forest(
    numeric: Sequence[str] = POST_FEATURES + COMMENT_FEATURES,
    text: str = "clean_text",
    vocabulary: int = 10_000,
    min_docs: int = 20,
    seed: int = 42,
) -> Pipeline:
    """The same features into a random forest, to train on oversampled rows."""
    return Pipeline(
        stages=[
            *_bag_of_words(text, vocabulary, min_docs),
            VectorAssembler(inputCols=[*numeric, "bow"], outputCol="features"),
            RandomForestClassifier(labelCol=LABEL, seed=seed),
        ]
    )


#: Binned values of one partition that tree growing keeps and reads in one task: 400 MB of integers.
TREE_VALUES = 100_000_000


def fit_forest(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """`pipeline.fit`, with the vectors that the trees are grown on in parts of bounded size.

    Trees are grown on dense rows of one integer per feature, kept by partition, so a partition of
    sparse vectors may be a hundred times larger there. Tables whose parts are small enough stay as
    they lie, as the forest draws its rows by partition.
    """
    *stages, forest = pipeline.getStages()
    made = Pipeline(stages=stages).fit(train)
    vectors = made.transform(train).select(forest.getLabelCol(), forest.getFeaturesCol())
    one = vectors.first()
    parts = -(-train.count() * (one[1].size if one else 0) // TREE_VALUES)
    if parts > vectors.rdd.getNumPartitions():
        vectors = vectors.repartition(parts)
    return PipelineModel([*made.stages, forest.fit(vectors)])


def _bag_of_words(text: str, vocabulary: int, min_docs: int) -> list:
    return [
        RegexTokenizer(
            inputCol=text, outputCol="words", pattern=r"\W+", minTokenLength=2, toLowercase=True
        ),
        StopWordsRemover(inputCol="words", outputCol="kept_words"),
        CountVectorizer(
            inputCol="kept_words", outputCol="bow", vocabSize=vocabulary, minDF=float(min_docs)
        ),
    ]


def controversy_pipeline(
    features: Sequence[str] = COMMENT_ROW_FEATURES, *, trees: bool = False, seed: int = 42
) -> Pipeline:
    """Comment features into a logistic regression, or a random forest for importances."""
    # A missing feature, as of a comment without a body, counts as 0, so every row is trained on and scored.
    filled = ", ".join(f"coalesce(double(`{f}`), 0D) AS `filled_{f}`" for f in features)
    fill = SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")
    assembler = VectorAssembler(inputCols=[f"filled_{f}" for f in features], outputCol="features")
    if trees:
        model = RandomForestClassifier(labelCol=LABEL, seed=seed)
    else:
        model = LogisticRegression(labelCol=LABEL)
    return Pipeline(stages=[fill, assembler, model])


def cross_validate(
    pipeline: Pipeline,
    train: DataFrame,
    key: str,
    reg_params: Sequence[float] = (0.01, 0.1),
    folds: int = 3,
) -> PipelineModel:
    """Best model by area under ROC over a grid of regularisation strengths, folds by key.

    Tokens are made once. Vocabulary and scaler are fitted once per fold, on its training rows only, and
    the fold's vectors are stored, so that only the regression is fitted once per fold and strength.
    """
    *stages, regression = pipeline.getStages()
    first = next((n for n, stage in enumerate(stages) if not isinstance(stage, Transformer)), len(stages))
    tokens, fitted = stages[:first], stages[first:]
    rows = stored(PipelineModel(tokens).transform(assign_fold(train, key, folds)), "tokens")
    features, weight = regression.getFeaturesCol(), regression.getWeightCol() if regression.isDefined(regression.weightCol) else None
    columns = [regression.getLabelCol(), *([weight] if weight else []), features]
    grid = ParamGridBuilder().addGrid(regression.regParam, list(reg_params)).build()
    evaluator = BinaryClassificationEvaluator(labelCol=regression.getLabelCol(), metricName="areaUnderROC")

    def vectors(model: PipelineModel, part: DataFrame) -> DataFrame:
        return stored(model.transform(part).select(*columns, "fold"), "vectors")

    areas = [0.0] * len(grid)
    for fold in range(folds):
        inside = rows.where(F.col("fold") != fold)
        made = vectors(Pipeline(stages=fitted).fit(inside), rows)
        learned = dict(regression.fitMultiple(made.where(F.col("fold") != fold), grid))
        held = made.where(F.col("fold") == fold)
        for n, model in learned.items():
            areas[n] += evaluator.evaluate(model.transform(held))
    best = max(range(len(grid)), key=lambda n: (areas[n], -n))
    whole = Pipeline(stages=fitted).fit(rows)
    model = regression.fit(vectors(whole, rows), grid[best])
    return PipelineModel([*tokens, *whole.stages, model])


def known_logistic(spark: SparkSession, features: Sequence[str], coefficients: Sequence[float], intercept: float) -> PipelineModel:
    """A logistic model of given coefficients, such as those of a report, to score or save."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    vector = _py2java(spark.sparkContext, Vectors.dense(list(coefficients)))
    java = spark.sparkContext._jvm.org.apache.spark.ml.classification.LogisticRegressionModel("known", vector, float(intercept))
    return PipelineModel([assembler, LogisticRegressionModel(java)])


def score(model: Model, df: DataFrame, name: str = "probability_positive") -> DataFrame:
    """Apply a model and unpack the probability of the positive class."""
    return model.transform(df).withColumn(name, F.get(vector_to_array("probability"), F.lit(1)))


def top_scored(
    scored: DataFrame, columns: Sequence[str], by: str, tie: str = "id", k: int = 500
) -> DataFrame:
    """The k rows with the highest score; equal scores in key order. No full sort."""
    return scored.select(*columns).orderBy(F.desc(by), F.asc(tie)).limit(k)


def scored_sample(scored: DataFrame, columns: Sequence[str], key: str, n: int = 1_000) -> DataFrame:
    """n rows for a report, those with the smallest md5 of their key: the same in every run."""
    order = [F.md5(F.col(key).cast("string")), F.col(key)]
    return scored.orderBy(*order).limit(n).select(*columns)


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ---- evaluation ------------------------------------------------------------------------------

def confusion_matrix(
    predicted: DataFrame, label: str = LABEL, prediction: str = "prediction"
) -> DataFrame:
    return predicted.groupBy(label, prediction).agg(F.count("*").alias("count"))


def binary_metrics(
    predicted: DataFrame, label: str = LABEL, prediction: str = "prediction"
) -> DataFrame:
    """One row in one pass: accuracy, precision, recall, F1 of the positive class and the F1 that
    weighs both classes by size."""
    y, p = F.col(label), F.col(prediction)
    cells = predicted.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn

    def f1(hit, wrong, missed):
        return F.coalesce(ratio(2 * hit, 2 * hit + wrong + missed), F.lit(0.0))

    return cells.select(
        total.alias("n"),
        ratio(tp + tn, total).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        f1(tp, fp, fn).alias("f1_positive"),
        ratio((tp + fn) * f1(tp, fp, fn) + (tn + fp) * f1(tn, fn, fp), total).alias("f1"),
    )


def _by_threshold(scored: DataFrame, score_col: str, label: str) -> DataFrame:
    counted = (
        scored.where(F.col(score_col).isNotNull())
        .groupBy(F.col(score_col).alias("threshold"))
        .agg(
            F.count_if(F.col(label) == 1).alias("p"),
            F.count_if(F.col(label) == 0).alias("n"),
        )
    )
    return running_totals(counted, "threshold", ["p", "n"], descending=True)


def roc_points(scored: DataFrame, score_col: str, label: str = LABEL) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, and the start (infinity, 0, 0)."""
    run = _by_threshold(scored, score_col, label)
    points = run.select(
        F.col("threshold").cast("double").alias("threshold"),
        ratio(F.col("before_n") + F.col("n"), F.col("total_n")).alias("fpr"),
        ratio(F.col("before_p") + F.col("p"), F.col("total_p")).alias("tpr"),
    )
    start = scored.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(points)


def roc_auc(scored: DataFrame, score_col: str, label: str = LABEL) -> DataFrame:
    """One row: exact area under the ROC curve by trapezoids, ties included."""
    run = _by_threshold(scored, score_col, label)
    area = F.col("n") * (F.col("before_p") + F.col("p") / F.lit(2.0))
    whole = F.max(F.col("total_p").cast("double") * F.col("total_n"))
    return run.agg(F.try_divide(F.sum(area), whole).alias("auc"))


def evaluate_binary(
    predicted: DataFrame, split: str, score_col: str = "probability_positive", label: str = LABEL
) -> DataFrame:
    """One row of metrics for a scored split.

    What the model says is stored, as the curve takes several passes and each would score all rows anew.
    """
    scored = stored(predicted.select(*dict.fromkeys([label, "prediction", score_col])), "scored")
    return binary_metrics(scored, label).select(
        F.lit(split).alias("split"), "*", roc_auc(scored, score_col, label).scalar().alias("auc")
    )


def majority_baseline(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Predict the more frequent class everywhere, with one constant score."""
    often = _class_sizes(df, label).select(
        (F.col("positives") > F.col("negatives")).cast("double").alias("often")
    )
    return df.withColumns({"prediction": often.scalar(), "probability_positive": often.scalar()})


def coefficients_table(
    spark: SparkSession, features: Sequence[str], coefficients: Sequence[float]
) -> DataFrame:
    """Coefficients of a linear model, largest absolute value first."""
    rows = [(name, float(c), abs(float(c))) for name, c in zip(features, coefficients)]
    table = spark.createDataFrame(rows, "feature string, coefficient double, abs_coef double")
    return table.orderBy(F.desc("abs_coef"), "feature")


def importances_table(
    spark: SparkSession, features: Sequence[str], importances: Sequence[float]
) -> DataFrame:
    """Feature importances of a tree model, largest first."""
    rows = [(name, float(v)) for name, v in zip(features, importances)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")
