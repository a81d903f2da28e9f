"""Models with known parameters on the test tables, so that SQL can say what they give."""

from __future__ import annotations

import glob
import os
import zipfile
from functools import cache

import pyspark
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralens.functions.keys import md5_bucket
from agoralens.functions.text import joined_tokens, tokenize, tokens_of
from agoralens.operators import clean, ml, topics
from agoralens.plans import roles
from agoralens.plans.overview import settled
from agoralens.plans.registry import question
from agoralens.sources import tables
from agoralens.sources.scratch import new_folder, stored

# ---- tokens ----------------------------------------------------------------------------------


@question("""
WITH split AS (SELECT doc_id AS id, list_filter(string_split_regex(lower(text), '[^A-Za-z0-9_]+'), lambda w: w <> '') AS tokens
  FROM documents WHERE text IS NOT NULL)
SELECT id, len(tokens)::INT AS n, md5(array_to_string(tokens, ' ')) AS tokens FROM split""")
def topic_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word tokens as topic models take them."""
    posts = roles.post_texts(spark, sf_dir).select("id", F.col("selftext").alias("clean_text"))
    out = topics.word_tokens(posts)
    return out.select("id", F.size("tokens").alias("n"), F.md5(F.array_join("tokens", " ")).alias("tokens"))


@question(f"""
SELECT doc_id AS id, len(tokens)::INT AS n, list_distinct(list_filter(tokens, lambda w: length(w) > 12)).len()::INT AS long_words
FROM (SELECT doc_id, {roles.tokens_sql('text')} AS tokens FROM documents)""")
def split_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of the one-string view, stored joined and split again."""
    posts = roles.post_texts(spark, sf_dir)
    joined = stored(posts.select("id", joined_tokens(tokenize("selftext")).alias("clean_text")), "joined")
    tokens = tokens_of("clean_text")
    return joined.select("id", F.size(tokens).alias("n"), F.size(F.array_distinct(F.filter(tokens, lambda w: F.length(w) > 12))).alias("long_words"))


@cache
def default_stop_words() -> list[str]:
    """Spark's English stop words, read from its jar: SQL is written before there is a session."""
    for jar in glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar")):
        with zipfile.ZipFile(jar) as files:
            return files.read("org/apache/spark/ml/feature/stopwords/english.txt").decode().split("\n")
    return []


_DEFAULTS = ", ".join("'" + w.replace("'", "''") + "'" for w in default_stop_words() if w)


@question(f"""
SELECT doc_id AS id, array_to_string(list_filter({roles.tokens_sql('text')}, lambda w: w NOT IN ({_DEFAULTS})), ' ') AS kept FROM documents""")
def english_words_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without the default stop words."""
    posts = roles.post_texts(spark, sf_dir)
    return posts.select("id", F.array_join(clean.clean_tokens("selftext", stemmed=False), " ").alias("kept"))


# ---- topics ----------------------------------------------------------------------------------

#: Each topic's words, heaviest first; all others weigh next to nothing there.
TOPICS = (("the", "and", "of", "that"), ("der", "und", "die", "zu"), ("que", "le", "des", "et"), ("el", "los", "en", "una"))
_LITTLE = 1e-3
#: Unequal, so that no two topics tie.
_PRIORS = (0.1, 0.11, 0.12, 0.13)
_VOCABULARY = [w for words in TOPICS for w in words]
_WEIGHTS = [[(8.0 - words.index(w)) if w in words else _LITTLE for w in _VOCABULARY] for words in TOPICS]
_HEAVIEST = ", ".join(
    f"({t}, {r + 1}, '{w}', {_WEIGHTS[t][_VOCABULARY.index(w)] / sum(_WEIGHTS[t])!r}::DOUBLE)" for t, words in enumerate(TOPICS) for r, w in enumerate(words)
)


@question(f"""
WITH heaviest(topic, rank, word, weight) AS (VALUES {_HEAVIEST}),
said AS (SELECT unnest({roles.tokens_sql('text')}) AS word FROM documents)
SELECT topic, rank, h.word, round(weight + 1e-9, 6) AS weight, count(s.word) AS said
FROM heaviest h LEFT JOIN said s ON s.word = h.word GROUP BY ALL""")
def known_topic_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of known topics, and how often they are said."""
    model = topics.known_topics(spark, _VOCABULARY, _WEIGHTS)
    words = topics.describe(model, len(TOPICS[0]))
    tokens = roles.post_texts(spark, sf_dir).select(F.explode(tokenize("selftext")).alias("word"))
    said = tokens.where(F.col("word").isin(*_VOCABULARY)).groupBy("word").agg(F.count("*").alias("said"))
    out = words.join(F.broadcast(said), "word", "left").fillna(0, subset=["said"])
    return settled(out, 6, "weight").select("topic", "rank", "word", "weight", "said")


def _shares_sql() -> str:
    counts = ", ".join(
        f"len(list_filter(tokens, lambda w: w IN ({', '.join(repr(w) for w in words)}))) + {prior}::DOUBLE" for words, prior in zip(TOPICS, _PRIORS)
    )
    return f"""
WITH counted AS (SELECT doc_id AS id, [{counts}] AS c FROM (SELECT doc_id, {roles.tokens_sql('text')} AS tokens FROM documents)),
placed AS (SELECT *, list_sum(c) AS n FROM counted)
SELECT id, CASE WHEN n < 0.5 THEN 0 ELSE list_position(c, list_max(c)) - 1 END::INT AS top_topic,
  CASE WHEN n < 0.5 THEN 0.0 ELSE round(list_max(c) / n + 1e-9, 4) END::DOUBLE AS top_share
FROM placed"""


@question(_shares_sql())
def known_topic_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main topic of each document under known topics that share no word: a topic's share follows
    from its words' number."""
    model = topics.known_topics(spark, _VOCABULARY, _WEIGHTS, priors=_PRIORS)
    docs = roles.post_texts(spark, sf_dir).select("id", tokenize("selftext").alias("tokens"))
    out = topics.assign(model, docs).select("id", "top_topic", "top_share")
    return settled(out, 4, "top_share")


# ---- vectors and linear models ---------------------------------------------------------------


@question("""
WITH rows AS (SELECT o_orderkey AS id, o_totalprice AS a, month(o_orderdate)::DOUBLE AS b FROM orders),
s AS (SELECT avg(a) AS ma, avg(b) AS mb, stddev_samp(a) AS sa, stddev_samp(b) AS sb FROM rows)
SELECT id, round(a / sa + 1e-9, 6) AS scaled_a, round(b / sb + 1e-9, 6) AS scaled_b,
  round((a - ma) / sa + 1e-9, 6) AS centred_a, round((b - mb) / sb + 1e-9, 6) AS centred_b FROM rows, s""")
def scaled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assembled features scaled to unit deviation, with and without taking off the mean."""
    posts = roles.bare_posts(spark, sf_dir)
    rows = stored(posts.select("id", F.col("score").alias("a"), F.month("created").cast("double").alias("b")), "rows")
    model = Pipeline(stages=[
        VectorAssembler(inputCols=["a", "b"], outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="scaled", withMean=False, withStd=True),
        StandardScaler(inputCol="raw", outputCol="centred", withMean=True, withStd=True),
    ]).fit(rows)
    out = model.transform(rows)
    columns = {f"{kind}_{name}": vector_to_array(kind)[i] for kind in ("scaled", "centred") for i, name in enumerate("ab")}
    return settled(out.select("id", *[c.alias(n) for n, c in columns.items()]), 6, *columns)


# Coefficients of the known logistic model.
_COEFFICIENTS, _INTERCEPT = (0.8, -0.3), 0.1


@question(f"""
WITH rows AS (SELECT o_orderkey AS id, o_totalprice / 100000 AS price, month(o_orderdate)::DOUBLE AS month FROM orders)
SELECT id, round(p + 1e-9, 8) AS probability_positive, (p > 0.5)::INT::DOUBLE AS prediction
FROM (SELECT id, 1 / (1 + exp(-({_COEFFICIENTS[0]} * price + {_COEFFICIENTS[1]} * month + {_INTERCEPT}))) AS p FROM rows)""")
def saved_logistic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A logistic model of known coefficients, saved, loaded and applied."""
    folder = new_folder(spark, "model")
    ml.save_model(ml.known_logistic(spark, ["price", "month"], _COEFFICIENTS, _INTERCEPT), folder)
    posts = roles.bare_posts(spark, sf_dir)
    rows = posts.select("id", (F.col("score") / 100_000).alias("price"), F.month("created").cast("double").alias("month"))
    scored = ml.score(ml.load_model(folder), rows)
    return settled(scored, 8, "probability_positive").select("id", "probability_positive", "prediction")


def _gini(part: str, whole: str) -> str:
    return f"2 * ({part}) / ({whole}) * (1 - ({part}) / ({whole}))"


@question(f"""
WITH rows AS (SELECT (o_orderpriority IN ('1-URGENT', '2-HIGH'))::INT AS urgent, (o_totalprice > 150000)::INT AS large FROM orders),
n AS (SELECT count(*)::DOUBLE AS n, sum(urgent)::DOUBLE AS a, sum(large)::DOUBLE AS b, sum(urgent * large)::DOUBLE AS ab FROM rows),
gains AS (
  SELECT *, n * {_gini("ab", "n")} - a * {_gini("ab", "a")} AS root_a, a * {_gini("ab", "a")} AS then_b,
    n * {_gini("ab", "n")} - b * {_gini("ab", "b")} AS root_b, b * {_gini("ab", "b")} AS then_a FROM n)
SELECT feature, round(importance + 1e-9, 6) AS importance FROM (
  SELECT unnest(['urgent', 'large', 'noise']) AS feature, unnest(CASE WHEN root_a > root_b
    THEN [root_a / (root_a + then_b), then_b / (root_a + then_b), 0.0] ELSE [then_a / (root_b + then_a), root_b / (root_b + then_a), 0.0] END) AS importance
  FROM gains)""")
def known_tree_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances of a tree that has to find a rule of two conditions: shares of the impurity each takes
    away."""
    posts = roles.bare_posts(spark, sf_dir)
    rows = posts.select(
        F.col("topic").isin("1-URGENT", "2-HIGH").cast("double").alias("urgent"), (F.col("score") > 150_000).cast("double").alias("large"),
        md5_bucket("id", 2, "noise").cast("double").alias("noise"),
    ).withColumn(ml.LABEL, F.col("urgent") * F.col("large"))
    names = ["urgent", "large", "noise"]
    forest = RandomForestClassifier(labelCol=ml.LABEL, numTrees=1, maxDepth=2, featureSubsetStrategy="all", bootstrap=False, seed=1)
    model = Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features"), forest]).fit(stored(rows, "rows"))
    table = ml.importances_table(spark, names, model.stages[-1].featureImportances.toArray())
    return settled(table, 6, "importance")


# ---- files of several layouts ----------------------------------------------------------------


@question("""
SELECT o_orderkey % 2 AS part, count(*) AS n, count(CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END) AS authors,
  round(sum(CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice END) + 1e-9, 2) AS total FROM orders GROUP BY 1""")
def merged_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sets of files with columns of their own, read as one table with all of them."""
    folder = new_folder(spark, "merged")
    orders = roles.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    orders.where("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey").write.parquet(f"{folder}/set=0")
    orders.where("o_orderkey % 2 = 1").select("o_orderkey", "o_totalprice").write.parquet(f"{folder}/set=1")
    rows = tables.read_table(spark, folder, merge_schema=True)
    out = rows.groupBy((F.col("o_orderkey") % 2).alias("part")).agg(
        F.count("*").alias("n"), F.count("o_custkey").alias("authors"), F.sum("o_totalprice").alias("total")
    )
    return settled(out, 2, "total")
