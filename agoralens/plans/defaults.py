"""Documented defaults as a whole, and operators behind models, on inputs with a known answer."""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralens.functions.text import each_word, tokenize
from agoralens.operators import clean, emotion, engagement, forecast, ml, split, topics
from agoralens.plans import roles
from agoralens.plans.forecasts import _DAILY, _FILLED, _features_sql, _forecast_features
from agoralens.plans.models import _WITH_SCORED, _labelled
from agoralens.plans.overview import settled
from agoralens.plans.registry import question
from agoralens.plans.texts import stem_list_sql
from agoralens.sources import tables
from agoralens.sources.scratch import new_folder, stored

# ---- forum pipeline --------------------------------------------------------------------------


@question(f"""
{roles.with_tables(roles.LEXICON)},
stems AS (SELECT DISTINCT {stem_list_sql('[word]')}[1] AS word, emotion FROM lexicon),
docs AS (SELECT doc_id AS id, unnest({stem_list_sql(roles.tokens_sql('text'))}) AS word FROM documents)
SELECT id, emotion, count(*) AS emotion_count FROM docs JOIN stems USING (word) GROUP BY 1, 2""")
def stemmed_emotion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stemmed tokens matched with a stemmed lexicon that was stored as a delimited file."""
    folder = new_folder(spark, "lexicon")
    words = roles.lexicon(spark, sf_dir).select("word", "emotion", F.lit("1").alias("value"))
    words.write.csv(folder, sep="\t")
    lexicon = emotion.stem_lexicon(tables.read_lexicon(spark, folder))
    docs = roles.documents(spark, sf_dir).select(
        F.col("doc_id").alias("id"), clean.clean_tokens("text", stop_words=()).alias("tokens")
    )
    return emotion.counts(docs, lexicon)


_RULE_CASES = " ".join(
    f"WHEN regexp_matches(lower(title), '{pattern}') THEN '{label}'" for label, pattern in engagement.TOPIC_RULES
)


@question(f"""
{roles.with_tables(roles.POST_TEXTS)}
SELECT topic, count(*) AS n FROM (
  SELECT CASE {_RULE_CASES} ELSE '{engagement.DEFAULT_TOPIC}' END AS topic FROM post_texts) GROUP BY 1""")
def default_topic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default topic rules on titles."""
    posts = roles.post_texts(spark, sf_dir).select(engagement.classify("title").alias("topic"))
    return posts.groupBy("topic").agg(F.count("*").alias("n"))


# ---- reports, file lists -----------------------------------------------------------------------


@question("""
SELECT o_orderpriority AS topic, count(*) AS n, round(sum(o_totalprice) + 1e-9, 2) AS total FROM orders GROUP BY 1""")
def report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report written as one CSV and one Parquet file, read back from both."""
    orders = roles.table(spark, sf_dir, "orders")
    report = orders.groupBy(F.col("o_orderpriority").alias("topic")).agg(
        F.count("*").alias("n"), (F.round(F.sum("o_totalprice") + 1e-9, 2)).alias("total")
    )
    report = stored(report, "report")
    as_csv, as_parquet = new_folder(spark, "csv"), new_folder(spark, "parquet")
    tables.write_report_csv(report.select("topic", "n"), as_csv)
    tables.write_report_parquet(report.select("topic", "total"), as_parquet)
    counts = tables.read_table(spark, as_csv, fmt="csv", schema="topic string, n long", header="true")
    return counts.join(tables.read_table(spark, as_parquet), "topic")


@question("SELECT year(ts)::int AS year, month(ts)::int AS month, count(*) AS n FROM events GROUP BY 1, 2")
def file_list_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly files read by list and by glob; both must see the same rows."""
    root = new_folder(spark, "months")
    events = roles.table(spark, sf_dir, "events").select(
        "event_id", F.year("ts").alias("year"), F.month("ts").alias("month")
    )
    events = events.withColumns({"y": F.col("year"), "m": F.format_string("%02d", "month")})
    events.write.partitionBy("y", "m").parquet(root)
    months = [(r["year"], r["month"]) for r in events.select("year", "month").distinct().collect()]
    listed = tables.read_table(spark, tables.monthly_paths(root + "/y={year}/m={month:02d}", months))
    globbed = tables.read_table(spark, root + "/y=*/m=*")
    counted = listed.groupBy("year", "month").agg(F.count("*").alias("n"))
    same = globbed.groupBy("year", "month").agg(F.count("*").alias("n"))
    return counted.join(same, ["year", "month", "n"])


# ---- behind the models -------------------------------------------------------------------------

_TEST_DAYS = f"""{_DAILY}, {_FILLED}, {_features_sql('filled', -1)},
placed AS (SELECT *, row_number() OVER (ORDER BY date) AS r, count(*) OVER () AS days FROM features),
test AS (SELECT date, n_posts, lag_7::double AS prediction FROM placed WHERE r > floor(days * 0.85))"""


def _naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value of a week before as a model without anything to fit."""
    days = split.chronological_split(_forecast_features(spark, sf_dir))
    model = SQLTransformer(statement="SELECT *, double(lag_7) AS prediction FROM __THIS__")
    return forecast.predictions({"naive": model}, days.where(F.col("split") == "test"))


@question(f"WITH {_TEST_DAYS} SELECT 'naive' AS model, date, n_posts, prediction FROM test")
def naive_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _naive(spark, sf_dir)


@question(f"""WITH {_TEST_DAYS}
SELECT 'naive' AS model, round(sqrt(avg((prediction - n_posts) ** 2)) + 1e-9, 6) AS rmse,
       round(avg(abs(prediction - n_posts)) + 1e-9, 6) AS mae,
       round(1 - sum((prediction - n_posts) ** 2) / (var_pop(n_posts) * count(*)) + 1e-9, 6) AS r2
FROM test""")
def naive_forecast_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(forecast.compare_models(_naive(spark, sf_dir)), 6, "rmse", "mae", "r2")


@question(f"""{_WITH_SCORED},
c AS (SELECT count(*) AS n, count(*) FILTER (label = 1) AS p FROM scored)
SELECT 'majority' AS split, n, round(greatest(p, n - p) / n + 1e-9, 6) AS accuracy, 0.5::double AS auc FROM c""")
def majority_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ml.evaluate_binary(ml.majority_baseline(_labelled(spark, sf_dir)), "majority")
    return settled(out, 6, "accuracy").select("split", "n", "accuracy", "auc")


@question("""
WITH c AS (SELECT corr(o_totalprice, o_custkey) AS a, corr(o_totalprice, o_orderkey) AS b FROM orders)
SELECT feature, round(v + 1e-9, 6) AS coefficient, round(abs(v) + 1e-9, 6) AS abs_coef
FROM (SELECT 'customer' AS feature, a AS v FROM c UNION ALL SELECT 'order', b FROM c)""")
def coefficient_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlations with the price, as coefficients in order of size."""
    orders = roles.table(spark, sf_dir, "orders")
    found = orders.agg(F.corr("o_totalprice", "o_custkey"), F.corr("o_totalprice", "o_orderkey")).first()
    return settled(ml.coefficients_table(spark, ["customer", "order"], list(found)), 6, "coefficient", "abs_coef")


_TOPICS = f"""words AS (SELECT source AS topic, unnest({roles.tokens_sql('text')}) AS word FROM documents),
counted AS (SELECT topic, word, count(*) AS n FROM words GROUP BY 1, 2),
described AS (SELECT topic, word, row_number() OVER (PARTITION BY topic ORDER BY n DESC, encode(word)) AS rank
              FROM counted QUALIFY rank <= 10),
listed AS (SELECT topic, string_agg(word, ', ' ORDER BY rank) AS topic_words FROM described GROUP BY 1)"""


def _described(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most frequent words of each source, as the words of a topic."""
    from pyspark.sql import Window as W

    docs = roles.documents(spark, sf_dir).select(F.col("source").alias("topic"), tokenize("text").alias("tokens"))
    counts = each_word(docs, "tokens", "topic").groupBy("topic", "word").agg(F.count("*").alias("n"))
    rank = F.row_number().over(W.partitionBy("topic").orderBy(F.desc("n"), "word"))
    return counts.withColumn("rank", rank).where("rank <= 10").select("topic", "rank", "word")


@question(f"WITH {_TOPICS} SELECT * FROM listed")
def source_topic_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.summary(_described(spark, sf_dir))


@question(f"WITH {_TOPICS} SELECT topic, rank::int AS rank, word FROM described")
def source_ranked_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.ranked_words(topics.summary(_described(spark, sf_dir)))


@question("SELECT source AS top_topic, count(*) AS n FROM documents GROUP BY 1")
def source_prevalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.prevalence(roles.table(spark, sf_dir, "documents").withColumnRenamed("source", "top_topic"))


@question(f"""WITH {_TOPICS},
first AS (SELECT source, min(doc_id) AS doc_id FROM documents GROUP BY 1)
SELECT l.topic, l.topic_words, trim(regexp_replace(d.text, ' +', ' ', 'g')) AS sample_submission
FROM listed l JOIN first f ON f.source = l.topic JOIN documents d USING (doc_id)""")
def source_topic_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = roles.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("clean_text"), F.col("source").alias("top_topic")
    )
    return topics.summary_with_sample(topics.summary(_described(spark, sf_dir)), topics.samples(documents))


@question("""
SELECT l.doc_id AS id, round(1 / (1 + exp(-(0.002::double * length(text) - 3))) + 1e-9, 6) AS probability_positive
FROM labels l JOIN documents d USING (doc_id) ORDER BY 2 DESC, 1 LIMIT 500""")
def saved_model_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model with given coefficients, saved, loaded and applied; its highest scores."""
    from pyspark.ml import PipelineModel

    labels = roles.table(spark, sf_dir, "labels").select("doc_id")
    rows = roles.table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("chars")).join(labels, "doc_id")
    folder = new_folder(spark, "model")
    odds = SQLTransformer(statement="SELECT *, 0.002D * chars - 3 AS odds FROM __THIS__")
    score = SQLTransformer(statement="SELECT *, 1 / (1 + exp(-odds)) AS probability_positive FROM __THIS__")
    ml.save_model(PipelineModel([odds, score]), folder)
    scored = ml.load_model(folder).transform(rows).withColumnRenamed("doc_id", "id")
    scored = settled(scored, 6, "probability_positive")
    return ml.top_scored(scored, ["id", "probability_positive"], "probability_positive")
