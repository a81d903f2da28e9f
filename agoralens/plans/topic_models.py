"""Topic models on the test tables. Model outputs have no SQL twin."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralens.functions.text import joined_tokens, tokenize
from agoralens.operators import topics
from agoralens.plans import roles
from agoralens.plans.overview import settled
from agoralens.plans.registry import question
from agoralens.sources.scratch import shared_folder, stored


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token lists of all text posts, written once because LDA passes over them many times."""
    posts = roles.post_texts(spark, sf_dir)
    joined = posts.select("id", joined_tokens(tokenize("selftext")).alias("clean_text"))
    return stored(topics.word_tokens(joined))


_fitted: dict[tuple[str, str], str] = {}


def _model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> topics.TopicModel:
    """The topics of all documents: fitted by the first question that asks, then loaded."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _fitted:
        # Kept beside the tables of single questions, which are deleted after each.
        folder = f"{shared_folder(spark).rstrip('/')}/topics-{uuid.uuid4().hex}"
        topics.save_topics(topics.fit_topics(docs), folder)
        _fitted[key] = folder
    return topics.load_topics(_fitted[key])


@question()
def topic_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.describe(_model(spark, sf_dir, _docs(spark, sf_dir)))


@question()
def topic_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    return topics.assign(_model(spark, sf_dir, docs), docs).select("id", "top_topic", "top_share")


@question()
def topic_prevalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    return topics.prevalence(topics.assign(_model(spark, sf_dir, docs), docs))


@question()
def topic_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and a sample document per topic."""
    docs = _docs(spark, sf_dir)
    model = _model(spark, sf_dir, docs)
    # Stored, as samples are found in two passes and topics are worked out anew in each.
    assigned = stored(topics.assign(model, docs).select("id", "clean_text", "top_topic"), "assigned")
    samples = topics.samples(assigned)
    return topics.summary_with_sample(topics.summary(topics.describe(model)), samples)


@question()
def topic_ranked_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = topics.describe(_model(spark, sf_dir, _docs(spark, sf_dir)))
    return topics.ranked_words(topics.summary(described))


_WORDS = f"""words AS (SELECT doc_id AS id, unnest({roles.tokens_sql('text')}) AS word FROM documents)"""


@question(f"""
WITH {_WORDS}
SELECT word, count(*) AS n FROM words GROUP BY 1 HAVING count(DISTINCT id) >= 5
ORDER BY n DESC, encode(word) LIMIT 20000""")
def topic_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = roles.post_texts(spark, sf_dir)
    docs = posts.select("id", tokenize("selftext").alias("tokens"))
    return topics.frequent_words(docs, "tokens", 20_000, 5)


@question("""
WITH first AS (SELECT source, min(doc_id) AS id FROM documents GROUP BY 1)
SELECT d.source AS top_topic, d.doc_id AS id, d.text AS clean_text
FROM documents d JOIN first f ON f.id = d.doc_id""")
def group_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First document of each source, as topics are sampled."""
    documents = roles.table(spark, sf_dir, "documents")
    return topics.samples(
        documents.select(
            F.col("doc_id").alias("id"), F.col("text").alias("clean_text"),
            F.col("source").alias("top_topic"),
        )
    )


@question()
def tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed term weights of each text post, as sparse vectors in text form."""
    weighted = topics.tfidf(_docs(spark, sf_dir))
    return weighted.select("id", F.col("tfidf").cast("string").alias("weights"))


@question(f"""
WITH {_WORDS},
tf AS (SELECT id, word, count(*) AS tf FROM words GROUP BY 1, 2)
SELECT id, word, tf, round(tf * ln(((SELECT count(*) FROM documents) + 1.0::double)
       / (count(*) OVER (PARTITION BY word) + 1)) + 1e-9, 6) AS weight
FROM tf""")
def term_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = roles.post_texts(spark, sf_dir)
    docs = posts.select("id", tokenize("selftext").alias("tokens"))
    return settled(topics.term_weights(docs), 6, "weight")
