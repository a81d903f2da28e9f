"""Topic models: vocabulary, LDA, topic words, assignments and samples."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import LDA, LDAModel, LocalLDAModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import IDF, CountVectorizerModel, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralens.functions.text import TOKEN_JOINER, each_word
from agoralens.operators import variational
from agoralens.operators.lookups import frequent_join, lookup_join
from agoralens.sources.scratch import stored


@dataclass(frozen=True)
class TopicModel:
    words: CountVectorizerModel
    lda: LDAModel


def word_tokens(df: DataFrame, text: str = "clean_text", tokens: str = "tokens") -> DataFrame:
    """Split on everything but word characters, lower-cased; rows without text are dropped."""
    splitter = RegexTokenizer(inputCol=text, outputCol=tokens, pattern=r"\W+")
    return splitter.transform(df.dropna(subset=[text]))


def frequent_words(df: DataFrame, tokens: str, size: int, min_docs: int) -> DataFrame:
    """(word, n) of the `size` most frequent words found in at least `min_docs` documents.

    Words are added up per Arrow batch before they are rows, so a token costs no row of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            coded = lists.flatten().dictionary_encode()
            word, codes = coded.dictionary, coded.indices
            real = codes.is_valid().to_numpy(zero_copy_only=False)
            codes = codes.fill_null(0).to_numpy()[real]
            rows = pc.list_parent_indices(lists).to_numpy()[real]
            n = np.bincount(codes, minlength=len(word))
            # Once for each document and word.
            docs = np.bincount(np.unique(rows * len(word) + codes) % max(1, len(word)), minlength=len(word))
            yield pa.RecordBatch.from_arrays([word, pa.array(n), pa.array(docs)], names=["word", "n", "docs"])

    found = df.select(tokens).mapInArrow(run, "word string, n long, docs long").where("word != ''")
    counted = found.groupBy("word").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = counted.where(F.col("docs") >= min_docs)
    return kept.orderBy(F.desc("n"), "word").limit(size).select("word", "n")


def fit_topics(
    df: DataFrame,
    tokens: str = "tokens",
    *,
    k: int = 15,
    max_iter: int = 10,
    vocabulary: int = 20_000,
    min_docs: int = 5,
    seed: int = 42,
    share: float = 1.0,
) -> TopicModel:
    """Count vectors into LDA. The driver holds the vocabulary and the k x vocabulary matrix.

    Every iteration draws `share` of the documents, by default as many as there are, with repeats.
    `variational` gives what `LDA` itself would, in less time.

    `df` is passed over many times, so store it first. Seeds number words by their place in the
    vocabulary, so equal counts are put in word order.
    """
    frequent = frequent_words(df, tokens, vocabulary, min_docs)
    words = CountVectorizerModel.from_vocabulary(
        [r["word"] for r in frequent.collect()], inputCol=tokens, outputCol="counts"
    )
    lda = LDA(k=k, maxIter=max_iter, featuresCol="counts", seed=seed, subsamplingRate=share)
    weights, priors = variational.fit(words.transform(df), lda)
    return TopicModel(words, _local_lda(df.sparkSession, weights, priors, 1 / k))


def save_topics(model: TopicModel, path: str) -> None:
    """Both parts under one folder, to be loaded by any later job."""
    model.words.write().overwrite().save(f"{path}/words")
    model.lda.write().overwrite().save(f"{path}/lda")


def load_topics(path: str) -> TopicModel:
    return TopicModel(CountVectorizerModel.load(f"{path}/words"), LocalLDAModel.load(f"{path}/lda"))


def known_topics(
    spark: SparkSession, vocabulary: Sequence[str], weights: Sequence[Sequence[float]], tokens: str = "tokens", priors: Sequence[float] | None = None
) -> TopicModel:
    """A model from a given topic matrix (one row of word weights per topic), such as one that was
    fitted elsewhere or is kept as a table. Weights are positive and need not add up to 1; `priors` are
    what each topic has before any word is read (default 0.1)."""
    words = CountVectorizerModel.from_vocabulary(list(vocabulary), inputCol=tokens, outputCol="counts")
    before = np.full(len(weights), 0.1) if priors is None else np.array(priors, float)
    return TopicModel(words, _local_lda(spark, np.array(weights, float).T, before, 0.1))


def _local_lda(spark: SparkSession, weights: np.ndarray, priors: np.ndarray, eta: float) -> LocalLDAModel:
    """A model of the weights of each word (row) in each topic (column)."""
    size, k = weights.shape
    sc = spark.sparkContext
    jvm = sc._jvm.org.apache.spark
    matrix = jvm.mllib.linalg.Matrices.fromML(_py2java(sc, DenseMatrix(size, k, weights.ravel(order="F"))))
    before = jvm.mllib.linalg.Vectors.fromML(_py2java(sc, Vectors.dense(priors)))
    old = jvm.mllib.clustering.LocalLDAModel(matrix, before, eta, variational.START_SHAPE)
    java = jvm.ml.clustering.LocalLDAModel(f"topics_{k}", size, old, spark._jsparkSession)
    return LocalLDAModel(java).setFeaturesCol("counts")


def describe(model: TopicModel, n_words: int = 10) -> DataFrame:
    """(topic, rank, word, weight) of each topic's heaviest words, rank from 1."""
    topics = model.lda.describeTopics(n_words)
    spark = topics.sparkSession
    vocabulary = spark.createDataFrame(
        list(enumerate(model.words.vocabulary)), "term_index int, word string"
    )
    terms = topics.select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("place", "term")
    ).select(
        "topic",
        (F.col("place") + 1).alias("rank"),
        F.col("term.termIndices").alias("term_index"),
        F.col("term.termWeights").alias("weight"),
    )
    return terms.join(vocabulary, "term_index").select("topic", "rank", "word", "weight")


def summary(described: DataFrame) -> DataFrame:
    """One row per topic with its words joined by ", ", heaviest first."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "word")))
    words = F.array_join(F.transform(ordered, lambda r: r["word"]), ", ")
    return described.groupBy("topic").agg(words.alias("topic_words"))


def assign(model: TopicModel, df: DataFrame) -> DataFrame:
    """Add `top_topic`, the first topic with the largest share, and that share."""
    shares = vector_to_array("topicDistribution")
    scored = model.lda.transform(model.words.transform(df)).withColumn("_shares", shares)
    return scored.withColumns(
        {
            "top_topic": (F.array_position("_shares", F.array_max("_shares")) - 1).cast("int"),
            "top_share": F.array_max("_shares"),
        }
    ).drop("_shares", "counts", "topicDistribution")


def prevalence(assigned: DataFrame, topic: str = "top_topic") -> DataFrame:
    return assigned.groupBy(topic).agg(F.count("*").alias("n")).orderBy(F.desc("n"), topic)


def samples(
    assigned: DataFrame, id_col: str = "id", text: str = "clean_text", topic: str = "top_topic"
) -> DataFrame:
    """The document with the smallest id of each topic.

    The ids are found without the texts, which are then picked out by a join with one row per topic.
    """
    first = stored(assigned.groupBy(topic).agg(F.min(id_col).alias(id_col)), "firsts")
    found = lookup_join(assigned.select(topic, id_col, text), first, [topic, id_col])
    return found.groupBy(topic, id_col).agg(F.min(text).alias(text))


def readable(text: str):
    """Joined tokens as plain words, blanks squeezed and trimmed."""
    return F.trim(F.regexp_replace(F.replace(text, F.lit(TOKEN_JOINER), F.lit(" ")), " +", " "))


def summary_with_sample(
    topic_summary: DataFrame, topic_samples: DataFrame, text: str = "clean_text"
) -> DataFrame:
    """Topic words next to a readable sample document; a topic without documents has none."""
    sample = topic_samples.select(
        F.col("top_topic").alias("topic"), readable(text).alias("sample_submission")
    )
    cleaned = topic_summary.select("topic", readable("topic_words").alias("topic_words"))
    return cleaned.join(sample, "topic", "left").orderBy("topic")


def ranked_words(topic_summary: DataFrame, k: int = 10) -> DataFrame:
    """(topic, rank, word) of the first k words of each topic's word list."""
    words = F.slice(F.split("topic_words", ","), 1, k)
    placed = topic_summary.select("topic", F.posexplode(words).alias("place", "word"))
    return placed.select("topic", (F.col("place") + 1).alias("rank"), F.trim("word").alias("word"))


def term_weights(df: DataFrame, id_col: str = "id", tokens: str = "tokens") -> DataFrame:
    """(id, word, tf, weight) in long form, without hashing words together.

    The weight is tf * ln((documents + 1) / (documents with the word + 1)), as in `tfidf`. The
    frequencies of the words found in most documents are known to every task, so only rows of rare
    words are shuffled to look theirs up. Texts are read once; what follows works on the stored counts.
    """
    tf = stored(each_word(df, tokens, id_col).groupBy(id_col, "word").agg(F.count("*").alias("tf")), "tf")
    spread = stored(tf.groupBy("word").agg(F.count("*").alias("_docs")), "words")
    documents = df.agg(F.count("*").alias("n")).scalar()
    weight = F.col("tf") * F.log((documents + 1.0) / (F.col("_docs") + 1.0))
    return frequent_join(tf, spread, "word", "_docs").select(id_col, "word", "tf", weight.alias("weight"))


def tfidf(df: DataFrame, tokens: str = "tokens", features: int = 1 << 18, min_docs: int = 0) -> DataFrame:
    """Add `tfidf`, the hashed term frequencies weighted by inverse document frequency."""
    hashed = HashingTF(inputCol=tokens, outputCol="tf", numFeatures=features).transform(df)
    return IDF(inputCol="tf", outputCol="tfidf", minDocFreq=min_docs).fit(hashed).transform(hashed)
