"""Text cleaning jobs: from raw posts and comments to stemmed tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, functions as F

from agoralens.functions.stemming import stem, stem_tokens
from agoralens.functions.text import (
    document_text,
    drop_words,
    each_word,
    is_removed,
    joined_tokens,
    json_safe,
    strip_markup,
    tokenize,
)


def drop_removed(df: DataFrame, column: str) -> DataFrame:
    """Without rows whose text was removed or deleted, or is NULL."""
    return df.where(~is_removed(column))


def english_stop_words() -> list[str]:
    """Spark's own English list. Needs a running session."""
    return StopWordsRemover.loadDefaultStopWords("english")


def clean_tokens(
    text: str | Column, stop_words: Sequence[str] | None = None, stemmed: bool = True
) -> Column:
    """Letters-only lower-case tokens without stop words, stemmed."""
    words = english_stop_words() if stop_words is None else stop_words
    tokens = drop_words(tokenize(text), words) if words else tokenize(text)
    return stem_tokens(tokens) if stemmed else tokens


def _cleaned(df: DataFrame, raw: Column, stop_words: Sequence[str] | None) -> DataFrame:
    with_raw = df.withColumn("raw_text", strip_markup(raw))
    with_tokens = with_raw.withColumn("tokens", clean_tokens("raw_text", stop_words))
    return with_tokens.withColumn("clean_text", joined_tokens("tokens"))


def clean_posts(
    posts: DataFrame,
    title: str = "title",
    body: str = "selftext",
    stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """Posts that still have a body, with `raw_text`, `tokens` and the one-string `clean_text`.

    Map-only: nothing is shuffled.
    """
    safe = drop_removed(posts, body).withColumns({title: json_safe(title), body: json_safe(body)})
    return _cleaned(safe, document_text(title, body), stop_words)


def clean_comments(
    comments: DataFrame, body: str = "body", stop_words: Sequence[str] | None = None
) -> DataFrame:
    safe = drop_removed(comments, body).withColumn(body, json_safe(body))
    return _cleaned(safe, F.col(body), stop_words)


def stemmed_vocabulary(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Distinct words with their stem and count; each word is stemmed once."""
    words = each_word(df, tokens).groupBy("word")
    return words.agg(F.count("*").alias("n")).withColumn("stem", stem("word"))
