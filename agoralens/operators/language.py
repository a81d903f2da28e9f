"""Writing style and the words that mark engagement."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from agoralens.functions.numbers import ratio
from agoralens.functions.text import count_marks, each_word


def style_features(df: DataFrame, raw: str = "raw_text", tokens: str = "tokens") -> DataFrame:
    """Length, questions and readability of each text.

    Readability is tokens per sentence mark; a text without a mark counts as one sentence.
    """
    n_tokens = F.greatest(F.size(tokens), F.lit(1))
    marks = F.greatest(count_marks(raw, ".!?"), F.lit(1))
    return df.withColumns(
        {
            "post_length_tokens": F.size(tokens),
            "post_length_chars": F.length(raw),
            "question_count": count_marks(raw, "?"),
            "sentence_punct_count": marks,
            "readability_score": n_tokens / marks,
        }
    )


def lexical_features(df: DataFrame, tokens: str = "tokens", title: str = "title") -> DataFrame:
    """Words, distinct words, their ratio (NULL without words) and question marks in the title."""
    count, unique = F.size(tokens), F.size(F.array_distinct(tokens))
    return df.withColumns(
        {
            "word_count": count,
            "unique_words": unique,
            "unique_ratio": ratio(unique, count),
            "question_marks": count_marks(title, "?"),
        }
    )


def word_counts(
    df: DataFrame, group: str = "engagement", tokens: str = "tokens", keep_empty: bool = False
) -> DataFrame:
    """Words per group. `keep_empty` also counts the empty tokens of a joined text."""
    if keep_empty:
        words = df.select(group, F.explode(tokens).alias("word"))
    else:
        words = each_word(df, tokens, group)
    return words.groupBy(group, "word").agg(F.count("*").alias("count"))


def top_words(counted: DataFrame, k: int = 50, group: str = "engagement") -> DataFrame:
    """The k most frequent words of each group, ranked; equal counts in word order.

    Spark keeps only k rows per group and task before the shuffle.
    """
    order = W.partitionBy(group).orderBy(F.desc("count"), F.asc("word"))
    return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def group_stats(df: DataFrame, group: str = "engagement", rounded: bool = False) -> DataFrame:
    """Mean linguistic features per group; `rounded` gives the report form (2, 3 and 3 digits)."""
    means = {"word_count": 2, "unique_ratio": 3, "question_marks": 3}
    out = df.groupBy(group).agg(*[F.avg(c).alias(f"avg_{c}") for c in means])
    if rounded:
        out = out.withColumns({f"avg_{c}": F.round(f"avg_{c}", d) for c, d in means.items()})
    return out
