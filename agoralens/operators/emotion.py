"""Lexicon-based emotion counts, densities and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from agoralens.functions.numbers import ratio
from agoralens.functions.stemming import stem
from agoralens.functions.text import each_word
from agoralens.operators.lookups import BROADCAST_ROWS, lookup_join
from agoralens.operators.stats import stack_rows

# The ten emotions of the lexicon.
EMOTIONS = (
    "anger", "anticipation", "disgust", "fear", "joy",
    "sadness", "surprise", "trust", "negative", "positive",
)


def stem_lexicon(lexicon: DataFrame) -> DataFrame:
    """Lexicon on stems, to match stemmed tokens. Words that share a stem share its emotions."""
    return lexicon.select(stem("word").alias("word"), "emotion").distinct()


def lexicon_by_word(lexicon: DataFrame, emotions: Sequence[str] = EMOTIONS) -> DataFrame:
    """One row per word with a 0/1 column per emotion (more than 1 if the pair is repeated)."""
    flags = [F.count_if(F.col("emotion") == e).alias(e) for e in emotions]
    return lexicon.where(F.col("emotion").isin(*emotions)).groupBy("word").agg(*flags)


def match_lexicon(
    docs: DataFrame, lexicon: DataFrame, *, id_col: str = "id", tokens: str = "tokens"
) -> DataFrame:
    """(id, word, emotion) for every token found in the lexicon, once per emotion of the word."""
    words = each_word(docs, tokens, id_col)
    return lookup_join(words, lexicon.select("word", "emotion"), ["word"])


def counts(
    docs: DataFrame, lexicon: DataFrame, *, id_col: str = "id", tokens: str = "tokens"
) -> DataFrame:
    """Matched tokens per document and emotion, in long form."""
    matched = match_lexicon(docs, lexicon, id_col=id_col, tokens=tokens)
    return matched.groupBy(id_col, "emotion").agg(F.count("*").alias("emotion_count"))


def wide_counts(
    docs: DataFrame,
    lexicon: DataFrame,
    *,
    id_col: str = "id",
    tokens: str = "tokens",
    keep: Sequence[str] = (),
    emotions: Sequence[str] = EMOTIONS,
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per document: `<emotion>_count`, `n_tokens`, `n_matched` and the `keep` columns.

    Matching one flag row per word keeps one row per token, so counting, pivoting and keeping the
    documents without a match need a single aggregation instead of three and a join back. Rows of
    a document sit together and collapse before the shuffle.
    """
    # Counted before the explode: an expression next to it would run once per token.
    counted = docs.select(id_col, *keep, F.filter(tokens, lambda w: w != "").alias("_words"))
    counted = counted.withColumn("n_tokens", F.size("_words"))
    exploded = counted.select(id_col, *keep, "n_tokens", F.explode_outer("_words").alias("word"))
    flags = lexicon_by_word(lexicon, emotions)
    joined = lookup_join(exploded, flags, ["word"], "left", max_broadcast_rows)
    sums = [F.coalesce(F.sum(e), F.lit(0)).alias(f"{e}_count") for e in emotions]
    kept = [F.first(c).alias(c) for c in (*keep, "n_tokens")]
    hit = F.coalesce(*[F.col(e) for e in emotions]).isNotNull()
    return joined.groupBy(id_col).agg(*kept, F.count_if(hit).alias("n_matched"), *sums)


def _emotion_total(emotions: Sequence[str]) -> Column:
    total = F.lit(0)
    for e in emotions:
        total = total + F.col(f"{e}_count")
    return total


def densities(
    wide: DataFrame, denominator: str = "matched", emotions: Sequence[str] = EMOTIONS
) -> DataFrame:
    """Add `<emotion>_density`, `emotion_token_count` and `total_tokens` to `wide_counts`.

    "matched": the share of the document's emotion hits; NULL without any hit, so averages skip
    such documents. "tokens": hits per token of the document, together with
    `emotional_vocab_density`; counts and densities of a document without a hit are NULL, its
    vocabulary density is 0.
    """
    if denominator not in ("matched", "tokens"):
        raise ValueError("denominator must be 'matched' or 'tokens'")
    any_hit = F.col("n_matched") > 0
    base = wide.withColumn("emotion_token_count", _emotion_total(emotions))
    size = F.col("emotion_token_count") if denominator == "matched" else F.col("n_tokens")
    base = base.withColumn("total_tokens", F.when(size == 0, 1).otherwise(size).cast("long"))
    base = base.withColumns(
        {f"{e}_count": F.when(any_hit, F.col(f"{e}_count")) for e in emotions}
    )
    shares = {
        f"{e}_density": F.col(f"{e}_count") / F.col("total_tokens") for e in emotions
    }
    if denominator == "tokens":
        shares["emotional_vocab_density"] = F.col("emotion_token_count") / F.col("total_tokens")
    return base.withColumns(shares)


def temporal_profile(
    df: DataFrame, by: str | Sequence[str], emotions: Sequence[str] = EMOTIONS
) -> DataFrame:
    """Mean density of every emotion per hour, month or weekday, in key order."""
    keys = [by] if isinstance(by, str) else list(by)
    means = [F.avg(f"{e}_density").alias(f"{e}_avg") for e in emotions]
    return df.groupBy(*keys).agg(*means).orderBy(*keys)


def mean_density(df: DataFrame, emotions: Sequence[str] = EMOTIONS) -> DataFrame:
    """Mean density per emotion over all documents, in long form, highest first."""
    wide = df.agg(*[F.avg(f"{e}_density").alias(e) for e in emotions])
    rows = [
        {"emotion_density": F.lit(f"{e}_density"), "mean_value": F.col(e)} for e in emotions
    ]
    return stack_rows(wide, rows).orderBy(F.desc("mean_value"), "emotion_density")


def polarity(df: DataFrame) -> DataFrame:
    """Add `polarity_score` (positive minus negative share of hits) and its sign `polarity`.

    Documents without a hit are neutral.
    """
    balance = F.coalesce(F.col("positive_count") - F.col("negative_count"), F.lit(0))
    return df.withColumns(
        {
            "polarity_score": F.coalesce(ratio(balance, F.col("emotion_token_count")), F.lit(0.0)),
            "polarity": F.signum(balance.cast("double")).cast("int"),
        }
    )
