"""Streaming counts, windows and sessions. Streaming table in, streaming table out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from agoralens.functions.calendar import event_time
from agoralens.functions.text import each_word, tokenize
from agoralens.operators.lookups import fits_broadcast


def running_counts(stream: DataFrame, key: str) -> DataFrame:
    """Count per key since the start; run it in complete or update mode."""
    return stream.groupBy(key).agg(F.count("*").alias("n"))


def windowed_counts(
    stream: DataFrame,
    ts: str,
    length: str,
    slide: str | None = None,
    *,
    keys: Sequence[str] = (),
    delay: str = "10 minutes",
) -> DataFrame:
    """Rows per tumbling (or sliding) event-time window and key.

    In append mode a window is given out once, when the watermark has passed its end; rows later
    than `delay` are not counted.
    """
    timed = stream.withColumn(ts, event_time(ts)).withWatermark(ts, delay)
    span = F.window(ts, length, slide) if slide else F.window(ts, length)
    counted = timed.groupBy(span, *keys).agg(F.count("*").alias("n"))
    return counted.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *keys,
        "n",
    )


def sessions(
    stream: DataFrame, ts: str, key: str, gap: str, *, delay: str = "10 minutes"
) -> DataFrame:
    """Sessions per key, closed by a gap without rows: start, end, seconds and row count."""
    timed = stream.withColumn(ts, event_time(ts)).withWatermark(ts, delay)
    grouped = timed.groupBy(F.session_window(ts, gap).alias("session"), key)
    start, end = F.col("session.start"), F.col("session.end")
    return grouped.agg(F.count("*").alias("n_events")).select(
        key,
        start.alias("session_start"),
        end.alias("session_end"),
        ((F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)).alias(
            "duration_seconds"
        ),
        "n_events",
    )


def word_sentiment(stream: DataFrame, text: str, lexicon: DataFrame) -> DataFrame:
    """Count and `count * value` per lexicon word (`word`, `value`) in the texts so far."""
    words = each_word(stream, tokenize(text))
    # A stream's rows cannot be counted beforehand to find hot words, so only a lexicon that fits
    # is hinted; otherwise Spark joins by shuffle.
    side = F.broadcast(lexicon) if fits_broadcast(lexicon) else lexicon
    found = words.join(side, "word")
    counted = found.groupBy("word", "value").agg(F.count("*").alias("n"))
    return counted.withColumn("score", F.col("n") * F.col("value"))


def happiest_words(scored: DataFrame, k: int = 5) -> DataFrame:
    """The k words with the highest score of one batch; equal scores in word order."""
    return scored.orderBy(F.desc("score"), "word").limit(k)
