"""Streams over the files of the test tables, run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralens.plans import roles
from agoralens.plans.registry import question
from agoralens.sources.scratch import new_folder
from agoralens.sources.tables import read_table_stream
from agoralens.streaming import counts, stateful, timers, upsert
from agoralens.streaming.run import append_to_table, latest, to_table


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = roles.table(spark, sf_dir, name).schema
    return read_table_stream(spark, f"{sf_dir}/{name}.parquet", schema)


def _zoneless(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@question("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_running_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _stream(spark, sf_dir, "events")
    return to_table(counts.running_counts(events, "event_type"), "complete", "running")


@question("""
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, n
FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n
      FROM events GROUP BY 1, 2)""")
def stream_tumbling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows at the end of the input, those the watermark has not closed included."""
    events = _stream(spark, sf_dir, "events")
    out = to_table(counts.windowed_counts(events, "ts", "1 hour", keys=["event_type"]), "update", "tumbling")
    out = latest(out, ["window_start", "window_end", "event_type"], ["n"])
    return _zoneless(out, "window_start", "window_end")


@question("""
SELECT window_start, window_start + INTERVAL 2 HOUR AS window_end, n
FROM (SELECT b - k * INTERVAL 30 MINUTE AS window_start, count(*) AS n
      FROM (SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS b FROM events), range(4) t(k) GROUP BY 1)""")
def stream_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _stream(spark, sf_dir, "events")
    out = to_table(counts.windowed_counts(events, "ts", "2 hours", "30 minutes"), "update", "sliding")
    return _zoneless(latest(out, ["window_start", "window_end"], ["n"]), "window_start", "window_end")


_SESSIONS = """
WITH marked AS (
  SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w > INTERVAL 30 MINUTE
                             OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS opens
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts
             ROWS UNBOUNDED PRECEDING) AS s FROM marked),
sessions AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end,
                    count(*) AS n_events, max(ts) AS last_ts, min(ts) AS first_ts
             FROM numbered GROUP BY user_id, s)"""


@question(f"""{_SESSIONS}
SELECT user_id, session_start, session_end,
       round((epoch_us(last_ts) - epoch_us(first_ts)) / 1000000.0 + 1800, 6) AS duration_seconds, n_events
FROM sessions""")
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sessions at the end of the input. Session windows have no update mode, so the run to the
    end gives out its whole state."""
    events = _stream(spark, sf_dir, "events")
    out = to_table(counts.sessions(events, "ts", "user_id", "30 minutes"), "complete", "sessions")
    out = out.withColumn("duration_seconds", F.round("duration_seconds", 6))
    return _zoneless(out, "session_start", "session_end")


@question(f"""
WITH {roles.LEXICON},
scores AS (SELECT word, CASE emotion WHEN 'positive' THEN 1 ELSE -1 END AS value
           FROM lexicon WHERE emotion IN ('positive', 'negative')),
words AS (SELECT unnest({roles.tokens_sql('text')}) AS word FROM conversations)
SELECT word, value, count(*) AS n, count(*) * value AS score
FROM words JOIN scores USING (word) GROUP BY word, value ORDER BY score DESC, encode(word) LIMIT 5""")
def stream_happiest_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    lexicon = roles.lexicon(spark, sf_dir).where(F.col("emotion").isin("positive", "negative"))
    scores = lexicon.select(
        "word", F.when(F.col("emotion") == "positive", 1).otherwise(-1).alias("value")
    )
    said = _stream(spark, sf_dir, "conversations")
    return counts.happiest_words(to_table(counts.word_sentiment(said, "text", scores), "complete", "words"))


@question(f"""{_SESSIONS}
SELECT user_id::varchar AS key, first_ts AS session_start, last_ts AS last_event, n_events FROM sessions""")
def stream_stateful_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sessions, open ones included, from hand-written state."""
    events = _stream(spark, sf_dir, "events")
    changes = to_table(stateful.stateful_sessions(events, "ts", "user_id", 1_800), "update", "state")
    found = stateful.last_versions(changes).select(
        "key",
        F.timestamp_micros("first_us").alias("session_start"),
        F.timestamp_micros("last_us").alias("last_event"),
        "n_events",
    )
    return _zoneless(found, "session_start", "last_event")


def _in_files(spark: SparkSession, sf_dir: str, files: int = 6) -> DataFrame:
    """The events as a stream of several files, each a batch of its own, in the order of time."""
    events = roles.table(spark, sf_dir, "events")
    folder = new_folder(spark, "events")
    events.repartitionByRange(files, "ts").write.parquet(folder)
    return read_table_stream(spark, folder, events.schema, maxFilesPerTrigger="1")


@question(f"""{_SESSIONS}
SELECT user_id::varchar AS key, first_ts AS session_start, last_ts AS last_event, n_events FROM sessions""")
def stream_timed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed sessions as given out by timers, and those still open, read from the state. No rows are
    late, however the files are ordered: the delay is longer than the input."""
    folder = new_folder(spark, "timed")
    path, checkpoint = f"{folder}/table", f"{folder}/checkpoint"
    with timers.rocks_state(spark):
        stream = timers.timed_sessions(_in_files(spark, sf_dir), "ts", "user_id", 1_800, delay="60 days")
        append_to_table(stream, path, checkpoint)
    closed = spark.read.schema(timers.CLOSED).parquet(path)
    found = closed.unionByName(timers.open_sessions(spark, checkpoint)).select(
        "key", F.timestamp_micros("first_us").alias("session_start"), F.timestamp_micros("last_us").alias("last_event"), "n_events"
    )
    return _zoneless(found, "session_start", "last_event")


@question("""
SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_restarted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts in a keyed table, by a stream that is stopped after two batches and restarted from
    its checkpoint."""
    folder = new_folder(spark, "restarted")
    table = upsert.KeyedTable(spark, f"{folder}/table", ["user_id", "event_type"], compact_every=3)
    rows = _in_files(spark, sf_dir)

    def counted() -> DataFrame:
        return rows.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))

    upsert.upsert(counted(), table, f"{folder}/checkpoint", stop_before=2)
    upsert.upsert(counted(), table, f"{folder}/checkpoint")
    return table.rows()


@question("""
SELECT event_type, count(*) AS n, true AS whole FROM events GROUP BY 1""")
def stream_kept_and_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What came in time and what came late are together what came; `whole` if the counts per batch say
    so too."""
    folder = new_folder(spark, "late")
    upsert.split_late(_in_files(spark, sf_dir), "ts", f"{folder}/rows", f"{folder}/checkpoint")
    kept, late, seen = (upsert.late_rows(spark, f"{folder}/rows", which) for which in ("kept", "late", "seen"))
    sums = seen.agg(F.sum("n"), F.sum("n_late")).first()
    whole = tuple(sums) == (kept.count() + late.count(), late.count())
    return kept.unionByName(late).groupBy("event_type").agg(F.count("*").alias("n")).withColumn("whole", F.lit(whole))
