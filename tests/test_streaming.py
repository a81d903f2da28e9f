import pytest
from pyspark.sql import functions as F

from agoralens.sources.tables import read_table_stream
from agoralens.streaming import counts, run, stateful
from tests.conftest import rows

SCHEMA = "u int, kind string, ts timestamp"


def put(spark, folder, data):
    """Add one file of (user, kind, minute) rows to a stream's folder."""
    df = spark.createDataFrame(data, "u int, kind string, m int")
    start = F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    timed = df.select("u", "kind", F.timestamp_seconds(start + F.col("m") * 60).alias("ts"))
    timed.coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "in")


def stream(spark, folder):
    return read_table_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, maxFilesPerTrigger="1")


def test_running_counts(spark, folder):
    put(spark, folder, [(1, "x", 0), (2, "y", 1)])
    put(spark, folder, [(1, "x", 2)])
    out = run.to_table(counts.running_counts(stream(spark, folder), "kind"), "complete")
    assert rows(out) == [("x", 2), ("y", 1)]


def test_windows_wait_for_the_watermark_and_drop_late_rows(spark, folder, tmp_path):
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def go():
        out = counts.windowed_counts(stream(spark, folder), "ts", "10 minutes", delay="5 minutes")
        run.append_to_table(out, path, checkpoint)
        found = spark.read.parquet(path)
        return rows(found.select(F.date_format("window_start", "HH:mm"), "n"))

    put(spark, folder, [(1, "x", 1), (1, "x", 2), (1, "x", 26)])
    assert go() == [("00:00", 2)]
    # A later run starts from the checkpoint: the old window is closed, and a late row is dropped.
    put(spark, folder, [(1, "x", 3), (1, "x", 50)])
    assert go() == [("00:00", 2), ("00:20", 1)]


def test_sliding_windows(spark, folder):
    put(spark, folder, [(1, "x", 12), (1, "x", 100)])
    out = run.to_table(counts.windowed_counts(stream(spark, folder), "ts", "10 minutes", "5 minutes"))
    assert rows(out.select(F.date_format("window_start", "HH:mm"), "n")) == [("00:05", 1), ("00:10", 1)]


def test_sessions(spark, folder):
    put(spark, folder, [(1, "x", 0), (1, "x", 4), (1, "x", 20), (2, "x", 1), (3, "x", 90)])
    out = run.to_table(counts.sessions(stream(spark, folder), "ts", "u", "5 minutes"))
    got = rows(out.select("u", "duration_seconds", "n_events"))
    assert got == [(1, 300.0, 1), (1, 540.0, 2), (2, 300.0, 1)]


def test_happiest_words(spark, folder):
    put(spark, folder, [(1, "good good day", 0), (2, "bad", 1)])
    lexicon = spark.createDataFrame([("good", 3), ("bad", -3), ("day", 6)], "word string, value int")
    scored = counts.word_sentiment(stream(spark, folder), "kind", lexicon)
    out = counts.happiest_words(run.to_table(scored, "complete"), 2)
    assert [tuple(r) for r in out.select("word", "n", "score").collect()] == [("day", 1, 6), ("good", 2, 6)]


def test_stateful_sessions_close_on_timeout(spark, folder):
    put(spark, folder, [(1, "x", 0), (1, "x", 2)])
    put(spark, folder, [(1, "x", 3), (2, "x", 60)])
    put(spark, folder, [(2, "x", 61)])
    out = run.to_table(stateful.stateful_sessions(stream(spark, folder), "ts", "u", 300, delay="1 minute"), "update")
    closed = out.where("closed").select("key", "n_events", ((F.col("last_us") - F.col("first_us")) / 60_000_000).alias("m"))
    assert rows(closed) == [("1", 3, 3.0)]
    assert out.where("key = '2'").agg(F.max("n_events")).first()[0] == 2


def test_unknown_mode(spark, folder):
    put(spark, folder, [(1, "x", 0)])
    with pytest.raises(ValueError):
        run.to_table(stream(spark, folder), "other")


def test_stateful_sessions_like_batch(spark, folder):
    """Gaps inside one batch close sessions, late rows join two, rows without a time are left out."""
    put(spark, folder, [(1, "x", 0), (1, "x", 2), (1, "x", 30), (1, "x", 90), (2, "x", 5), (3, "x", None)])
    put(spark, folder, [(1, "x", 86), (1, "x", 82), (2, "x", 6), (2, "x", 200)])
    put(spark, folder, [(1, "x", 300)])
    changes = run.to_table(stateful.stateful_sessions(stream(spark, folder), "ts", "u", 300, delay="4 hours"), "update")
    start = F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    found = stateful.last_versions(changes).select(
        "key", (F.col("first_us") / 60_000_000 - start / 60).cast("int"), (F.col("last_us") / 60_000_000 - start / 60).cast("int"), "n_events"
    )
    assert rows(found) == [
        ("1", 0, 2, 2), ("1", 30, 30, 1), ("1", 300, 300, 1), ("1", 82, 90, 3), ("2", 200, 200, 1), ("2", 5, 6, 2)
    ]


def test_latest_versions_of_windows(spark, folder):
    put(spark, folder, [(1, "x", 1), (1, "x", 26)])
    put(spark, folder, [(1, "x", 27), (1, "x", 3)])
    changes = run.to_table(counts.windowed_counts(stream(spark, folder), "ts", "10 minutes", delay="1 hour"), "update")
    found = run.latest(changes, ["window_start"], ["n"])
    assert rows(found.select(F.date_format("window_start", "HH:mm"), "n")) == [("00:00", 2), ("00:20", 2)]
