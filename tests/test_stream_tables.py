"""Sessions with timers, keyed tables and late rows, across restarts."""

import pytest
from pyspark.sql import functions as F

from agoralens.streaming import counts, run, timers, upsert
from tests.conftest import rows
from tests.test_streaming import folder, put, stream  # noqa: F401


def minutes(df):
    minute = lambda c: ((F.col(c) / 1_000_000 - F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"))) / 60).cast("int")
    return rows(df.select("key", minute("first_us"), minute("last_us"), "n_events"))


def test_timed_sessions(spark, folder, tmp_path):  # noqa: F811
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def go():
        with timers.rocks_state(spark):
            run.append_to_table(timers.timed_sessions(stream(spark, folder), "ts", "u", 300, delay="2 minutes"), path, checkpoint)
        return minutes(spark.read.parquet(path)), minutes(timers.open_sessions(spark, checkpoint))

    put(spark, folder, [(1, "x", 0), (1, "x", 4), (2, "x", 1), (3, "x", 20)])
    put(spark, folder, [(1, "x", 21), (3, "x", 24)])
    assert go() == ([("1", 0, 4, 2), ("2", 1, 1, 1)], [("1", 21, 21, 1), ("3", 20, 24, 2)])
    # After a restart open sessions go on, late rows join two of them, and timers still fire.
    put(spark, folder, [(1, "x", 27), (3, "x", 29)])
    put(spark, folder, [(1, "x", 25), (4, "x", 60), (None, "x", 60)])
    closed, still = go()
    assert closed == [("1", 0, 4, 2), ("1", 21, 27, 3), ("2", 1, 1, 1), ("3", 20, 29, 3)]
    assert still == [("4", 60, 60, 1), (None, 60, 60, 1)]
    assert spark.conf.get(timers.PROVIDER, "") != timers.ROCKS


@pytest.mark.parametrize("every", [2, 50])
def test_keyed_table(spark, folder, tmp_path, every):  # noqa: F811
    """Counts across stops in the middle, repeated batches and compaction."""
    for n in range(5):
        put(spark, folder, [(n % 2, "x", n), (7, "y", n)])
    table = upsert.KeyedTable(spark, str(tmp_path / "table"), ["u"], every)
    checkpoint = str(tmp_path / "checkpoint")
    assert table.rows() is None

    def go(**options):
        upsert.upsert(counts.running_counts(stream(spark, folder), "u"), table, checkpoint, **options)
        return rows(table.rows().select("u", "n"))

    assert go(stop_before=2) == [(0, 1), (1, 1), (7, 2)]
    assert go(stop_before=4) == [(0, 2), (1, 2), (7, 4)]
    assert go() == [(0, 3), (1, 2), (7, 5)]
    changes = upsert._batches(spark, f"{table.folder}/change")
    assert len(changes) == (1 if every == 2 else 5)
    # A batch that comes again changes nothing, whether it was compacted or not.
    again = spark.createDataFrame([(0, 3), (7, 5)], "u int, n long")
    table.put(again, 4)
    table.put(spark.createDataFrame([(7, 99)], "u int, n long"), 0) if every == 2 else None
    assert rows(table.rows().select("u", "n")) == [(0, 3), (1, 2), (7, 5)]


def test_late_rows(spark, folder, tmp_path):  # noqa: F811
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def go():
        upsert.split_late(stream(spark, folder), "ts", out, checkpoint, delay_seconds=300)
        minute = F.minute("ts")
        return [rows(upsert.late_rows(spark, out, w).select("u", minute)) for w in ("kept", "late")]

    put(spark, folder, [(1, "x", 10), (2, "x", 1)])
    put(spark, folder, [(3, "x", 5), (4, "x", 4), (5, "x", 30), (None, "x", None)])
    assert go() == [[(1, 10), (2, 1), (3, 5), (5, 30)], [(4, 4), (None, None)]]
    put(spark, folder, [(6, "x", 26), (7, "x", 24)])
    kept, late = go()
    assert kept[-1] == (6, 26) and late == [(4, 4), (7, 24), (None, None)]
    seen = upsert.late_rows(spark, out, "seen").agg(F.sum("n"), F.sum("n_late")).first()
    assert tuple(seen) == (len(kept) + len(late), len(late))


def test_what_spark_drops_is_late(spark, folder, tmp_path):  # noqa: F811
    """A windowed count with the same delay counts all that is kept."""
    put(spark, folder, [(1, "x", 3), (1, "x", 40)])
    put(spark, folder, [(1, "x", 4), (1, "x", 36), (1, "x", 90)])
    put(spark, folder, [(1, "x", 200)])
    upsert.split_late(stream(spark, folder), "ts", str(tmp_path / "out"), str(tmp_path / "c1"), delay_seconds=300)
    table = upsert.KeyedTable(spark, str(tmp_path / "table"), ["window_start", "window_end"])
    upsert.upsert(counts.windowed_counts(stream(spark, folder), "ts", "1 minute", delay="5 minutes"), table, str(tmp_path / "c2"))
    kept = upsert.late_rows(spark, str(tmp_path / "out"), "kept")
    per_minute = kept.groupBy(F.window("ts", "1 minute").start.alias("window_start")).agg(F.count("*").alias("n"))
    counted = {r.window_start: r.n for r in table.rows().collect()}
    assert kept.count() == 5 and all(counted[r.window_start] >= r.n for r in per_minute.collect())


def test_timed_sessions_set_one_timer_per_key():
    """However many sessions of a key are open, a batch sets at most one timer, and one value is kept."""
    calls, state = [], {}

    class Handle:
        def getValueState(self, name, schema):  # noqa: N802
            return type("Value", (), {
                "get": lambda _: state.get(name), "update": lambda _, v: state.update({name: v}), "clear": lambda _: state.pop(name, None),
            })()

        def registerTimer(self, end):  # noqa: N802
            calls.append(end)

        def deleteTimer(self, end):  # noqa: N802
            calls.remove(end)

    class Now:
        def __init__(self, ms):
            self.ms = ms

        def getCurrentWatermarkInMs(self):  # noqa: N802
            return self.ms

        getExpiryTimeInMs = getCurrentWatermarkInMs  # noqa: N815

    sessions = timers.Sessions(1_000)
    sessions.init(Handle())
    pieces = [{"first_us": i * 10_000, "last_us": i * 10_000, "n_events": 1} for i in range(50)]
    assert not list(sessions.handleInputRows(("a",), iter(pieces), Now(0)))
    assert not list(sessions.handleInputRows(("a",), iter(pieces[10:20]), Now(0)))
    assert calls == [2] and len(state["open"][0]) == 50
    calls.remove(2)  # It fires late: all sessions that are over go at once.
    closed = list(sessions.handleExpiredTimer(("a",), Now(152), Now(2)))
    assert [r.first_us for r in closed] == [i * 10_000 for i in range(16)] and sum(r.n_events for r in closed) == 22
    assert calls == [162] and len(state["open"][0]) == 34
    assert len(list(sessions.handleExpiredTimer(("a",), Now(10_000), Now(162)))) == 34
    assert "open" not in state
