import random

import pandas as pd
from pyspark.sql import functions as F

from agoralens.operators import sequences
from tests.conftest import rows


def events(spark, n=3000, seed=4):
    """A third of the rows belong to user 0."""
    pick = random.Random(seed)
    data = [(0 if pick.random() < 1 / 3 else pick.randrange(1, 30), pick.randrange(0, 2_000_000), i) for i in range(n)]
    df = spark.createDataFrame(data, "u int, s int, v int")
    return df.select("u", F.timestamp_seconds("s").alias("ts"), "v")


def test_sessions_equal_session_windows(spark):
    df = events(spark)
    got = sequences.sessions(df, ["u"], "ts", 600).select("u", "session_start", "session_end", "n_events")
    window = df.groupBy("u", F.session_window("ts", "10 minutes").alias("w")).agg(F.count("*").alias("n"))
    assert rows(got) == rows(window.select("u", "w.start", "w.end", "n"))


def test_rows_exactly_the_gap_apart_stay_together(spark):
    df = spark.sql("SELECT 1 u, explode(array(timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 00:10:00', timestamp'2024-01-01 00:20:01')) ts")
    got = sequences.sessions(df, ["u"], "ts", 600).collect()
    assert sorted((r.n_events, r.duration_seconds) for r in got) == [(1, 600.0), (2, 1200.0)]


def test_asof_join_against_pandas(spark):
    left, right = events(spark, 800, 1), events(spark, 300, 2).withColumnRenamed("v", "w")
    got = sequences.asof_join(left, right, ["u"], "ts", ["w"], slot_seconds=5000).toPandas()
    marks = right.groupBy("u", "ts").agg(F.max("w").alias("w")).toPandas().sort_values("ts")
    want = pd.merge_asof(left.toPandas().sort_values("ts"), marks, on="ts", by="u")
    keys = ["u", "ts", "v"]
    got, want = (d.sort_values(keys).reset_index(drop=True)[[*keys, "w"]] for d in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_asof_join_at_equal_time_and_without_match(spark):
    left = spark.sql("SELECT explode(array(timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 01:00:00')) ts, 1 u, 5 v")
    right = spark.sql("SELECT timestamp'2024-01-01 01:00:00' ts, 1 u, 9 w")
    got = sequences.asof_join(left, right, ["u"], "ts", ["w"]).orderBy("ts").collect()
    assert [r.w for r in got] == [None, 9] and [r.v for r in got] == [5, 5]
