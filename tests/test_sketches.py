import datetime as dt

from pyspark.sql import functions as F

from agoralens.operators import sketches


def visits(spark, n=20_000, people=3_000):
    """Two kinds of rows over 40 days; persons overlap between the kinds in a known way."""
    return spark.range(n).select(
        F.pmod(F.col("id") * 7919, F.lit(people)).alias("person"),
        F.timestamp_add("DAY", (F.col("id") % 40).cast("int"), F.lit("2024-01-01 05:00:00").cast("timestamp")).alias("created"),
        F.when(F.pmod(F.col("id") * 7919, F.lit(people)) < people // 3, F.when(F.col("id") % 2 == 0, "post").otherwise("comment")).otherwise("comment").alias("kind"),
        (F.pmod(F.xxhash64("id"), F.lit(10_000)) / 10).alias("score"),
    )


def month(column="date"):
    return F.date_trunc("month", column).cast("date")


def test_people(spark):
    df = visits(spark)
    exact = {(r.period, r.kind): r.n for r in df.groupBy(month("created").alias("period"), "kind").agg(F.count_distinct("person").alias("n")).collect()}
    for bits in (5, 12):
        days = sketches.people_sketches(df, "person", by=["kind"], bits=bits)
        united = sketches.people_over(days, month(), ["kind"], bits).withColumn("people", sketches.estimated("people")).collect()
        assert len(united) == 4 and sum(r.n for r in united) == 20_000
        for r in united:
            n = exact[r.period, r.kind]
            assert abs(r.people - n) <= sketches.theta_error(bits) * n + 1
            assert r.people == n or n >= 2**bits


def test_active_in_both(spark):
    df = visits(spark)
    united = sketches.people_over(sketches.people_sketches(df, "person", by=["kind"]), F.lit(1), ["kind"])
    r = sketches.active_in_both(united, "kind", "post", "comment").first()
    per = df.groupBy("person").agg(F.size(F.collect_set("kind")).alias("k"))
    both, either = per.where("k = 2").count(), per.count()
    assert (r.both, r.either) == (both, either)  # fewer than a sketch keeps
    alone = sketches.active_in_both(united.where("kind = 'post'"), "kind", "post", "comment").first()
    assert alone.both == 0 and alone.second == 0 and alone.either == alone.first > 0


def test_missing_values(spark):
    rows = [(None, dt.datetime(2024, 1, 1), None), (1, None, 2.0), (1, dt.datetime(2024, 1, 1), 3.0)]
    df = spark.createDataFrame(rows, "person long, created timestamp, score double")
    day = sketches.people_sketches(df, "person").withColumn("people", sketches.estimated("people")).collect()
    assert [(r.n, r.people) for r in day] == [(2, 1)]
    assert sketches.value_sketches(df, "score").select("n").collect()[0].n == 1
    assert sketches.people_sketches(df.limit(0), "person").count() == 0


def test_quantiles(spark):
    df = visits(spark)
    days = sketches.value_sketches(df, "score", size=64)
    merged = sketches.values_over(days, month(), size=64)
    found = sketches.rank_errors(df, "score", month("created"), sketches.sketched_quantiles(merged, [0.1, 0.5, 0.99])).collect()
    assert len(found) == 6 and sum(r.n for r in found) == 3 * 20_000
    assert all(r.rank_error <= sketches.kll_error(64) for r in found)
    assert sketches.kll_error(400) < sketches.kll_error(200) < 0.03


def test_rank_errors_of_known_values(spark):
    """A quantile inside a run of equal values has no error; one far away has its distance."""
    df = spark.range(100).select(F.lit(0).alias("g"), F.when(F.col("id") < 50, 1.0).otherwise(F.col("id")).alias("v"))
    asked = spark.createDataFrame([(0, 0.3, 1.0), (0, 0.5, 90.0)], "period int, probability double, value double")
    got = {r.probability: r.rank_error for r in sketches.rank_errors(df, "v", F.col("g"), asked).collect()}
    assert got[0.3] == 0.0 and abs(got[0.5] - 0.4) < 1e-9
