import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from agoralens.operators import comoments
from agoralens.sources import drift, incremental
from tests.conftest import rows


@pytest.fixture
def place(spark, tmp_path):
    class Place:
        source, target, manifest = (str(tmp_path / n) for n in ("in", "table", "manifest"))

        def drop_off(self, name, data):
            df = spark.createDataFrame(data, "id int, day date")
            df.coalesce(1).write.mode("overwrite").parquet(f"{self.source}/{name}")

        def ingest(self, **options):
            return incremental.ingest_new(spark, self.source, self.target, self.manifest, "day", **options)

        def found(self):
            return rows(spark.read.parquet(self.target).select("id", "yyyy", "mm"))

        def months(self):
            files = spark.read.parquet(self.target).select("_metadata.file_path", "_metadata.file_modification_time", "yyyy", "mm").distinct().collect()
            return {(r.yyyy, r.mm): max(f.file_modification_time for f in files if (f.yyyy, f.mm) == (r.yyyy, r.mm)) for r in files}

    return Place()


def day(month, n=1):
    return dt.date(2024, month, n)


def test_only_new_files_and_their_months(place):
    place.drop_off("a", [(1, day(1)), (2, day(2))])
    assert len(place.ingest()) == 1
    before = place.months()
    assert place.ingest() == []
    place.drop_off("b", [(3, day(2, 5)), (4, day(3)), (5, None)])
    assert len(place.ingest()) == 1
    assert place.found() == [(1, 2024, 1), (2, 2024, 2), (3, 2024, 2), (4, 2024, 3), (5, None, None)]
    after = place.months()
    assert after[2024, 1] == before[2024, 1] and after[2024, 2] > before[2024, 2]


def test_changed_files_replace_their_rows(place):
    place.drop_off("a", [(1, day(1)), (2, day(2))])
    place.drop_off("b", [(3, day(2))])
    place.ingest()
    place.drop_off("b", [(4, day(3)), (5, day(3))])  # other files under the same folder
    place.ingest()
    # A file that vanished keeps its rows, one that is read again does not double them.
    assert place.found() == [(1, 2024, 1), (2, 2024, 2), (3, 2024, 2), (4, 2024, 3), (5, 2024, 3)]


def test_run_that_failed_before_its_manifest_entry(spark, place, monkeypatch):
    place.drop_off("a", [(1, day(1)), (2, day(2))])
    place.ingest()
    place.drop_off("b", [(3, day(2))])

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "read_so_far", lambda spark, manifest, _real=incremental.read_so_far, _calls=[]: (_calls.append(1), broken() if len(_calls) > 1 else _real(spark, manifest))[1])
        with pytest.raises(RuntimeError):
            place.ingest()
    assert len(place.ingest()) == 1 and place.found() == [(1, 2024, 1), (2, 2024, 2), (3, 2024, 2)]


def test_prepare_filters_rows(place):
    place.drop_off("a", [(1, day(1)), (2, day(2))])
    place.ingest(prepare=lambda df: df.where("id > 1"))
    assert place.found() == [(2, 2024, 2)]


# ---- layouts ---------------------------------------------------------------------------------


def test_wider():
    i, l, d, f, s = T.IntegerType(), T.LongType(), T.DoubleType(), T.FloatType(), T.StringType()
    assert [drift.wider(i, l), drift.wider(l, d), drift.wider(f, d), drift.wider(f, l), drift.wider(i, s)] == [l, d, d, d, None]
    assert drift.wider(T.DateType(), T.TimestampType()) == T.TimestampType() and drift.wider(T.DateType(), i) is None


def test_fold_schemas():
    def schema(text):
        return T._parse_datatype_string(text)

    folded = drift.fold_schemas([schema("a string, b int"), schema("b long, c date"), schema("a double, d void"), schema("b string")])
    assert folded.simpleString() == "struct<a:double,b:bigint,c:date,d:void>"
    fixed = drift.fold_schemas([schema("a double, b int")], schema("a string"))
    assert fixed.simpleString() == "struct<a:string,b:int>"


def test_read_drifting(spark, tmp_path):
    data = [
        ([(1, 10)], "id int, n int"), ([(2, 2**40, "x")], "id long, n long, note string"),
        ([("3", "many", None), ("x", None, None)], "id string, n string, note string"),
    ]
    folders = []
    for k, (values, schema) in enumerate(data):
        folders.append(str(tmp_path / f"p{k}"))
        spark.createDataFrame(values, schema).write.parquet(folders[-1])
    df = drift.read_drifting(spark, folders)
    assert df.columns == ["id", "n", "note", "misfits"]
    got = sorted(((r.id, r.n, r.note, r.misfits) for r in df.collect()), key=str)
    assert got == sorted([(1, 10, None, None), (2, 2**40, "x", None), (3, None, None, {"n": "many"}), (None, None, None, {"id": "x"})], key=str)


# ---- co-moments ------------------------------------------------------------------------------


def pairs(spark, shift):
    return spark.range(900).select(
        F.timestamp_add("HOUR", (F.col("id") * 5).cast("int"), F.lit("2024-01-01").cast("timestamp")).alias("created"),
        (F.pmod(F.xxhash64("id"), F.lit(100)) + shift).cast("double").alias("x"),
        (F.pmod(F.xxhash64("id"), F.lit(100)) * 2 + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(50)) + shift).cast("double").alias("y"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("kind"),
    )


@pytest.mark.parametrize("shift", [0, 10**9])
def test_periods_like_one_pass(spark, shift):
    """Also where raw sums of squares have no digits left for the spread."""
    df = pairs(spark, shift)
    days = comoments.day_moments(df, "x", "y", by=["kind"])
    month = F.date_trunc("month", "date").cast("date")
    got = {(r.period, r.kind): r for r in comoments.described(comoments.over_periods(days, month, ["kind"])).collect()}
    exact = df.groupBy(F.date_trunc("month", "created").cast("date").alias("period"), "kind").agg(
        F.count("*").alias("n"), F.avg(F.col("x") - shift).alias("m"), F.stddev_samp(F.col("x") - shift).alias("s"), F.corr(F.col("x") - shift, F.col("y") - shift).alias("c")
    ).collect()
    assert len(exact) == len(got) > 10
    for r in exact:
        o = got[r.period, r.kind]
        assert o.n == r.n and o.mean_x - shift == pytest.approx(r.m, abs=1e-5)
        assert o.std_x == pytest.approx(r.s, rel=1e-6) and o["corr"] == pytest.approx(r.c, abs=1e-6)


def test_rolling_and_odd_rows(spark):
    d = dt.datetime
    data = [(d(2024, 1, 1), 1.0, 2.0), (d(2024, 1, 2), 3.0, 5.0), (d(2024, 1, 4), 4.0, 1.0), (d(2024, 1, 4), None, 1.0), (None, 1.0, 1.0)]
    days = comoments.day_moments(spark.createDataFrame(data, "created timestamp, x double, y double"), "x", "y")
    got = {r.date.day: r for r in comoments.described(comoments.rolling(days, 3)).collect()}
    assert {k: (r.n, r.mean_x) for k, r in got.items()} == {1: (1, 1.0), 2: (2, 2.0), 4: (2, 3.5)}
    assert got[1].std_x is None and got[1]["corr"] is None and got[2]["corr"] == pytest.approx(1.0) and got[4]["corr"] == pytest.approx(-1.0)
    assert comoments.over_periods(days.limit(0), F.lit(1)).count() == 0
