import pytest
from pyspark.sql import functions as F, types as T

from agoralens.sources import ingest, scratch, tables
from agoralens.sources.schemas import COMMENTS, LEXICON, conform, require_columns
from tests.conftest import plan, rows


def test_contract(spark):
    df = spark.createDataFrame([("joy",)], "emotion string")
    with pytest.raises(ValueError, match="word"):
        require_columns(df, LEXICON)
    raw = spark.createDataFrame([("c1", "s", "a", "b", "p", "l", "7", "x", "0", "12", "extra")],
                                [*COMMENTS.names, "other"])
    got = conform(raw, COMMENTS)
    assert got.schema == COMMENTS
    assert (got.first().score, got.first().controversiality) == (7, None)


def test_ingest_keeps_only_available_columns(spark):
    df = spark.createDataFrame([("a", 1, 86_400), ("b", 2, 0), (None, 3, 0)], "subreddit string, id int, created_utc long")
    got = ingest.filter_and_project(df, ["a"], ["id", "missing", "created_utc"])
    assert got.columns == ["id", "created_utc", "date"]
    assert str(got.first().date) == "1970-01-02"


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_round_trip(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, "x y", 2.5), (2, None, -1.0)], "id int, t string, v double")
    path = str(tmp_path / fmt)
    options = {"header": "true"} if fmt == "csv" else {}
    tables.write_table(df, path, fmt=fmt, **options)
    assert rows(tables.read_table(spark, path, df.schema, fmt=fmt, schema=df.schema, **options)) == rows(df)


def test_text_format(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.createDataFrame([("a b",)], "value string"), path, fmt="text")
    assert rows(tables.read_table(spark, path, fmt="text")) == [("a b",)]


def test_many_paths_globs_and_merged_schemas(spark, tmp_path):
    template = str(tmp_path / "trips-{year}-{month:02d}")
    paths = tables.monthly_paths(template, [(2021, 1), (2021, 2)])
    assert paths[1].endswith("trips-2021-02")
    spark.range(2).write.parquet(paths[0])
    spark.range(3).withColumn("tip", F.lit(1.0)).write.parquet(paths[1])
    both = tables.read_table(spark, paths, merge_schema=True)
    assert both.count() == 5 and set(both.columns) == {"id", "tip"}
    assert tables.read_table(spark, str(tmp_path / "trips-*")).count() == 5
    assert tables.read_table(spark, str(tmp_path), recursiveFileLookup="true").count() == 5


def test_month_range_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    months = spark.createDataFrame([(2023, 12), (2024, 1), (2024, 2)], "yyyy int, mm int").withColumn("n", F.lit(1))
    tables.write_table(months, path, partition_by=["yyyy", "mm"])
    kept = tables.read_months(spark, path, (2023, 12), (2024, 1))
    assert kept.count() == 2
    assert "PartitionFilters: []" not in plan(kept)


def test_lexicon_by_position(spark, tmp_path):
    path = tmp_path / "lexicon.txt"
    path.write_text("abandon\tfear\t1\nabandon\tjoy\t0\n")
    assert rows(tables.read_lexicon(spark, str(path))) == [("abandon", "fear")]
    assert tables.read_lexicon(spark, str(path), flagged_only=False).count() == 2


def test_report_is_one_file(spark, tmp_path):
    df = spark.range(10).repartition(4)
    tables.write_report_csv(df, str(tmp_path / "csv"))
    tables.write_report_parquet(df, str(tmp_path / "pq"))
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 1
    assert len(list((tmp_path / "pq").glob("*.parquet"))) == 1
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 10


def test_bucketed_join_needs_no_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 50)
    tables.write_bucketed(df.repartition(4, "k"), "bucketed_a", ["k"], 4)
    tables.write_bucketed(df.repartition(4, "k"), "bucketed_b", ["k"], 4)
    joined = spark.table("bucketed_a").hint("merge").join(spark.table("bucketed_b"), "k")
    assert "Exchange" not in plan(joined) and joined.count() == 20_000
    spark.sql("DROP TABLE bucketed_a")
    spark.sql("DROP TABLE bucketed_b")


def test_small_tables_are_spread_and_large_ones_are_not(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).repartition(2).write.parquet(path)
    assert "Exchange" in plan(tables.spread_few_files(spark.read.parquet(path), "id"))
    assert "Exchange" not in plan(tables.spread_few_files(spark.range(0, 100, 1, 9), "id"))


def test_range_view_and_arithmetic(spark):
    spark.range(1000).createOrReplaceTempView("numbers")
    assert spark.sql("SELECT count(*) FROM numbers").first()[0] == 1000
    even = spark.table("numbers").where(F.col("id") % 2 == 0).select((F.col("id") * 2).alias("d"))
    assert (even.count(), even.agg(F.max("d")).first()[0]) == (500, 1996)
    spark.range(3).createOrReplaceGlobalTempView("shared_numbers")
    assert spark.newSession().sql("SELECT count(*) FROM global_temp.shared_numbers").first()[0] == 3


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert scratch.shared_folder(spark) == folder
    assert scratch.new_folder(spark, "x").startswith(folder)
    assert scratch.new_folder(spark, "x") != scratch.new_folder(spark, "x")
    stored = scratch.cut_lineage(spark.range(5).withColumn("x", F.rand(1)))
    assert "ExistingRDD" in plan(stored) and rows(stored) == rows(stored)


def test_stream_reads_a_single_file_and_a_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).coalesce(1).write.parquet(path)
    file = str(next((tmp_path / "t").glob("*.parquet")))
    schema = T.StructType([T.StructField("id", T.LongType())])
    from agoralens.streaming.run import to_table

    for source in (path, file):
        assert rows(to_table(tables.read_table_stream(spark, source, schema))) == [(i,) for i in range(5)]


def test_unparsed_values_are_counted(spark):
    from pyspark.sql import types as T

    from agoralens.sources import schemas

    contract = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    df = spark.createDataFrame([("1", "x"), ("one", "y"), (None, "z")], "a string, b string")
    assert schemas.unparsed(df, contract).first().asDict() == {"a": 1, "b": 0}
    assert schemas.conform(df, contract).where("a IS NULL").count() == 2


def test_stored_tables_are_cleared(spark):
    import os

    df = scratch.stored(spark.range(10), "cleared")
    folder = df.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert df.count() == 10 and os.path.isdir(folder)
    scratch.clear(spark)
    assert not os.path.exists(folder)


def test_scratch_drops_what_is_not_needed(spark):
    """Tables that a result still reads stay, also empty ones."""
    import os


    tables = scratch.Scratch(spark)
    first, second = tables.stored(spark.range(3), "a"), tables.stored(spark.range(0), "b")
    tables.stored(spark.range(5), "c")
    folders = [folder for folder, _ in tables.tables]
    before = scratch.made_so_far()
    tables.drop(first, second)
    assert [os.path.exists(f) for f in folders] == [True, True, False] and scratch.made_so_far() == before - 1
    assert first.count() == 3 and second.count() == 0
    tables.drop()
    assert not any(os.path.exists(f) for f in folders)
