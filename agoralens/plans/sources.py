"""Incremental ingest, drifting layouts, file formats and mergeable moments on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralens.functions.keys import md5_bucket
from agoralens.operators import comoments
from agoralens.plans import roles
from agoralens.plans.overview import settled
from agoralens.plans.registry import question
from agoralens.sources import drift, incremental, tables
from agoralens.sources.scratch import new_folder, stored


@question("""
SELECT year(o_orderdate)::int AS yyyy, month(o_orderdate)::int AS mm, count(*) AS n, round(sum(o_totalprice) + 1e-9, 2) AS total
FROM orders GROUP BY 1, 2""")
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that arrive in two drops; the second run reads only the second one's files."""
    folder = new_folder(spark, "ingest")
    orders = roles.table(spark, sf_dir, "orders").withColumn("drop", md5_bucket("o_orderkey", 3, "drop"))
    orders = stored(orders, "drops")
    for late in (False, True):
        rows = orders.where((F.col("drop") == 2) == F.lit(late)).drop("drop")
        rows.write.parquet(f"{folder}/in/drop={int(late)}")
        incremental.ingest_new(spark, f"{folder}/in", f"{folder}/table", f"{folder}/manifest", "o_orderdate")
    months = spark.read.parquet(f"{folder}/table").groupBy("yyyy", "mm")
    return settled(months.agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total")), 2, "total")


@question("""
WITH dealt AS (SELECT *, ('0x' || substr(md5(o_orderkey::varchar || 'layout'), 1, 8))::bigint % 3 AS layout FROM orders)
SELECT layout::int AS layout, count(*) AS n, sum(o_orderkey)::bigint AS keys,
  round(coalesce(sum(CASE WHEN layout < 2 OR o_orderkey % 10 <> 0 THEN CASE layout WHEN 0 THEN floor(o_totalprice) ELSE o_totalprice END END), 0) + 1e-9, 2) AS price,
  count(*) FILTER (layout = 2 AND o_orderkey % 10 = 0) AS misfits, count(*) FILTER (layout = 1) AS with_author
FROM dealt GROUP BY 1""")
def drifting_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three layouts of one table: whole prices, exact prices with authors, prices as text with misfits."""
    orders = roles.table(spark, sf_dir, "orders").withColumn("layout", md5_bucket("o_orderkey", 3, "layout"))
    orders = stored(orders.select("o_orderkey", "o_custkey", "o_totalprice", "layout"), "layouts")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    layouts = [
        orders.where("layout = 0").select(key.cast("int").alias("id"), F.floor(price).cast("int").alias("price"), "layout"),
        orders.where("layout = 1").select(key.alias("id"), price.alias("price"), F.col("o_custkey").alias("author"), "layout"),
        orders.where("layout = 2").select(
            "layout", F.when(key % 10 == 0, F.concat(F.lit("EUR "), price)).otherwise(price.cast("string")).alias("price"), key.alias("id")
        ),
    ]
    folders = []
    for df in layouts:
        folders.append(new_folder(spark, "layout"))
        df.write.parquet(folders[-1])
    rows = drift.read_drifting(spark, folders)
    out = rows.groupBy("layout").agg(
        F.count("*").alias("n"), F.sum("id").alias("keys"), F.coalesce(F.sum("price"), F.lit(0.0)).alias("price"),
        F.count(F.col("misfits")["price"]).alias("misfits"), F.count("author").alias("with_author"),
    )
    return settled(out, 2, "price")


@question("""
WITH said AS (SELECT event_id, event_type, user_id, value FROM events)
SELECT unnest(['csv', 'json', 'orc', 'text']) AS format, count(*) AS n, sum(user_id)::bigint AS users,
  round(sum(value) + 1e-9, 2) AS total, count(DISTINCT event_type) AS kinds FROM said""")
def format_round_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written and read back as CSV, JSON, ORC and lines of text."""
    events = stored(roles.table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "value"), "events")
    out = None
    for fmt in ("csv", "json", "orc", "text"):
        folder = new_folder(spark, fmt)
        rows = events.select(F.to_json(F.struct(*events.columns)).alias("value")) if fmt == "text" else events
        tables.write_table(rows, folder, fmt=fmt)
        if fmt == "text":
            back = tables.read_table(spark, folder, fmt=fmt)
            back = back.select(F.from_json("value", events.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")).alias("e")).select("e.*")
        else:
            back = tables.read_table(spark, folder, fmt=fmt, schema=events.schema)
        part = back.select(F.lit(fmt).alias("format"), "*").groupBy("format").agg(
            F.count("*").alias("n"), F.sum("user_id").alias("users"), F.sum("value").alias("total"), F.count_distinct("event_type").alias("kinds")
        )
        out = part if out is None else out.unionByName(part)
    return settled(out, 2, "total")


@question("SELECT o_orderkey * 2 AS doubled FROM orders WHERE o_orderkey % 2 = 0")
def even_keys_doubled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select((F.col("o_orderkey") * 2).alias("doubled"))


_FIGURES = ("mean_x", "mean_y", "std_x", "std_y", "corr")


def _figures_sql(prefix: str = "") -> str:
    found = {
        "mean_x": "avg(x)", "mean_y": "avg(y)", "std_x": "stddev_samp(x)", "std_y": "stddev_samp(y)",
        "corr": "CASE WHEN stddev_pop(x) > 0 AND stddev_pop(y) > 0 THEN corr(x, y) END",
    }
    return "count(*) AS n, " + ", ".join(f"round({sql} + 1e-9, 5) AS {name}" for name, sql in found.items())


_PAIRS = """pairs AS (
  SELECT l_shipdate::DATE AS date, l_quantity::DOUBLE AS x, l_extendedprice::DOUBLE AS y FROM lineitem)"""


def _pair_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length and score of comments per day, once."""
    return stored(comoments.day_moments(roles.comments(spark, sf_dir), "length", "score"), "days")


@question(f"""
WITH {_PAIRS}
SELECT unit, period, {_figures_sql()} FROM (
  SELECT 'month' AS unit, date_trunc('month', date)::DATE AS period, x, y FROM pairs
  UNION ALL SELECT 'quarter', date_trunc('quarter', date)::DATE, x, y FROM pairs) GROUP BY 1, 2""")
def merged_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length against score per month and quarter, both from the same daily moments."""
    days = _pair_days(spark, sf_dir)
    parts = [
        comoments.over_periods(days, F.date_trunc(unit, "date").cast("date")).select(F.lit(unit).alias("unit"), "*")
        for unit in ("month", "quarter")
    ]
    return settled(comoments.described(parts[0].unionByName(parts[1])), 5, *_FIGURES)


@question(f"""
WITH {_PAIRS}, days AS (SELECT DISTINCT date FROM pairs)
SELECT d.date, {_figures_sql()} FROM days d JOIN pairs p ON p.date BETWEEN d.date - 29 AND d.date GROUP BY 1""")
def rolling_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length against score over the last 30 days, for every day."""
    return settled(comoments.described(comoments.rolling(_pair_days(spark, sf_dir), 30)), 5, *_FIGURES)
