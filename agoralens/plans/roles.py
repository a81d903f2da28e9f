"""Which test table plays which forum table, in Spark and in SQL.

posts          orders, with the number of their line items as comments
comments       lineitem
activity       events
text posts     documents; author, score, comments and time come from the event with the same key
text comments  conversations; score, time and flags come from the event numbered by place
lexicon        words of the benchmark texts, with emotions chosen by word length
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralens.functions.text import document_text
from agoralens.operators.emotion import EMOTIONS
from agoralens.sources.tables import read_table, spread_few_files

# Ordered stand-in rules for invented words.
DEMO_TOPIC_RULES = (("the", "the.?re|tion"), ("ing", "ing"), ("ou", "ou"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("link_id"),
        F.col("l_suppkey").alias("author"),
        F.col("l_suppkey").alias("community"),
        F.col("l_extendedprice").alias("score"),
        F.col("l_quantity").alias("length"),
        (F.col("l_returnflag") == "R").cast("int").alias("controversiality"),
        F.col("l_shipdate").alias("created"),
    )


def bare_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts without the comment count, for questions that do not need it."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("author"),
        F.col("o_orderpriority").alias("topic"),
        F.col("o_custkey").alias("community"),
        F.col("o_totalprice").alias("score"),
        F.col("o_orderdate").alias("created"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.count("*").alias("num_comments")
    )
    return bare_posts(spark, sf_dir).join(counts, "id", "left").fillna(0, subset=["num_comments"])


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumnRenamed("ts", "created")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_few_files(table(spark, sf_dir, "documents"), "doc_id")


def post_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("community"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("selftext"),
    )


def post_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything about text posts but their text. Narrow, so joins carry no text."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("author"),
        F.col("user_id").alias("score"),
        F.floor("value").cast("int").alias("num_comments"),
        F.col("ts").alias("created"),
    )


def comment_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments as written, with the `place` their facts are found under."""
    said = table(spark, sf_dir, "conversations")
    place = F.concat_ws("_", "conv_id", "turn")
    before = F.concat_ws("_", F.lit("t1"), "conv_id", F.col("turn") - 1)
    return said.select(
        place.alias("id"),
        F.concat(F.lit("t3_"), "conv_id").alias("link_id"),
        F.when(F.col("turn") == 0, F.concat(F.lit("t3_"), "conv_id"))
        .otherwise(before)
        .alias("parent_id"),
        F.col("role").alias("author"),
        F.col("text").alias("body"),
        (F.col("conv_id") * 8 + F.col("turn")).alias("place"),
    )


def comment_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything about text comments but their text."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("place"),
        F.floor("value").cast("int").alias("score"),
        (F.col("event_type") == "error").cast("int").alias("controversiality"),
        (F.col("event_type") == "purchase").cast("int").alias("gilded"),
        F.col("ts").alias("created"),
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only ids, authors and parents of text comments."""
    said = table(spark, sf_dir, "conversations")
    first = F.concat(F.lit("t3_"), "conv_id")
    before = F.concat_ws("_", F.lit("t1"), "conv_id", F.col("turn") - 1)
    return said.select(
        F.concat_ws("_", "conv_id", "turn").alias("id"),
        F.when(F.col("turn") == 0, first).otherwise(before).alias("parent_id"),
    )


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0))
    words = table(spark, sf_dir, "benchmark").select(F.explode(found).alias("word")).distinct()
    names = F.array(*[F.lit(e) for e in EMOTIONS])
    size = F.length("word")

    def pick(n):
        return F.element_at(names, (F.pmod(n, F.lit(len(EMOTIONS))) + 1).cast("int"))

    both = F.array_distinct(F.array(pick(size), pick(size + F.ascii("word"))))
    return words.select("word", F.explode(both).alias("emotion"))


def document_of(text: str = "selftext"):
    return document_text("title", text)


# ---- the same in SQL -------------------------------------------------------------------------

POSTS = """posts AS (
  SELECT o_orderkey AS id, o_custkey AS author, o_orderpriority AS topic, o_custkey AS community,
         o_totalprice AS score, o_orderdate AS created, coalesce(n, 0) AS num_comments
  FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) c
  ON l_orderkey = o_orderkey)"""

COMMENTS = """comments AS (
  SELECT l_orderkey::varchar AS link_id, l_suppkey AS author, l_suppkey AS community,
         l_extendedprice AS score, l_quantity AS length,
         (l_returnflag = 'R')::int AS controversiality, l_shipdate AS created
  FROM lineitem)"""

POST_TEXTS = """post_texts AS (
  SELECT doc_id AS id, source AS community, split_part(text, chr(10), 1) AS title,
         text AS selftext
  FROM documents)"""

POST_META = """post_meta AS (
  SELECT event_id AS id, user_id AS author, user_id AS score,
         floor(value)::int AS num_comments, ts AS created
  FROM events)"""

TEXT_COMMENTS = """text_comments AS (
  SELECT conv_id || '_' || turn AS id, 't3_' || conv_id AS link_id,
         CASE WHEN turn = 0 THEN 't3_' || conv_id
              ELSE 't1_' || conv_id || '_' || (turn - 1) END AS parent_id,
         role AS author, text AS body, floor(value)::int AS score,
         (event_type = 'error')::int AS controversiality,
         (event_type = 'purchase')::int AS gilded, ts AS created
  FROM conversations LEFT JOIN events ON event_id = conv_id * 8 + turn)"""

_NAMES = "[" + ", ".join(f"'{e}'" for e in EMOTIONS) + "]"
LEXICON = f"""lexicon_words AS (
  SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{{3,}}')) AS word FROM benchmark),
lexicon AS (
  SELECT DISTINCT word, {_NAMES}[(n % 10 + 1)::int] AS emotion
  FROM (SELECT word, length(word) AS n FROM lexicon_words
        UNION ALL SELECT word, length(word) + ascii(word) FROM lexicon_words))"""


def tokens_sql(text: str) -> str:
    """List of letters-only lower-case tokens."""
    return (
        f"list_filter(list_transform(string_split_regex(lower({text}), '\\s+'), "
        "lambda w: regexp_replace(w, '[^\\p{L}]', '', 'g')), lambda w: w <> '')"
    )


def with_tables(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
