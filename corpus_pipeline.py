"""A training corpus from `documents`: the stages in order, each over all its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralens.llm import language, minhash, mixing, personal_data, piece_codec
from agoralens.operators.lookups import fits_broadcast
from agoralens.sources.scratch import drop, made_since, made_so_far, new_folder

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Tables made within the stage called last. Its output is written before the next one is called.
_inner: list[str] = []


def _stage(function: Stage) -> Stage:
    """Texts go to Python in batches of 500 rows, which bounds the memory of both sides, and the tables
    of the stage before are deleted: a stage starts when its predecessor's output is written."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(BATCH_ROWS, "500")
        drop(spark, _inner)
        before = made_so_far()
        try:
            return function(spark, docs, sf_dir)
        finally:
            _inner[:] = made_since(before)

    return run_stage


def _quoted(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def _without(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """`docs` without the rows whose key is in `ids` (stored); rows without a key stay."""
    side = F.broadcast(ids) if fits_broadcast(ids) else ids
    return docs.join(side, key, "left_anti")


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    folder = new_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.parquet(folder)


@_stage
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep rows whose text may be in a learned language: the language of every text is predicted, and
    texts that are NULL, without letters, of too low a score or, by their 3-grams, in no such language
    go. Each row is judged by itself, with or without an id."""
    return language.only_learned(docs, language.train(docs.where(~language.held_out("doc_id"))))


@_stage
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document (the smallest id) of each group of near-duplicates: five-word shingles,
    likeness of 0.8 or more."""
    copies = minhash.near_groups(docs, percent=80).where("NOT kept").select("doc_id").distinct()
    return _without(docs, _stored(spark, copies, "copies"), "doc_id")


@_stage
def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; `n_chars` counts the new text."""
    clean = personal_data.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(_quoted(docs))


@_stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mix the sources to their weights: rows as often as they are taken."""
    rows = mixing.copies(mixing.mix(docs, with_row=True))
    return rows.withColumn("n_chars", F.col("n_chars").cast(docs.schema["n_chars"].dataType)).select(_quoted(docs))


@_stage
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and what they decode to."""
    return piece_codec.encode(docs, MODEL)


STAGES = [
    ("language", known_language),
    ("near duplicates", one_of_each),
    ("personal data", without_personal_data),
    ("mixing", mixed),
    ("pieces", encoded),
]
#: Kernels, hashes and tokenizers have no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage is stored in the shared folder and read back by the next one, whose output replaces it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = spark.conf.get(BATCH_ROWS)
    last: list[str] = []
    try:
        for name, stage in STAGES:
            made = stage(spark, docs, sf_dir)
            folder = new_folder(spark, name.replace(" ", "-"))
            made.write.parquet(folder)
            docs = spark.read.parquet(folder)
            drop(spark, last)
            last = [folder]
    finally:
        spark.conf.set(BATCH_ROWS, rows)
        drop(spark, _inner)
        _inner.clear()
    return docs
