"""Removal of passages that an earlier document has: seed and extend.

Seeds are winnowed anchors: of the 20-word runs in every 50-word window, the one of the smallest
hash. Two documents with a window in common have its anchor in common, so joining documents on
anchors misses nothing. Around each shared anchor the match is extended both ways, over all windows
that the anchor stands for, which are compared by 128-bit hashes; the windows that agree, put
together, are the maximal repeats over the length threshold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from agoralens.llm.batches import Chunk, Words, chunks, find_words, rolling, string_column, windows
from agoralens.llm.shared import only_ids
from agoralens.sources.scratch import new_folder


def _rows(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, Chunk, Words, slice]]:
    for chunk in chunks(string_column(batch, column)):
        words = find_words(chunk)
        for r in range(len(chunk.offsets) - 1):
            yield chunk.first + r, chunk, words, slice(words.bounds[r], words.bounds[r + 1])


def _joined(chunk: Chunk, words: Words, own: slice, keep: np.ndarray | None = None) -> bytes:
    """The kept words joined by one space."""
    spans = zip(words.starts[own].tolist(), words.ends[own].tolist())
    data = chunk.data.data
    if keep is None:
        return b" ".join([data[a:b] for a, b in spans])
    return b" ".join([data[a:b] for (a, b), k in zip(spans, keep.tolist()) if k])


def own_anchor(hashes: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The seeds' hashes, and of each window the place of its anchor (the leftmost smallest)."""
    seeds = windows(hashes, seed)
    view = np.lib.stride_tricks.sliding_window_view(seeds, window - seed + 1)
    return seeds, view.argmin(axis=1) + np.arange(len(view))


def _identity(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def remove_repeats(
    docs: DataFrame, *, window: int = 50, seed: int = 20, id_col: str = "doc_id", text_col: str = "text", texts: bool = False
) -> DataFrame:
    """One row per row of `docs`: `id_col`, `n_words`, `n_removed`, `kept_sha256` (the kept words
    joined by one space) and, with `texts`, those words as `kept`.

    A word is removed if it lies in a window of `window` words that also starts in a document of
    smaller id. Windows are judged on the texts as they come. NULL and empty texts have no words.
    Rows without an id lose nothing and cause nothing. Rows that share an id do not cause removals
    in each other; each of them is judged by its own text. Other columns are not read.

    Copies (equal words) are settled by their smallest id first. With `texts`, `kept` is NULL where nothing is removed. Stored in the shared folder: per
    document its anchors, the shared anchors' places, and the windows around them.
    """
    spark = docs.sparkSession
    docs = docs.select(id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, chunk, words, own in _rows(batch, text_col):
                h = words.hashes[own]
                hashes, places = [], []
                if len(h) >= window:
                    runs, anchor = own_anchor(h, window, seed)
                    places = np.unique(anchor)
                    hashes = runs[places].view(np.int64)
                whole = _joined(chunk, words, own)
                found.append((len(h), _identity(h), hashlib.sha256(whole).hexdigest(), hashes, places))
            cols = list(zip(*found)) or [()] * 5
            types = (pa.int64(), pa.binary(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()))
            arrays = [pa.array(c, t) for c, t in zip(cols, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=[id_col, *names])

    names = ["n_words", "words_id", "whole_sha256", "anchors", "places"]
    stored = new_folder(spark, "seeds")
    docs.mapInArrow(
        seeds,
        f"`{id_col}` {kind}, n_words long, words_id binary, whole_sha256 string, anchors array<long>, places array<int>",
    ).write.parquet(stored)
    base = spark.read.parquet(stored)
    alone = base.where(F.col(id_col).isNotNull() & (F.col("n_words") >= window))
    copies = (
        alone.groupBy("words_id").agg(F.count("*").alias("n"), F.min(id_col).alias("first_id")).where("n > 1").drop("n")
    )
    copies_stored = new_folder(spark, "copies")
    copies.write.parquet(copies_stored)
    copies = spark.read.parquet(copies_stored)
    firsts = alone.join(copies, "words_id", "left").where(F.col("first_id").isNull() | (F.col("first_id") == F.col(id_col)))
    seeded = firsts.select(id_col, F.inline(F.arrays_zip(F.col("anchors").alias("anchor"), F.col("places").alias("place"))))
    shared = seeded.groupBy("anchor").agg(F.min(id_col).alias("lo"), F.max(id_col).alias("hi")).where("lo < hi").select("anchor")
    at_stored = new_folder(spark, "places")
    seeded.join(shared, "anchor").groupBy(id_col).agg(F.collect_list("place").alias("at")).write.parquet(at_stored)
    at = spark.read.parquet(at_stored)

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for row, _, words, own in _rows(batch, text_col):
                h = words.hashes[own]
                if len(h) < window:
                    continue
                _, anchor = own_anchor(h, window, seed)
                at = batch.column(2)[row].values.to_numpy()
                hit = np.isin(anchor, at)
                a, b = rolling(h, window, 11)[hit], rolling(h, window, 12)[hit]
                for k in range(0, len(a), 20_000):
                    n = len(a[k : k + 20_000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a[k : k + n].view(np.int64)), pa.array(b[k : k + n].view(np.int64)), pa.array([ids[row].as_py()] * n, ids.type)],
                        names=["h1", "h2", id_col],
                    )

    around = only_ids(docs, at, id_col).join(at, id_col)
    hashed_stored = new_folder(spark, "windows")
    around.mapInArrow(extend, f"h1 long, h2 long, `{id_col}` {kind}").write.parquet(hashed_stored)
    hashed = spark.read.parquet(hashed_stored)
    earliest = hashed.groupBy("h1", "h2").agg(F.min(id_col).alias("lo"), F.max(id_col).alias("hi")).where("lo < hi").drop("hi")
    gone_stored = new_folder(spark, "gone")
    hashed.join(earliest, ["h1", "h2"]).where(F.col(id_col) > F.col("lo")).groupBy(id_col).agg(
        F.collect_set("h1").alias("gone")
    ).write.parquet(gone_stored)
    gone = spark.read.parquet(gone_stored)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row, chunk, words, own in _rows(batch, text_col):
                h = words.hashes[own]
                steps = np.zeros(len(h) + 1, np.int64)
                if len(h) >= window:
                    bad = np.flatnonzero(np.isin(rolling(h, window, 11).view(np.int64), batch.column(2)[row].values.to_numpy()))
                    np.add.at(steps, bad, 1)
                    np.add.at(steps, bad + window, -1)
                removed = np.cumsum(steps)[:-1] > 0
                kept = _joined(chunk, words, own, ~removed)
                found.append((_identity(h), int(removed.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if texts else None))
            cols = list(zip(*found)) or [()] * 4
            arrays = [pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["cut_id", "cut_words", "n_cut", "cut_sha256", "cut_text"])

    trimmed = only_ids(docs, gone, id_col).join(gone, id_col).mapInArrow(
        cut, f"cut_id {kind}, cut_words binary, n_cut long, cut_sha256 string, cut_text string"
    ).dropDuplicates(["cut_id", "cut_words"])
    both = base.drop("anchors", "places").join(copies, "words_id", "left")
    both = both.join(trimmed, (F.col(id_col) == F.col("cut_id")) & (F.col("words_id") == F.col("cut_words")), "left")
    copy = F.coalesce(F.col(id_col) > F.col("first_id"), F.lit(False))
    result = both.select(
        id_col,
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_cut", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("cut_sha256", "whole_sha256")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("cut_text")).alias("kept"),
    )
    return result if texts else result.drop("kept")
