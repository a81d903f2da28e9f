"""The most frequent items of every group, exactly, without a shuffle as large as the vocabulary.

A first pass keeps a Misra-Gries summary per task and group: some items with a count that is too low by
at most a known error. Summaries are added up, which adds up the errors too. An item that is in none has
at most that many rows, so if the k-th best count is larger, the k best are among the candidates, and a
second pass counts only those. Groups for which this proves nothing are counted in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from agoralens.functions.text import each_word
from agoralens.operators.language import top_words
from agoralens.operators.lookups import fits_broadcast, lookup_join
from agoralens.sources.scratch import stored

#: Items kept per task and group, and in all by one task before it hands them on.
CAPACITY, HELD = 10_000, 1_000_000


class Summary:
    """Counts of at most `capacity` items (twice as many between two cuts), each too low by `error` at most."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.error = capacity, 0
        self.counts: dict[str, int] = {}

    def add(self, items: list[str], counts: list[int]) -> None:
        own = self.counts
        for item, n in zip(items, counts):
            own[item] = own.get(item, 0) + n
        if len(own) > 2 * self.capacity:
            self.cut()

    def cut(self) -> None:
        """Take the count of the best item that does not fit off all."""
        if len(self.counts) > self.capacity:
            off = sorted(self.counts.values(), reverse=True)[self.capacity]
            self.error += off
            self.counts = {item: n - off for item, n in self.counts.items() if n > off}


def summaries(df: DataFrame, group: str, tokens: str, capacity: int = CAPACITY) -> DataFrame:
    """Stored table of `group`, `item`, `low` (its count is at least that) and, in rows without an item,
    `error`, to be added up over all rows of a group. Empty and NULL tokens are not items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def given() -> pa.RecordBatch:
            rows: list[tuple] = []
            for name, summary in held.items():
                summary.cut()
                rows += [(name, item, n, 0) for item, n in summary.counts.items()] + [(name, None, 0, summary.error)]
            held.clear()
            columns = list(zip(*rows)) or [[]] * 4
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["group", "item", "low", "error"])

        for batch in batches:
            words = batch.column(1)
            rows = pa.table({"group": pc.take(batch.column(0), pc.list_parent_indices(words)), "item": pc.list_flatten(words)})
            rows = rows.filter(pc.fill_null(pc.not_equal(rows["item"], ""), False))
            counted = rows.group_by(["group", "item"]).aggregate([([], "count_all")])
            for name in pc.unique(counted["group"]):
                own = counted.filter(pc.is_null(counted["group"]) if name.as_py() is None else pc.equal(counted["group"], name))
                summary = held.setdefault(name.as_py(), Summary(capacity))
                summary.add(own["item"].to_pylist(), own["count_all"].to_pylist())
            if sum(len(s.counts) for s in held.values()) > HELD:
                yield given()
        yield given()

    rows = df.select(F.col(group).cast("string"), F.col(tokens))
    return stored(rows.mapInArrow(run, "group string, item string, low long, error long"), "summaries")


def candidates(found: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """From `summaries`: the items of each group that may be among its k best (`group`, `item`), and the
    groups for which that is not proven (`group`). Both are stored."""
    errors = stored(found.groupBy("group").agg(F.sum("error").alias("error")), "errors")
    lows = stored(found.where("item IS NOT NULL").groupBy("group", "item").agg(F.sum("low").alias("low")), "lows")
    order = W.partitionBy("group").orderBy(F.desc("low"), "item")
    kth = lows.withColumn("place", F.row_number().over(order)).where(F.col("place") == k)
    bounds = errors.withColumnRenamed("group", "_group").join(
        kth.select(F.col("group").alias("_of"), F.col("low").alias("kth")), F.col("_group").eqNullSafe(F.col("_of")), "left"
    )
    bounds = stored(bounds.select("_group", "error", F.coalesce("kth", F.lit(0)).alias("kth")), "bounds")
    proven = (F.col("error") == 0) | (F.col("kth") > F.col("error"))
    rest = stored(bounds.where(~proven).select(F.col("_group").alias("group")), "unproven")
    side = bounds.where(proven)
    side = F.broadcast(side) if fits_broadcast(side) else side
    chosen = lows.join(side, F.col("group").eqNullSafe(F.col("_group"))).where(F.col("low") + F.col("error") >= F.col("kth"))
    return stored(chosen.select("group", "item"), "candidates"), rest


def most_frequent(df: DataFrame, k: int = 50, group: str = "engagement", tokens: str = "tokens", capacity: int = CAPACITY) -> DataFrame:
    """`group`, `word`, `count` and `rank` of the k most frequent words of each group; equal counts in word
    order. As `top_words` of `word_counts`, for few groups and a large vocabulary."""
    chosen, rest = candidates(summaries(df, group, tokens, capacity), k)
    words = each_word(df, tokens, group)
    key = F.struct(F.col(group).isNull().alias("none"), F.coalesce(F.col(group).cast("string"), F.lit("")).alias("name"))
    named = F.struct(F.col("group").isNull().alias("none"), F.coalesce("group", F.lit("")).alias("name")).alias("_key")
    asked = chosen.select(named, F.col("item").alias("word"))
    counted = lookup_join(words.withColumn("_key", key), asked, ["_key", "word"]).groupBy(group, "word").agg(F.count("*").alias("count"))
    if not rest.isEmpty():
        # Groups are few where this is of use; their full counts are what the summaries were to save.
        full = lookup_join(words.withColumn("_key", key), rest.select(named), ["_key"])
        counted = counted.unionByName(full.groupBy(group, "word").agg(F.count("*").alias("count")))
    return top_words(counted, k, group)
