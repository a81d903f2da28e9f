"""Near-duplicate documents by SuperMinHash, banding, verification and union-find grouping.

SuperMinHash ranks the signature's positions anew for every element: element e offers the value
j + r(e, j) to the position at place j of its own random permutation. Values of place j lie between
j and j + 1, so as soon as every position holds a value below j, no later place can change anything
and the work stops: long sets need one or two places. Ranks within one element exclude each other,
which makes estimates less scattered than those of independent hashes.

Copies (equal sets) are one node from the start. Nodes that share a band share a bucket. In every
bucket the node that meets most others anywhere (the leader) is compared with all of the bucket.
What this leaves in different groups of one bucket is compared by prefixes: sets that are alike enough
share one of their rarest items (a set of n: of its n - ceil(share * n) + 1 rarest), and from their places
in the order by rarity follows how much they can share at most. Edits of one text that are too far from
it have too many shingles of their own to meet there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from agoralens.llm.batches import chunks, find_words, mix, streams, string_column, windows
from agoralens.llm.components import components
from agoralens.llm.shared import only_ids
from agoralens.sources.scratch import Scratch

#: 20 bands of 4 values: of pairs at 85 % likeness 4 in 10 million meet in no band, at 80 % 3 in 100,000.
BANDS, ROWS = 20, 4
#: Members of one bucket that are compared with its leader in one task.
PART = 2048


def signature(elements: np.ndarray, size: int) -> np.ndarray:
    """SuperMinHash of a set of distinct 64-bit hashes (at least one)."""
    values = np.full(size, np.inf)
    order = None
    rows = np.arange(len(elements))
    for j in range(size):
        draw = mix(elements ^ _PLACES[j])
        value = j + (draw >> np.uint64(11)) / float(1 << 53)
        pick = j + ((draw & np.uint64(0x7FF)) * np.uint64(size - j) >> np.uint64(11)).astype(np.int64)
        if j == 0:
            place = pick
        else:
            if order is None:
                order = np.broadcast_to(np.arange(size, dtype=np.int16), (len(elements), size)).copy()
                order[rows, first], order[rows, 0] = 0, first
            place = order[rows, pick].copy()
            order[rows, pick] = order[rows, j]
            order[rows, j] = place
        first = pick
        np.minimum.at(values, place, value)
        if values.max() < j + 1:
            break
    return values


_PLACES = streams(512, 21)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """The distinct hashes of `size` consecutive words; of all words if there are fewer."""
    if not len(hashes):
        return hashes
    if len(hashes) < size:
        return windows(hashes, len(hashes), 31)
    return np.unique(windows(hashes, size))


def _sets(batch: pa.RecordBatch, text_col: str, size: int) -> Iterator[np.ndarray]:
    for chunk in chunks(string_column(batch, text_col)):
        words = find_words(chunk, lower=True)
        for a, b in zip(words.bounds[:-1], words.bounds[1:]):
            yield shingles(words.hashes[a:b], size)


def _node(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def _halves(nodes: list[bytes | None]) -> list[pa.Array]:
    """Two columns of 64 bits each, NULL where there is no node."""
    parts = np.frombuffer(b"".join(n or bytes(16) for n in nodes), np.int64).reshape(-1, 2)
    missing = np.array([n is None for n in nodes], bool)
    return [pa.array(parts[:, i], mask=missing) for i in (0, 1)]


def _signed(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Per row: set size, the 128-bit hash of the set (`hi`, `lo`; NULL if empty) and one number per band."""
    kind = docs.schema[id_col].dataType.simpleString()
    bands = [f"band{i}" for i in range(BANDS)]
    factors = streams(ROWS, 41)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes = [], []
            numbers = np.zeros((batch.num_rows, BANDS), np.uint64)
            for row, own in enumerate(_sets(batch, text_col, shingle)):
                sizes.append(len(own))
                nodes.append(_node(own) if len(own) else None)
                if len(own):
                    signed = signature(own, BANDS * ROWS).view(np.uint64).reshape(BANDS, ROWS)
                    numbers[row] = mix((mix(signed) * factors).sum(axis=1) + _PLACES[:BANDS])
            columns = [pa.array(numbers[:, i].view(np.int64)) for i in range(BANDS)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), *_halves(nodes), *columns],
                names=[id_col, "n_shingles", "hi", "lo", *bands],
            )

    schema = f"`{id_col}` {kind}, n_shingles long, hi long, lo long, " + ", ".join(f"{b} long" for b in bands)
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _with_sets(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """The hash of every set (`hi`, `lo`) and its `items`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                sets = list(_sets(batch.slice(at, 500), text_col, shingle))
                yield pa.RecordBatch.from_arrays(
                    [*_halves([_node(s) for s in sets]), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    names=["hi", "lo", "items"],
                )

    return docs.select(id_col, text_col).mapInArrow(run, "hi long, lo long, items array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, stored) -> DataFrame:
    """Those of the distinct pairs (`a`, `b`) whose sets are alike enough. `a` may occur very often:
    its pairs are dealt to as many tasks as their number asks for, each with a copy of its set."""
    parts = stored(pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(PART)).cast("int").alias("parts")), "parts")
    dealt = pairs.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")).drop("parts")
    sets = sets.select("node", "items")
    left = parts.join(sets.withColumnRenamed("node", "a"), "a").withColumnRenamed("items", "items_a")
    left = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    right = dealt.join(sets.withColumnRenamed("node", "b"), "b").withColumnRenamed("items", "items_b")
    small = F.least(F.size("items_a"), F.size("items_b"))
    large = F.greatest(F.size("items_a"), F.size("items_b"))
    common = F.size(F.array_intersect("items_a", "items_b"))
    alike = F.when(100 * small < percent * large, False).otherwise(100 * common >= percent * (small + large - common))
    return left.join(right, ["a", "part"]).where(alike).select("a", "b")


def near_groups(
    docs: DataFrame, *, percent: int = 80, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `docs`: `id_col`, `n_shingles`, `component_id` and `kept`.

    Words are runs without ASCII white space, A-Z lower-cased; a set has the distinct runs of
    `shingle` words (all words, if fewer). Rows are linked if 100 * intersection >= percent * union,
    confirmed on the full sets; `component_id` is the smallest id reachable. NULL and empty texts
    have an empty set and are linked with nothing, like rows without an id, whose component is NULL
    and which are kept. Rows that repeat an id count as one document for `kept`. An empty table
    gives an empty result. Other columns are not read.

    Signatures, bucket members, candidate pairs, sets of the candidates and edges are stored in the
    shared folder, so a lost executor costs the tasks it ran. All but the last two tables, which the
    result reads, are deleted before it is returned.
    """
    tables = Scratch(docs.sparkSession)
    stored = tables.stored

    bands = [f"band{i}" for i in range(BANDS)]
    signed = stored(_signed(docs, id_col, text_col, shingle), "signed")
    known = signed.where(F.col(id_col).isNotNull() & F.col("hi").isNotNull())
    nodes = known.groupBy("hi", "lo").agg(
        F.min(id_col).alias("first_id"), F.count("*").alias("n_rows"), F.min("n_shingles").alias("n"), *[F.min(b).alias(b) for b in bands]
    )
    # Numbers are data once they are stored.
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    placed = nodes.select("node", F.explode(F.array(*bands)).alias("bucket"))
    # Aggregates are stored before they are joined, so that the join may split a bucket of very many nodes.
    buckets = stored(placed.groupBy("bucket").agg(F.count("*").alias("n_nodes")).where("n_nodes > 1"), "buckets")
    members = stored(placed.join(buckets, "bucket"), "members")
    met = stored(members.groupBy("node").agg(F.sum("n_nodes").alias("met")), "met")
    leaders = members.join(met, "node").groupBy("bucket").agg(F.max(F.struct("met", "node"))["node"].alias("a"))
    leaders = stored(leaders, "leaders")
    star = stored(
        members.join(leaders, "bucket").where("node != a").select("a", F.col("node").alias("b")).distinct(), "star"
    )
    needed = stored(met.join(nodes, "node").select(F.col("first_id").alias(id_col), "hi", "lo", "node"), "needed")
    sets = _with_sets(only_ids(docs, needed, id_col), id_col, text_col, shingle)
    sets = stored(sets.join(needed.select("hi", "lo", "node"), ["hi", "lo"]).select("node", "items").dropDuplicates(["node"]), "sets")
    edges = stored(_verified(star, sets, percent, stored), "edges")

    groups = stored(components(edges), "groups")
    rest = stored(_apart(members, groups, sets, percent, stored).join(_ordered(star), ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        more = stored(_verified(rest, sets, percent, stored), "more")
        if not more.isEmpty():
            groups = stored(components(edges.union(more)), "groups")

    joined = groups.join(nodes.select("node", "first_id"), "node")
    tops = stored(joined.groupBy("root").agg(F.min("first_id").alias("top")), "roots")
    linked = groups.join(tops, "root").select("node", "top")
    table = nodes.select("node", "hi", "lo", "first_id", "n_rows").join(linked, "node", "left").where("n_rows > 1 OR top IS NOT NULL")
    table = stored(table.select("hi", "lo", F.coalesce("top", "first_id").alias("top")), "tops")
    tables.drop(signed, table)
    component = F.when(F.col(id_col).isNotNull(), F.coalesce("top", id_col))
    return (
        signed.select(id_col, "n_shingles", "hi", "lo")
        .join(table, ["hi", "lo"], "left")
        .select(id_col, "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
    )


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _apart(members: DataFrame, groups: DataFrame, sets: DataFrame, percent: int, stored) -> DataFrame:
    """Pairs (`a` < `b`) that may be alike enough and are in different groups, of nodes that share a
    bucket with a node of another group: those that share an item among their rarest ones."""
    described = stored(
        members.join(groups, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("group")), "described"
    )
    mixed = described.groupBy("bucket").agg(F.min("group").alias("g"), F.max("group").alias("h")).where("g != h").select("bucket")
    mixed = stored(mixed, "mixed")
    open_nodes = stored(described.join(mixed, "bucket").select("node", "group").distinct(), "open")
    items = sets.join(open_nodes, "node").select("node", "group", F.size("items").alias("n"), F.explode("items").alias("item"))
    held = stored(items.groupBy("item").agg(F.count("*").alias("held")).where("held > 1"), "held")
    # Items that no other node holds come first; they count in the order, but meet nothing.
    ranked = items.join(held, "item", "left").withColumn("held", F.coalesce("held", F.lit(1)))
    ranked = ranked.withColumn("place", F.row_number().over(W.partitionBy("node").orderBy("held", "item")))
    needed = F.ceil(F.col("n") * percent / 100).cast("int")
    prefixes = stored(ranked.where((F.col("held") > 1) & (F.col("place") <= F.col("n") - needed + 1)).drop("held"), "prefixes")
    x, y = prefixes.alias("x"), prefixes.alias("y")
    left = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")) + 1
    enough = (100 + percent) * left >= percent * (F.col("x.n") + F.col("y.n"))
    near_size = 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")
    met = x.join(y, (F.col("x.item") == F.col("y.item")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.group") != F.col("y.group")) & near_size & enough)
    return met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
