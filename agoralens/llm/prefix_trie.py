"""Trie of shared conversation beginnings, from vertical bitmaps.

Every turn of a rebuilt conversation gets two 64-bit numbers of its position, role and text; XORed over
the first d turns they name the node of depth d, in every task alike. Conversations, in order of their
ids, are cut into shards. A shard indexes (position, turn) to the bitset of its conversations; starting
from all of them, a parent's bitset is intersected with the postings of the next turn of its first
conversation, which yields a child and its popcount; what is left yields the other children. One pass
over a shard is as long as its nodes, however many conversations share them. Nodes of different shards
are then added up by name.

For subtree sums every node belongs to its smallest member. What one conversation owns is the end of its
own path (a chain), so a subtree's sum is the rest of its owner's chain plus the whole chains of all
other members, which are added up over the turns that a conversation does not own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from agoralens.operators.ordering import running_totals
from agoralens.sources.scratch import stored

#: A shard ends at this many members or rows, whichever comes first.
SHARD_MEMBERS, SHARD_ROWS = 1024, 65_536
#: Turns of a conversation that are one member; a longer one is several members, one behind another.
BAND = 4096
#: Conversations with more rows are numbered by key ranges instead of in one task.
LONG = 100_000
#: Conversations whose ids share all but the last two digits borrow from one of them.
GROUP, BORROWED = 100, 6

KEY = ["depth", "ka", "kb"]


def _turns(conversations: DataFrame) -> DataFrame:
    """`conv_id`, `turn`, `m` (16 bytes of role and text) and `chars`; rows without an id are left out."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), F.unhex(named).alias("m"), F.length(text).alias("chars")
    )


def numbered(turns: DataFrame, counts: DataFrame, long: int = LONG) -> DataFrame:
    """`turns` with their place `p` (from 1) in the conversation: by turn, NULL first; turns with one
    number go by the MD5 of role and text. `counts` (stored) has `conv_id` and its number of rows `n`."""
    order = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "m")
    hot = counts.where(F.col("n") > long).select("conv_id")
    if hot.isEmpty():
        return turns.withColumn("p", F.row_number().over(order))
    hot = F.broadcast(hot)  # fewer than all rows / LONG
    usual = turns.join(hot, "conv_id", "left_anti").withColumn("p", F.row_number().over(order))
    same = turns.join(hot, "conv_id").groupBy(F.struct("conv_id", "turn", "m").alias("key")).agg(F.count("*").alias("same"), F.min("chars").alias("chars"))
    placed = stored(running_totals(same, "key", ["same"]), "placed")
    starts = placed.groupBy("key.conv_id").agg(F.min("before_same").alias("start"))
    place = F.explode(F.sequence(F.lit(1), F.col("same")))
    placed = placed.select("key.*", "chars", "before_same", place.alias("i")).join(F.broadcast(starts), "conv_id")
    placed = placed.select("conv_id", "turn", "m", "chars", (F.col("before_same") - F.col("start") + F.col("i")).cast("int").alias("p"))
    return usual.unionByName(placed)


def rebuilt(conversations: DataFrame, *, long: int = LONG) -> DataFrame:
    """Every conversation c rebuilt: the first h turns of conversation c - c % 100, then its own behind
    its first h; h is the unsigned CRC-32 of c in decimal, modulo 6. Stored.

    `conv_id`, `pos` (from 1; one row with 0 for every conversation, also one without turns), `ha`, `hb`
    (numbers of the turn at its place) and `chars`.
    """
    turns = stored(_turns(conversations), "turns")
    counts = stored(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "counts")
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    known = counts.select("conv_id", base.alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROWED).cast("int").alias("h"))
    sizes = counts.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.least("n", F.lit(BORROWED)).cast("int").alias("lent"))
    known = known.join(sizes, "base", "left").withColumn("lent", F.least(F.coalesce("lent", F.lit(0)), "h"))
    placed = numbered(turns, counts, long)
    own = placed.join(known.select("conv_id", "h", "lent"), "conv_id").where("p > h")
    own = own.select("conv_id", (F.col("p") - F.col("h") + F.col("lent")).alias("pos"), "m", "chars")
    first = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "m")
    # Only the first turns of the lenders are ranked once more; the ranking stops early in every task.
    lenders = turns.where(F.col("conv_id") % GROUP == 0).withColumn("pos", F.row_number().over(first)).where(F.col("pos") < BORROWED)
    lenders = lenders.select(F.col("conv_id").alias("base"), "pos", "m", "chars")
    borrowed = known.join(lenders, "base").where("pos <= h").select("conv_id", "pos", "m", "chars")
    rows = own.unionByName(borrowed).select(
        "conv_id", "pos", F.xxhash64("pos", "m").alias("ha"), F.xxhash64("m", "pos", F.lit(1)).alias("hb"), "chars"
    )
    roots = counts.select("conv_id", F.lit(0).alias("pos"), F.lit(0).cast("long").alias("ha"), F.lit(0).cast("long").alias("hb"), F.lit(0).alias("chars"))
    return stored(rows.unionByName(roots), "rebuilt")


class Shard:
    """Members (a conversation, or a band of a long one) and their turns, as vertical bitmaps."""

    def __init__(self) -> None:
        self.convs: list[int] = []
        self.whole: list[bool] = []
        self.starts: list[tuple[int, int, int]] = []
        self.paths: list[list[tuple[int, int, int]]] = []
        self.rows = 0

    def open(self, conv: int, whole: bool, start: tuple[int, int, int]) -> None:
        self.convs.append(conv)
        self.whole.append(whole)
        self.starts.append(start)
        self.paths.append([])

    def add(self, ha: int, hb: int, chars: int) -> None:
        self.paths[-1].append((ha, hb, chars))
        self.rows += 1

    def nodes(self) -> Iterator[tuple]:
        """(depth, name, parent's name, members, smallest member, code points, ids that end here or
        None) of every node; the start of a band was a node of the band before."""
        postings: dict[tuple[int, int, int], int] = {}
        roots: dict[tuple[int, int, int], int] = {}
        for i, path in enumerate(self.paths):
            bit = 1 << i
            start = self.starts[i]
            roots[start] = roots.get(start, 0) | bit
            for place, (ha, hb, _) in enumerate(path, start[0] + 1):
                at = (place, ha, hb)
                postings[at] = postings.get(at, 0) | bit
        todo = [(start, None, members, 0) for start, members in roots.items()]
        while todo:
            name, parent, members, chars = todo.pop()
            depth, ka, kb = name
            ended, rest = [], members
            while rest:
                low = rest & -rest
                i = low.bit_length() - 1
                path, skipped = self.paths[i], self.starts[i][0]
                if depth - skipped == len(path):
                    rest ^= low
                    if self.whole[i]:
                        ended.append(self.convs[i])
                    continue
                ha, hb, n = path[depth - skipped]
                child = members & postings[depth + 1, ha, hb]
                rest &= ~child
                todo.append(((depth + 1, ka ^ ha, kb ^ hb), name, child, n))
            if parent is not None or depth == 0:
                pa, pb = parent[1:] if parent else (0, 0)
                smallest = self.convs[(members & -members).bit_length() - 1]
                yield depth, ka, kb, pa, pb, members.bit_count(), smallest, chars, ",".join(map(str, ended)) or None


_NODE = "depth int, ka long, kb long, pa long, pb long, n long, conv_id long, chars int, ends string"
_KINDS = [pa.int32(), *[pa.int64()] * 6, pa.int32(), pa.string()]


def _sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by `conv_id`, `band`, `pos` (a band's start first) to the nodes of their shards."""
    names = [field.split()[0] for field in _NODE.split(", ")]
    shard, last = Shard(), None

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*shard.nodes()), _KINDS)], names=names)

    for batch in batches:
        for conv, band, pos, ha, hb, chars, whole in zip(*[c.to_pylist() for c in batch.columns]):
            if (conv, band) == last:
                shard.add(ha, hb, chars)
                continue
            if len(shard.convs) >= SHARD_MEMBERS or shard.rows >= SHARD_ROWS:
                yield flush()
                shard = Shard()
            shard.open(conv, whole, (pos, ha, hb))
            last = conv, band
    if shard.convs:
        yield flush()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and shard (`depth`, `ka`, `kb`, `conv_id`, `ends`) to one SHA-256 per node of
    all its ids. SHA-256 is a chain, so a node's ids pass in order, a shard's at a time; none is kept."""
    last, digest = None, None

    def out(done: list) -> pa.RecordBatch:
        columns = list(zip(*done)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [*_KINDS[:3], pa.string()])], names=[*KEY, "ends_sha256"])

    for batch in batches:
        done = []
        for depth, ka, kb, _, ends in zip(*[c.to_pylist() for c in batch.columns]):
            if (depth, ka, kb) != last:
                if last is not None:
                    done.append((*last, digest.hexdigest()))
                last, digest = (depth, ka, kb), hashlib.sha256(ends.encode())
            else:
                digest.update(f",{ends}".encode())
        yield out(done)
    if last is not None:
        yield out([(*last, digest.hexdigest())])


def _running(rows: DataFrame, place: str, add, measures: dict[str, str], *, descending: bool = False, long: bool) -> DataFrame:
    """Add running aggregates (`add`, of every measure under its new name) along `place` within each
    conversation, own row included. Rows are ordered within bands only; the bands of long conversations
    are added up first."""
    band = F.greatest(F.floor((F.col(place) - 1) / BAND), F.lit(0)).cast("int")
    rows = rows.withColumn("band", band)
    order = F.desc if descending else F.asc
    inside = W.partitionBy("conv_id", "band").orderBy(order(place)).rowsBetween(W.unboundedPreceding, W.currentRow)
    found = rows.withColumns({new: add(F.col(m)).over(inside) for m, new in measures.items()})
    if not long:
        return found.drop("band")
    sums = rows.groupBy("conv_id", "band").agg(*[add(F.col(m)).alias(f"_{m}") for m in measures])
    earlier = W.partitionBy("conv_id").orderBy(order("band")).rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("conv_id", "band", *[F.coalesce(add(F.col(f"_{m}")).over(earlier), F.lit(0)).alias(f"_{m}") for m in measures])
    found = found.join(stored(sums, "bands"), ["conv_id", "band"])
    both = add is F.bit_xor
    return found.withColumns(
        {new: F.col(new).bitwiseXOR(F.col(f"_{m}")) if both else F.col(new) + F.col(f"_{m}") for m, new in measures.items()}
    ).drop("band", *[f"_{m}" for m in measures])


def _members(rows: DataFrame, long: bool) -> DataFrame:
    """`conv_id`, `band`, `pos`, `ha`, `hb`, `chars`, `whole` of all rows; a band behind the first begins
    with a row that holds the name of the node before it. `whole`: the conversation ends in the band."""
    if not long:
        return rows.select("conv_id", F.lit(0).alias("band"), "pos", "ha", "hb", "chars", F.lit(True).alias("whole"))
    banded = rows.withColumn("band", F.greatest(F.floor((F.col("pos") - 1) / BAND), F.lit(0)).cast("int"))
    sums = banded.groupBy("conv_id", "band").agg(F.bit_xor("ha").alias("xa"), F.bit_xor("hb").alias("xb"))
    order = W.partitionBy("conv_id").orderBy("band")
    sums = stored(
        sums.select(
            "conv_id", "band", F.lead("band").over(order).isNull().alias("whole"),
            *[F.bit_xor(x).over(order.rowsBetween(W.unboundedPreceding, -1)).alias(h) for x, h in (("xa", "ha"), ("xb", "hb"))],
        ),
        "bands",
    )
    starts = sums.where("band > 0").select(
        "conv_id", "band", (F.col("band") * BAND).alias("pos"), "ha", "hb", F.lit(0).alias("chars"), "whole"
    )
    return banded.join(sums.select("conv_id", "band", "whole"), ["conv_id", "band"]).select(starts.columns).unionByName(starts)


def trie(conversations: DataFrame, *, long: int = LONG) -> DataFrame:
    """One row per distinct sequence of first turns: `conv_id` (smallest member), `depth`,
    `parent_conv_id` (NULL at the root), `n_convs`, `n_children`, `n_leaves`, `saved_tokens` and
    `ends_sha256` (of the ids that end there, ascending).

    A NULL role or text is empty. Turns go by number, NULL first, and equal numbers by content, so
    repeated rows are turns of their own. Rows without `conv_id` are left out; an empty table has no
    nodes, not even a root. Other columns are not read.

    Rebuilt turns, shard nodes, nodes and chains are stored. A node's ids reach one task in order, as
    SHA-256 has to; all else about a node is added up before it is shuffled.
    """
    rows = rebuilt(conversations, long=long)
    longest = rows.agg(F.max("pos")).first()[0]
    banded = longest is not None and longest > BAND
    dealt = _members(rows, banded).repartitionByRange("conv_id", "band").sortWithinPartitions("conv_id", "band", "pos")
    shards = stored(dealt.mapInArrow(_sharded, _NODE), "shards")
    nodes = shards.groupBy(*KEY).agg(
        F.min("pa").alias("pa"), F.min("pb").alias("pb"), F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("chars").alias("chars")
    )
    nodes = stored(nodes, "nodes")
    chains = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "pa", "pb")).alias("first"), F.max("depth").alias("tail"))
    chains = stored(chains.select("conv_id", "first.*", "tail"), "chains")
    above = [(F.col("depth") - 1).alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb")]
    heads = chains.where("depth > 0").select(*above, F.col("conv_id").alias("head"))
    hung = heads.groupBy(*KEY).agg(F.count("*").alias("hung"))
    ended = shards.where("ends IS NOT NULL").select(*KEY, "conv_id", "ends")
    ended = ended.repartition(*[F.col(c) for c in KEY]).sortWithinPartitions(*KEY, "conv_id")
    ended = ended.mapInArrow(_digests, "depth int, ka long, kb long, ends_sha256 string")

    known = nodes.join(hung, KEY, "left").join(ended, KEY, "left").join(chains.select("conv_id", "tail"), "conv_id")
    last = F.col("depth") == F.col("tail")
    known = known.select(
        *KEY, "conv_id", "n_convs", "ends_sha256",
        (F.coalesce("hung", F.lit(0)) + F.when(last, 0).otherwise(1)).alias("n_children"),
        (last & F.col("hung").isNull()).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    )
    known = stored(_running(known, "depth", F.sum, {"leaf": "leaves", "saved": "saving"}, descending=True, long=banded), "known")
    wholes = stored(
        known.groupBy("conv_id").agg(F.min("depth").alias("owned"), F.max("leaves").alias("leaves"), F.max("saving").alias("saving")), "wholes"
    )
    shared = rows.select("conv_id", "pos", "ha", "hb").join(wholes, "conv_id").where("pos < owned")
    shared = _running(shared, "pos", F.bit_xor, {"ha": "ka", "hb": "kb"}, long=banded)
    others = shared.groupBy(F.col("pos").alias("depth"), "ka", "kb").agg(F.sum("leaves").alias("more_leaves"), F.sum("saving").alias("more_saving"))
    parents = heads.join(nodes.select(*KEY, F.col("conv_id").alias("parent")), KEY)
    parents = parents.select(F.col("head").alias("conv_id"), (F.col("depth") + 1).alias("depth"), "parent")
    return (
        known.join(others, KEY, "left")
        .join(parents, ["conv_id", "depth"], "left")
        .select(
            "conv_id",
            F.col("depth").cast("long").alias("depth"),
            F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")).alias("parent_conv_id"),
            "n_convs",
            F.col("n_children").cast("long").alias("n_children"),
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saving") + F.coalesce("more_saving", F.lit(0))).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )
