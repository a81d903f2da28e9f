"""An index of reply trees: two numbers per comment that tell what lies below it.

Walking a tree, every comment is entered and left once. `high` and `low` number these steps from the end
of the walk, so the comments below one are those whose numbers lie between its own, and a subtree's size
is half their distance. Sums over subtrees come out of the same walk. The walk is a linked list of two
elements per comment, ranked by pointer doubling: every round each element skips as many as it already
knows, so rounds grow with the logarithm of the largest tree, no element has two predecessors, and no
result holds more than one row per comment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from agoralens.functions.keys import is_direct_reply, strip_kind
from agoralens.operators.lookups import HOT_PARTS, fits_broadcast, hot_keys, spread_join
from agoralens.sources.scratch import Scratch

INDEX = ("id", "root", "depth", "size", "high", "low")


def _numbered(comments: DataFrame, measures: Sequence[str], tables: Scratch) -> DataFrame:
    """`num` (a number of its own), `id`, `up` (its parent's number or NULL) and the measures."""
    parent = F.when(is_direct_reply("parent_id") == 0, strip_kind("parent_id"))
    # A repeated id is one comment: of its rows the one with the smallest parent counts.
    first = F.min(F.struct(parent.alias("up"), *[F.coalesce(m, F.lit(0)).alias(m) for m in measures])).alias("row")
    rows = comments.where("id IS NOT NULL").groupBy(F.col("id").cast("string").alias("id")).agg(first)
    rows = tables.stored(rows.select(F.monotonically_increasing_id().alias("num"), "id", "row.*"), "comments")
    ids = rows.select(F.col("id").alias("up"), F.col("num").alias("up_num"))
    # Parents with very many replies are split.
    placed = spread_join(rows.where("up IS NOT NULL"), ids, ["up"], "left").select("num", "id", F.col("up_num").alias("up"), *measures)
    tops = rows.where("up IS NULL").select("num", "id", F.lit(None).cast("long").alias("up"), *measures)
    return tables.stored(placed.unionByName(tops), "numbered")


def _walk(nodes: DataFrame, measures: Sequence[str], tables: Scratch) -> DataFrame:
    """Elements of all walks: `at` (2 * num on entering, + 1 on leaving), `next`, `steps`, `level` and
    the measures, which count on entering."""
    hot = tables.stored(hot_keys(nodes.where("up IS NOT NULL"), ["up"]), "hot")
    replies = nodes.where("up IS NOT NULL").select("num", "up").join(F.broadcast(hot) if fits_broadcast(hot) else hot, "up", "left")
    # Brothers go by part, then by number; only the ends of parts meet in one window per parent.
    part = F.when(F.col("_hot"), F.pmod(F.xxhash64("num"), F.lit(HOT_PARTS))).otherwise(F.lit(0))
    replies = tables.stored(replies.select("num", "up", part.cast("int").alias("part")), "replies")
    firsts = replies.groupBy("up", "part").agg(F.min("num").alias("first"))
    by_part = W.partitionBy("up").orderBy("part")
    firsts = tables.stored(firsts.select("up", "part", "first", F.lead("first").over(by_part).alias("then")), "firsts")
    brothers = replies.withColumn("brother", F.lead("num").over(W.partitionBy("up", "part").orderBy("num")))
    between = firsts.select(F.col("up").alias("_up"), F.col("part").alias("_part"), "then")
    lasts = brothers.where("brother IS NULL").join(between, (F.col("up") == F.col("_up")) & (F.col("part") == F.col("_part")))
    inner = brothers.where("brother IS NOT NULL").select("num", "brother")
    brothers = inner.unionByName(lasts.select("num", F.col("then").alias("brother")))
    eldest = firsts.groupBy(F.col("up").alias("num")).agg(F.min_by("first", "part").alias("child"))
    linked = nodes.join(brothers, "num", "left").join(eldest, "num", "left")
    entering = linked.select(
        (F.col("num") * 2).alias("at"), F.coalesce(F.col("child") * 2, F.col("num") * 2 + 1).alias("next"),
        F.lit(1).cast("long").alias("level"), *measures,
    )
    leaving = linked.select(
        (F.col("num") * 2 + 1).alias("at"), F.coalesce(F.col("brother") * 2, F.col("up") * 2 + 1).alias("next"),
        F.lit(-1).cast("long").alias("level"), *[F.lit(0).cast(linked.schema[m].dataType).alias(m) for m in measures],
    )
    # What is behind the last element counts as nothing; `end` is the last element of the walk.
    steps = F.when(F.col("next").isNotNull(), 1).otherwise(0).cast("long")
    return tables.stored(entering.unionByName(leaving).withColumns({"steps": steps, "end": F.coalesce("next", "at")}), "walk")


def reply_index(comments: DataFrame, measures: Sequence[str] = ()) -> DataFrame:
    """One row per comment: `id`, `root` (the topmost comment above it, or itself), `depth` (1 at the
    top), `size` (comments in its subtree, itself included), `high`, `low`, and `total_<m>`, the sum of
    each measure over its subtree. `comments` has `id`, `parent_id` and the measures (NULL counts as 0).

    A comment whose parent is not there is a top. Comments in a reply cycle, and those below it, get
    NULLs. Rows without an id are left out, of rows that repeat an id one counts. Stored.
    """
    tables = Scratch(comments.sparkSession)
    nodes = _numbered(comments, measures, tables)
    sums = ["level", *measures]
    waiting = _walk(nodes, measures, tables)
    columns = waiting.columns
    done, longest, rounds = waiting.where("next IS NULL"), 2 * nodes.count(), 0
    waiting = waiting.where("next IS NOT NULL")
    while not waiting.isEmpty() and 2**rounds <= longest:
        rounds += 1
        ahead = done.unionByName(waiting).select(
            F.col("at").alias("next"), F.col("next").alias("_next"), F.col("end").alias("_end"), F.col("steps").alias("_steps"),
            *[F.col(c).alias(f"_{c}") for c in sums],
        )
        moved = waiting.join(ahead, "next").select(
            "at", F.col("_next").alias("next"), *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in [*sums, "steps"]], F.col("_end").alias("end")
        )
        moved = tables.stored(moved.select(columns), "walk")
        done = done.unionByName(moved.where("next IS NULL"))
        waiting = moved.where("next IS NOT NULL")
    walked = done.select(F.floor(F.col("at") / 2).alias("num"), (F.col("at") % 2).alias("leaving"), "end", "steps", *sums)
    inside = F.col("leaving") == 0

    def of(column: str, enter: bool):
        return F.max(F.when(inside if enter else ~inside, F.col(column)))

    labels = walked.groupBy("num").agg(
        of("steps", True).alias("high"), of("steps", False).alias("low"), of("end", True).alias("end"),
        (1 - of("level", True)).alias("depth"), *[(of(m, True) - of(m, False)).alias(f"total_{m}") for m in measures],
    )
    labels = tables.stored(labels, "labels")
    named = nodes.select("num", "id").join(labels, "num", "left")
    roots = nodes.select((F.col("num") * 2 + 1).alias("end"), F.col("id").alias("root"))
    # All comments of a tree ask for one root, so a large tree is split.
    known = spread_join(tables.stored(named, "named"), roots, ["end"], "left")
    found = tables.stored(
        known.select(
            "id", "root", "depth", ((F.col("high") - F.col("low") + 1) / 2).cast("long").alias("size"), "high", "low",
            *[f"total_{m}" for m in measures],
        ),
        "index",
    )
    tables.drop(found)
    return found


def below(index: DataFrame, seeds: DataFrame) -> DataFrame:
    """`seed` and `id` of every comment below each of the seeds (`id`), by comparing numbers within a
    tree; as long as the answer."""
    asked = seeds.select("id").distinct().join(index, "id").select(
        F.col("id").alias("seed"), "root", F.col("high").alias("_high"), F.col("low").alias("_low")
    )
    between = (F.col("high") < F.col("_high")) & (F.col("low") > F.col("_low"))
    return index.join(asked, "root").where(between).select("seed", "id")
