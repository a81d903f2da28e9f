"""Joins of large tables with lookup tables whose keys may be badly skewed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from agoralens.sources.scratch import stored

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 256
HOT_PARTS = 64
#: Rows of one key that one task should get at most.
PART_ROWS = 2_000_000


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether the table is within both bounds. Counting stops one row past the row bound."""
    def width(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            value = F.to_json(F.struct(value))
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.lit(8)
        return F.coalesce(F.octet_length(value), F.lit(0))

    size = sum((width(f) for f in df.schema.fields), F.lit(0))
    head = df.limit(max_rows + 1).agg(F.count("*").alias("rows"), F.sum(size).alias("bytes"))
    found = head.first()
    return found["rows"] <= max_rows and (found["bytes"] or 0) <= max_bytes


def hot_keys(rows: DataFrame, on: Sequence[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys holding more than 1/share of all rows, or more than `PART_ROWS` rows. There are fewer
    than the larger of `share` and all rows / `PART_ROWS` of them."""
    return _hot_counts(rows, on, share).select(*on, F.lit(True).alias("_hot"))


def _hot_counts(rows: DataFrame, on: Sequence[str], share: int) -> DataFrame:
    counts = rows.groupBy(*on).agg(F.count("*").alias("_rows"))
    total = counts.agg(F.sum("_rows").alias("total"))
    hot = (F.col("_rows") * F.lit(share) > total.scalar()) | (F.col("_rows") > PART_ROWS)
    return counts.where(hot)


def spread_rows(
    rows: DataFrame, hot: DataFrame, on: Sequence[str], parts: int = HOT_PARTS
) -> DataFrame:
    """Give rows of a hot key a part number from their own content, all others part 0."""
    content = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(parts)).cast("int")
    return rows.join(F.broadcast(hot), list(on), "left").withColumn(
        "_part", F.when(F.col("_hot"), content).otherwise(F.lit(0))
    ).drop("_hot")


def spread_lookup(
    lookup: DataFrame, hot: DataFrame, on: Sequence[str], parts: int = HOT_PARTS
) -> DataFrame:
    """Repeat the lookup rows of a hot key once per part."""
    last = F.when(F.col("_hot"), F.lit(parts - 1)).otherwise(F.lit(0))
    return lookup.join(F.broadcast(hot), list(on), "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), last))
    ).drop("_hot")


def spread_join(
    rows: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Shuffle join in which every hot key of `rows` is split over many tasks: over `HOT_PARTS`,
    or more if a part would have more than `PART_ROWS` rows.

    Meant for `rows` that stay the same when computed again; rows equal in every column share a
    part, so collapse exact repeats first where they can be many.
    """
    counted = stored(_hot_counts(rows, on, HOT_SHARE), "hot")
    most = counted.agg(F.max("_rows")).first()[0] or 0
    parts = max(HOT_PARTS, -(-most // PART_ROWS))
    hot = counted.select(*on, F.lit(True).alias("_hot"))
    left = spread_rows(rows, hot, on, parts)
    right = spread_lookup(lookup, hot, on, parts)
    return left.join(right, [*on, "_part"], how).drop("_part")


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join `rows` with a lookup table ("inner" or "left").

    A lookup counted to fit is broadcast and `rows` are not shuffled; a larger one is joined by
    shuffle with the hot keys split.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if fits_broadcast(lookup, max_broadcast_rows):
        return rows.join(F.broadcast(lookup), list(on), how)
    return spread_join(rows, lookup, on, how)


def frequent_join(
    rows: DataFrame, lookup: DataFrame, on: str, uses: str, max_broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Inner join of `rows` with a stored lookup that has one row per key and says in `uses` how many
    rows need it.

    If the lookup is too large to broadcast, its most used keys are, and only rows of the others are
    shuffled. Every row is in one of the two parts, so nothing is lost. What is hot among the others
    (only very long keys can be) is split as in `spread_join`, without counting the rows again.
    """
    if fits_broadcast(lookup, max_broadcast_rows):
        return rows.join(F.broadcast(lookup), on)
    # Keys of any length are found by shuffle, so that the broadcast stays within its bound in bytes.
    short = F.coalesce(F.octet_length(F.col(on).cast("string")) * max_broadcast_rows <= BROADCAST_BYTES, F.lit(False))
    sizes = lookup.where(short).groupBy(uses).agg(F.count("*").alias("keys")).orderBy(F.desc(uses)).limit(max_broadcast_rows + 1)
    bound, have = 0, 0
    for size, keys in sizes.collect():
        have += keys
        if have > max_broadcast_rows:
            bound = size
            break
    used = short & (F.col(uses) > bound)
    top = F.broadcast(lookup.where(used))
    known = rows.join(top, on)
    others = rows.join(F.broadcast(lookup.where(used).select(on)), on, "left_anti")
    rest = lookup.where(~used)
    total = lookup.agg(F.sum(uses)).first()[0] or 0
    parts = max(HOT_PARTS, -(-(rest.agg(F.max(uses)).first()[0] or 0) // PART_ROWS))
    heavy = (F.col(uses) * F.lit(HOT_SHARE) > total) | (F.col(uses) > PART_ROWS)
    hot = rest.where(heavy).select(on, F.lit(True).alias("_hot"))
    joined = spread_rows(others, hot, [on], parts).join(spread_lookup(rest, hot, [on], parts), [on, "_part"]).drop("_part")
    return known.select(*joined.columns).unionByName(joined)
