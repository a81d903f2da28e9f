"""Mixing sources to target weights: which documents a mix takes, and how often.

Every document gets a random but repeatable key, the md5 of its id. Keys are uniform, so their first
digits cut each source into ranges of equal share. Word counts are added up per (source, range), a
running sum over a source's ranges finds the range its budget ends in, and only that range's
documents are ordered one by one. No task sees a whole source. Built-in expressions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from agoralens.operators.lookups import lookup_join
from agoralens.sources.scratch import new_folder

WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the key that name its range: 16**3 ranges per source.
RANGE_DIGITS = 3


def words(text: str | Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Add `target` to one row per source (`source`, `source_size`).

    Sources in order (NULL last) weigh `weights`, repeating, and share `share` times all words;
    none gets more than `most` times its own, and what is too much goes to the others by weight.
    At the end all sources below their bound get `level` words per weight. Going through the
    sources by bound per weight, those whose bound is at or below the level the rest would get are
    full. The windows here run over one row per source.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    every = F.array(*[F.lit(w) for w in weights])
    place = F.row_number().over(order) - 1
    ranked = sizes.withColumn("weight", F.element_at(every, (place % len(weights) + 1).cast("int")).cast("double"))
    ranked = ranked.withColumn("bound", F.lit(float(most)) * F.col("source_size"))
    by_bound = W.orderBy((F.col("bound") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_bound.rowsBetween(W.unboundedPreceding, -1)
    rest = by_bound.rowsBetween(W.currentRow, W.unboundedFollowing)
    total = F.lit(float(share)) * F.sum("source_size").over(W.partitionBy())
    level = (total - F.coalesce(F.sum("bound").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    found = ranked.withColumn("_level", level).withColumn("_open", F.col("bound") > F.col("_level") * F.col("weight"))
    # The level of the first source that is not full holds for all after it.
    level = F.first(F.when(F.col("_open"), F.col("_level")), ignorenulls=True).over(
        by_bound.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    target = F.coalesce(F.least(F.col("bound"), level * F.col("weight")), F.col("bound"))
    return found.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = "",
    with_row: bool = False,
) -> DataFrame:
    """One row per document: `id_col`, `source`, `size`, `source_size`, `target` and `taken` (words);
    `with_row` adds the input row as struct `row`.

    A source's mix is its documents in the order of their keys, over and over, cut after exactly
    floor(target) words: whole rounds for all, then one more for the documents before the cut, and
    the first words of the one it falls into. NULL texts have size 0 and take nothing. Rows that
    repeat in full are told apart by nothing and get equal shares up to the cut. An empty table
    gives an empty result. Two small tables (id, source, size, key; words per range) are stored
    in the shared folder (the first with the input rows, if asked for), so texts are read once. Other
    columns are not read.
    """
    spark = docs.sparkSession
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    sized = new_folder(spark, "mix-sizes")
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if with_row else []
    docs.select(
        F.col(id_col), F.col(source_col).alias("source"), words(text_col).alias("size"), key.alias("_key"), F.substring(key, 1, RANGE_DIGITS).alias("_range"), *row
    ).write.parquet(sized)
    rows = spark.read.parquet(sized)
    stored = new_folder(spark, "mix-ranges")
    rows.groupBy("source", "_range").agg(F.sum("size").alias("words")).write.parquet(stored)
    ranges = spark.read.parquet(stored)

    sources = targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    sources = sources.withColumn("_rounds", F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0)))
    sources = sources.withColumn("_budget", F.floor("target") - F.col("_rounds") * F.col("source_size"))
    upto = W.partitionBy("source").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    begun = ranges.withColumn("_before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    plan = begun.join(sources.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of"))).drop("_of")
    ends = (F.col("_before") < F.col("_budget")) & (F.col("_before") + F.col("words") > F.col("_budget"))
    cut = plan.groupBy("source", "source_size", "target", "_rounds", "_budget").agg(
        F.max(F.when(ends, F.col("_range"))).alias("_cut"),
        F.max(F.when(ends, F.col("_before"))).alias("_before"),
        F.max(F.when(F.col("_before") + F.col("words") <= F.col("_budget"), F.col("_range"))).alias("_full"),
    )
    # NULL sources join by a stand-in that no source can be.
    named = cut.withColumn("_name", F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"))).drop("source")
    keyed = rows.withColumn("_name", F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")))
    joined = lookup_join(keyed, named, ["_name"])
    whole = F.when(F.col("_range") <= F.col("_full"), F.col("size")).otherwise(F.lit(0))
    outside = joined.where(F.col("_cut").isNull() | (F.col("_range") != F.col("_cut"))).withColumn("_more", whole)
    inside = joined.where(F.col("_range") == F.col("_cut"))
    run = W.partitionBy("_name").orderBy("_key", id_col, "size").rowsBetween(W.unboundedPreceding, -1)
    left = F.col("_budget") - F.col("_before") - F.coalesce(F.sum("size").over(run), F.lit(0))
    inside = inside.withColumn("_more", F.greatest(F.lit(0), F.least(F.col("size"), left)))
    return outside.unionByName(inside).select(
        id_col, "source", "size", "source_size", "target",
        (F.col("_rounds") * F.col("size") + F.col("_more")).cast("long").alias("taken"),
        *["row"] * with_row,
    )


def copies(mixed: DataFrame, text_col: str = "text", count_col: str | None = "n_chars") -> DataFrame:
    """The mix itself, from `mix(..., with_row=True)`: input rows as often as they are taken.

    A document that is taken in part comes with its first words, joined by one space, and with
    `count_col` set to the new number of characters; documents of which nothing is taken are left out.
    """
    whole = F.floor(F.col("taken") / F.nullif("size", F.lit(0)))
    part = F.col("taken") - whole * F.col("size")
    times = F.concat(F.array_repeat(F.lit(0).cast("long"), whole.cast("int")), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")))
    rows = mixed.where("taken > 0").select("row", F.explode(times).alias("_first"))
    split = F.filter(F.split(F.col("row")[text_col], r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = F.array_join(F.slice(split, F.lit(1), F.col("_first").cast("int")), " ")
    fields = []
    for name in mixed.schema["row"].dataType.names:
        column = F.col("row").getField(name)
        if name == text_col:
            column = F.when(F.col("_first") > 0, cut).otherwise(column)
        elif name == count_col:
            column = F.when(F.col("_first") > 0, F.length(cut)).otherwise(column)
        fields.append(column.alias(name))
    return rows.select(*fields)
