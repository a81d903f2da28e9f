"""Document fingerprints by SpotSigs, with built-in expressions only.

Common words are anchors. A spot signature is an anchor (or several in a row) with the chain of the
two content words that follow, other anchors skipped; the start of a text is an anchor too. Spots
leave out text without common words, such as menus, and depend on nothing outside the text.

Fingerprints cover the whole of every text: where no listed word is near, pairs of content words
that follow each other are signatures too.

The fingerprint of a text is the size of its signature set and the hashes of the whole set, sorted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from agoralens.operators.ordering import running_totals, value_counts
from agoralens.sources.scratch import new_folder

#: Common words of English, German, French and Spanish.
ANCHORS = (
    "the a an is was are be of and to in that it for on with as by from or this at not "
    "der die das und den von zu mit ist im dem ein eine auf für sich des nicht "
    "le la les de du et en un une que qui dans est pour par sur au aux pas "
    "el los las del y una se por con para su al lo como más es"
).split()
_MARK = "\u0001"


def spots(text: str | Column, *, cover: bool = False) -> Column:
    """The hashes of a text's spot signatures, in order, with repeats. NULL is an empty text.

    `cover` adds each content word that no spot holds, with the content word before it.
    """
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")
    marked = F.transform(words, lambda w: F.when(w.isin(ANCHORS), F.concat(w, F.lit(_MARK))).otherwise(w))
    # Cut after every word that is no anchor: each part is a content word with the anchors before it.
    parts = F.split(F.concat(F.lit(f"^{_MARK} "), F.array_join(marked, " ")), f"(?<!{_MARK}) ")

    def chain(a: Column, b: Column) -> Column:
        anchored = F.contains(a, F.lit(_MARK)) & (a != f"^{_MARK} ")
        spot = F.when(anchored, F.xxhash64(a, F.substring_index(F.coalesce(b, F.lit("")), f"{_MARK} ", -1)))
        bare = ~F.contains(a, F.lit(_MARK)) & ~F.contains(b, F.lit(_MARK))
        return spot.when(bare, F.xxhash64(F.lit(""), a, b)) if cover else spot

    # As the one element of an array, the parts are made once, however often they are used.
    chained = F.transform(
        F.array(parts), lambda p: F.zip_with(p, F.slice(p, 2, F.greatest(F.lit(1), F.size(p) - 1)), chain)
    )
    return F.filter(chained[0], lambda h: h.isNotNull())


def sketch(text: str | Column, *, cover: bool = False) -> Column:
    """`n` (distinct signatures) and `least` (all their hashes, the least first)."""
    distinct = F.array_distinct(spots(text, cover=cover))
    return F.transform(
        F.array(distinct),
        lambda s: F.struct(F.size(s).alias("n"), F.sort_array(s).alias("least")),
    )[0]


def shown(found: Column) -> Column:
    """A sketch as text: set size, then hashes in hexadecimal."""
    return F.concat_ws(":", found["n"].cast("string"), F.array_join(F.transform(found["least"], lambda h: F.hex(h)), ","))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two signature sets, 0 to 1; 1 for two empty sets."""
    shared = F.transform(F.array(F.size(F.array_intersect(a["least"], b["least"]))), lambda k: k / (a["n"] + b["n"] - k))[0]
    return (
        F.when((a["n"] == 0) & (b["n"] == 0), F.lit(1.0))
        .when((a["n"] == 0) | (b["n"] == 0), F.lit(0.0))
        .otherwise(shared)
    )


def near_pairs(docs: DataFrame, threshold: float = 0.8, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pairs `a` < `b` of representatives whose full signature sets have a Jaccard likeness of at
    least `threshold`, with `likeness`.

    Equal sets are one from the start, under their smallest id (see `representatives`). Sets are
    partitioned by length so that only a partition and the next longer one can hold partners. Within
    a set, signatures go by how rare they are; two sets that are alike enough share one of the first
    n - ceil(threshold * n) + 1, so only those are joined. Before the sets are intersected, the
    rank of the first common signature bounds what can still be common. Empty sets, rows without an
    id and NULL texts have no partners.
    """
    spark = docs.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        folder = new_folder(spark, name)
        df.write.parquet(folder)
        return spark.read.parquet(folder)

    sets = representatives(docs, id_col=id_col, text_col=text_col)
    sets = stored(sets.select(F.col("representative").alias("id"), "items").where("size(items) > 0").dropDuplicates(["id"]), "spots")
    items = sets.select("id", F.size("items").alias("n"), F.explode("items").alias("item"))
    common = items.groupBy("item").agg(F.count("*").alias("df"))
    ordered = items.join(common, "item").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "item"))).alias("rare"))
    # Products of fractions may come out a little above whole numbers, which must not cost a pair.
    first = (F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1).cast("int")
    heads = ordered.select("id", "n", F.posexplode(F.slice("rare.item", 1, first)).alias("rank", "item"))
    part = F.floor(F.log(F.col("n")) / F.lit(-math.log(threshold)) + 1e-9)
    heads = stored(heads.withColumn("part", part), "heads")
    x = heads.select(*[F.col(c).alias(f"{c}_a") for c in heads.columns])
    y = heads.withColumn("part", F.explode(F.array("part", F.col("part") + 1))).select(*[F.col(c).alias(f"{c}_b") for c in heads.columns])
    # x is the longer set (or has the larger id): it meets y in its own partition.
    longer = (F.col("n_a") > F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("id_a") > F.col("id_b")))
    short = F.col("n_b") + 1e-9 >= F.lit(threshold) * F.col("n_a")
    left = F.least(F.col("n_a") - F.col("rank_a"), F.col("n_b") - F.col("rank_b"))
    # Common signatures lie behind the first one; with fewer than needed the pair is out.
    enough = left + 1e-9 >= F.lit(threshold / (1 + threshold)) * (F.col("n_a") + F.col("n_b")) - F.col("rank_a")
    met = x.join(y, (F.col("item_a") == F.col("item_b")) & (F.col("part_a") == F.col("part_b")) & longer & short & enough)
    pairs = met.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()
    full = pairs.join(sets.select(F.col("id").alias("a"), F.col("items").alias("items_a")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("items").alias("items_b")), "b"
    )
    both = F.size(F.array_intersect("items_a", "items_b"))
    value = both / (F.size("items_a") + F.size("items_b") - both)
    return full.select("a", "b", value.alias("likeness")).where(F.col("likeness") >= threshold)


def representatives(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, `items` (the signature set, sorted) and `representative` (smallest id with it)."""
    known = docs.where(F.col(id_col).isNotNull()).select(id_col, F.sort_array(F.array_distinct(spots(text_col))).alias("items"))
    known = known.withColumn("_set", F.sha2(F.array_join(F.transform("items", lambda h: F.hex(h)), ","), 256))
    least = known.groupBy("_set").agg(F.min(id_col).alias("representative"))
    return known.join(least, "_set").drop("_set")


def fingerprint_and_edited(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: its fingerprint, that of its edited text, and likenesses.

    Columns: `id_col`, `n_chars`, `edited_sha256`, `fingerprint`, `edited_fingerprint`,
    `near_edited`, `near_next`. The edited text is the text with its last floor(n_chars / 3)
    characters replaced by as many first ones of the next document by descending id (the last one's
    next is the first). Of several rows with the next id, the one with the smallest text hash counts.
    Rows without an id come after no other and have an empty next text. NULL is an empty text.

    Ids find their neighbours by their place in the order, which is counted over ranges of ids;
    texts are shuffled once by id, and once more as next texts, which are smaller than their sets.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    sizes = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("hash")
    )
    folder = new_folder(spark, "ids")
    sizes.groupBy("id").agg(F.min("hash").alias("hash")).write.parquet(folder)
    ids = spark.read.parquet(folder)
    places = running_totals(value_counts(ids, "id"), "value", ["n"], descending=True)
    placed = new_folder(spark, "places")
    places.select(F.col("value").alias("id"), F.col("before_n").alias("place"), F.col("total_n").alias("total")).write.parquet(placed)
    places = spark.read.parquet(placed)
    after = places.select(F.col("id").alias("owner"), F.pmod(F.col("place") + 1, F.col("total")).alias("place"))
    links = after.join(places.select("id", "place"), "place").drop("place")
    links = links.join(ids, "id")

    known = texts.where(F.col("id").isNotNull())
    following = (
        known.join(links, "id")
        # No equality of two columns, which would become a second join key and a second shuffle.
        .where(F.xxhash64("text").bitwiseXOR(F.col("hash")) == 0)
        .select(F.col("owner").alias("id"), F.col("text").alias("following"))
        .dropDuplicates(["id"])
    )
    nothing = texts.where(F.col("id").isNull()).select("id", "text", F.lit("").alias("following"))
    both = known.join(following, "id").unionByName(nothing)
    n = F.length("text")
    changed = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - changed), F.substring("following", F.lit(1), changed))
    found = both.select("id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"), "following")
    found = found.select(
        "id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        sketch("text", cover=True).alias("own"), sketch("edited", cover=True).alias("other"),
        sketch("following", cover=True).alias("next"),
    )
    return found.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256",
        shown(F.col("own")).alias("fingerprint"), shown(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"),
    )
