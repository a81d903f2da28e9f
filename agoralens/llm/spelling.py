"""Spelling variants of a vocabulary, by a bit-sliced position index.

Words are cut at half their length. A single inserted, deleted or replaced code point leaves one half as
it is, so two near words share a bucket: that of their common first or last half and their smaller
length. In a bucket, one bitset per (position, letter) tells which of its words have that letter there.
Reading a word letter by letter, three bitsets follow all words of the bucket at once: those that agree
so far, those with one replaced letter, and those with one letter more (their letters are looked up at
the shifted position). A pair of unequal lengths is found from its shorter word, so a deletion is an
insertion seen from the other side. No two words are compared by themselves.

A bucket is searched through in blocks, and buckets of very many words are cut finer: their words are
cut into four parts, of which three stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from agoralens.operators.lookups import fits_broadcast
from agoralens.sources.scratch import stored

#: Words of one bucket that are indexed in one go.
BUCKET = 4096
SHORTEST, RAREST = 5, 3
RUNS = r"[A-Za-zÀ-ÿ]+"
SLIPS = 97
#: Every word followed from form to form has at least twice the count, so chains end.
FACTOR = 2

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`word` and `n`, its occurrences: runs of letters with A-Z lower-cased, of at least 5 code points
    and 3 occurrences. One run in 97 (by the CRC-32 of `<id>:<run>`; a NULL id is empty) loses one letter
    first, as a slip of the pen would."""
    runs = F.regexp_extract_all(F.translate(F.col(text_col), _UPPER, _LOWER), F.lit(RUNS), F.lit(0))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = rows.withColumn("h", h).select(F.when(F.col("h") % SLIPS == 0, slipped).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= SHORTEST).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= RAREST)


def _keys(word: Column, parts: int) -> Column:
    """Buckets of a word: for its own length and for that less one (as the longer of a pair), one per
    part left out. Array of structs: `size`, `out` (the part left out) and `rest` (all other letters)."""
    found = []
    for longer in (0, 1):
        size = F.length(word) - longer
        cuts = [F.floor(size * i / parts).cast("int") for i in range(parts + 1)]
        for out in range(parts):
            # Letters behind the part left out lie one place further on in the longer word.
            head = F.substring(word, F.lit(1), cuts[out])
            tail = F.substring(word, cuts[out + 1] + 1 + longer, F.length(word))
            found.append(F.struct(size.alias("size"), F.lit(out).alias("out"), F.concat_ws("\x00", head, tail).alias("rest")))
    return F.array(*found)


class Index:
    """Words of two neighbouring lengths by position and letter."""

    def __init__(self, words: list[str]) -> None:
        at: dict[tuple[int, str], list[int]] = {}
        lengths: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            lengths.setdefault(len(word), []).append(i)
            for place, letter in enumerate(word):
                at.setdefault((place, letter), []).append(i)
        self.at = {key: bits(members, len(words)) for key, members in at.items()}
        self.lengths = {length: bits(members, len(words)) for length, members in lengths.items()}

    def near(self, word: str) -> tuple[int, int]:
        """Bitsets of the words that differ from `word` by one replaced letter, and of those that have
        exactly one letter more."""
        size = len(word)
        same = self.lengths.get(size, 0)
        more = self.lengths.get(size + 1, 0)
        none, replaced, ahead = same | more, 0, 0
        slot = self.at
        for place, letter in enumerate(word):
            here, next_one = slot.get((place, letter), 0), slot.get((place + 1, letter), 0)
            # A word may take its extra letter at any place at which it agreed so far.
            ahead = (ahead | none & more) & next_one
            replaced = replaced & here | none & ~here
            none &= here
        return replaced & same, (ahead | none) & more


def bits(members: list[int], size: int) -> int:
    """The bitset of the given places."""
    flags = bytearray((size + 7) // 8)
    for i in members:
        flags[i >> 3] |= 1 << (i & 7)
    return int.from_bytes(flags, "little")


def places(bitset: int) -> Iterator[int]:
    while bitset:
        low = bitset & -bitset
        yield low.bit_length() - 1
        bitset ^= low


def common_parts(word: str, other: str, cuts: list[int]) -> int:
    """The first part that can be left out so that the rest of both words is the same. `cuts` are those
    of the shorter word, `word`."""
    extra = len(other) - len(word)
    for out in range(len(cuts) - 1):
        if word[: cuts[out]] == other[: cuts[out]] and word[cuts[out + 1] :] == other[cuts[out + 1] + extra :]:
            return out
    raise ValueError("words are not near")


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket (`parts`, `size`, `out`, `rest`, `word`, `n`) to, per word with near words in
    its bucket, their number and the best of them (`word`, `n_near`, `best_n`, `best`). A pair that meets
    in several buckets counts in the first of them."""

    def better(a: tuple[int, str], b: tuple[int, str] | None) -> bool:
        return b is None or a[0] > b[0] or (a[0] == b[0] and a[1] < b[1])

    def searched(key: tuple, words: list[str], counts: list[int], out: list) -> None:
        parts, size, left_out, _ = key
        cuts = [size * i // parts for i in range(parts + 1)]
        number: dict[int, int] = {}
        best: dict[int, tuple[int, str]] = {}
        for first in range(0, len(words), BUCKET):
            index = Index(words[first : first + BUCKET])
            for i, word in enumerate(words):
                if len(word) != size:
                    continue
                replaced, longer = index.near(word)
                if not replaced and not longer:
                    continue
                for j in places(replaced | longer):
                    j += first
                    # Pairs of one length are found from both sides, others only from the shorter one.
                    if (len(words[j]) == size and j < i) or common_parts(word, words[j], cuts) != left_out:
                        continue
                    for a, b in ((i, j), (j, i)):
                        number[a] = number.get(a, 0) + 1
                        if better(new := (counts[b], words[b]), best.get(a)):
                            best[a] = new
        out.extend((words[i], n, *best[i]) for i, n in number.items())

    def made(rows: list) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 4, kinds)], names=["word", "n_near", "best_n", "best"]
        )

    last, words, counts = None, [], []
    for batch in batches:
        out: list = []
        for *key, word, n in zip(*[c.to_pylist() for c in batch.columns]):
            if key != last:
                if len(words) > 1:
                    searched(last, words, counts, out)
                last, words, counts = key, [], []
            words.append(word)
            counts.append(n)
        yield made(out)
    out = []
    if len(words) > 1:
        searched(last, words, counts, out)
    yield made(out)


def near_words(words: DataFrame, *, bucket: int = BUCKET) -> DataFrame:
    """`word`, `n_near` (number of words at one edit) and the most frequent of them (`best_n`, `best`;
    ties: smallest in code-point order) for all words of `words` (`word`, `n`; stored, no repeats) that
    have any. Buckets of more than `bucket` words are cut into finer ones, with the same pairs."""
    placed = words.select("word", "n", F.explode(_keys(F.col("word"), 2)).alias("key")).select("key.*", "word", "n")
    key = ["size", "out", "rest"]
    # The longer words of a bucket matter only next to shorter ones, and a word alone has no partner.
    sizes = placed.groupBy(*key).agg(F.count("*").alias("members"), F.min(F.length("word")).alias("shortest"))
    large = stored(sizes.where((F.col("members") > bucket) & (F.col("shortest") == F.col("size"))).select(*key), "large")
    halves = placed.select(F.lit(2).alias("parts"), *key, "word", "n")
    if not large.isEmpty():
        side = F.broadcast(large) if fits_broadcast(large) else large
        found = placed.join(side, key, "left_semi")
        halves = placed.join(side, key, "left_anti").select(F.lit(2).alias("parts"), *key, "word", "n")
        finer = found.select("size", "out", "word", "n", F.explode(_keys(F.col("word"), 4)).alias("key"))
        # Both quarters of the half that differs may be the one left out.
        finer = finer.where((F.col("key.size") == F.col("size")) & (F.floor(F.col("key.out") / 2) == F.col("out")))
        halves = halves.unionByName(finer.select(F.lit(4).alias("parts"), "key.*", "word", "n"))
    dealt = halves.repartition("parts", *key).sortWithinPartitions("parts", *key, "word")
    found = dealt.mapInArrow(_search, "word string, n_near long, best_n long, best string")
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.max("best_n").alias("best_n"), F.min_by("best", F.struct(-F.col("best_n"), "best")).alias("best")
    )


def roots(links: DataFrame) -> DataFrame:
    """`word` and `root` of a forest given as `word` and `form` (no cycles): the last word on the way from
    form to form. Ways double in every round, so a way of k words takes some log2(k) rounds."""
    now = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = now.join(now.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
        step = stored(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word of the vocabulary: `word`, `form` (the near word of largest count, if that is at
    least twice the word's; ties: smallest in code-point order; else NULL), `root` (where the forms lead;
    the word itself if it has none), `n`, `n_near` and `form_n`.

    NULL and empty texts have no words; repeated rows count again; an empty table gives an empty result.
    Other columns are not read. The counted vocabulary, searched words and ways are stored.
    """
    words = stored(vocabulary(docs, id_col=id_col, text_col=text_col), "words")
    near = near_words(words)
    likely = F.col("best_n") >= FACTOR * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(likely, F.col("best")).alias("form"), F.when(likely, F.col("best_n")).alias("form_n"),
    )
    formed = stored(formed, "formed")
    ways = roots(formed.where("form IS NOT NULL"))
    return formed.join(ways, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
