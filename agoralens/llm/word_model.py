"""Cross-entropy difference of documents under a target and a background word model.

Tokens are the corpus's own words, in any script, without case for A-Z (see `batches`). Both models
interpolate bigrams, words and a uniform share over the corpus's vocabulary, which they have in
common; their tables hold counts of every bigram of the corpus and grow with it.

Words and bigrams are 64-bit keys; equal ones are taken for equal words. Keys are shuffled in sorted
runs, by their place among all 64-bit values (bucket), and never one row per key: most bigrams occur once
or twice, so that there are nearly as many of them as words in all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralens.llm.batches import Chunk, chunks, find_words, mix, string_column
from agoralens.sources.scratch import stored

#: Weight of the bigram and the word estimate; the rest goes to the uniform one.
WEIGHTS = (0.6, 0.3)
#: What stands before the first word of a text.
START = np.uint64(0x9E3779B97F4A7C15)
#: Keys that a task adds up before it hands them on.
HELD = 500_000
#: Frequent words and bigrams that every task knows; the others are looked up by shuffle.
FREQUENT = 400_000
#: Bytes of text for each bucket of keys and for each block of texts, which one task holds in memory.
BUCKET_BYTES, BLOCK_BYTES = 4_000_000, 8_000_000
#: Keys in one run.
RUN = 50_000

#: Set in keys of words, not in those of bigrams.
WORD = np.uint64(1)
#: What is counted of a key: in all texts and in the target's, and how often a word ends a text.
COUNTED = ("background", "target", "ends_background", "ends_target")
#: A key that is not in the table of counts.
ONCE = np.array([1, 0, 0, 0])


class Totals(NamedTuple):
    """Number of different bigrams and words; words, and texts with a word, in all texts and in the target's."""

    bigrams: int
    vocabulary: int
    words: tuple[int, int]
    texts: tuple[int, int]


@dataclass(frozen=True)
class Counts:
    """Counts of a corpus. `table` is stored, one row per run of ascending `keys` of a `bucket`, with
    their counts (`COUNTED`), all of them packed (see `packed`); it leaves out keys that occur once, not in the target and, if words, not
    at the end of a text: any key of the corpus that is not there has these counts (`ONCE`).
    """

    table: DataFrame
    buckets: int
    blocks: int
    totals: Totals

    def count(self) -> int:
        """Number of different bigrams."""
        return self.totals.bigrams


class Tokens(NamedTuple):
    """Words of a chunk: their rows, whether they are the first and the last of a text, and the keys of
    each word and of the bigram that it ends."""

    rows: np.ndarray
    first: np.ndarray
    last: np.ndarray
    words: np.ndarray
    bigrams: np.ndarray


def tokens(chunk: Chunk) -> Tokens:
    found = find_words(chunk, lower=True)
    filled = np.diff(found.bounds) > 0
    first, last = np.zeros((2, len(found.hashes)), bool)
    first[found.bounds[:-1][filled]] = True
    last[found.bounds[1:][filled] - 1] = True
    before = np.empty_like(found.hashes)
    before[1:] = found.hashes[:-1]
    before[first] = START
    return Tokens(found.rows, first, last, found.hashes | WORD, mix(before * START + found.hashes) & ~WORD)


def runs(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """Bucket, begin and end of runs of ascending keys."""
    # Keys are evenly spread; the high halves are cut into equal ranges.
    of = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    bounds = np.searchsorted(of, np.arange(buckets + 1, dtype=np.uint64))
    for bucket in np.flatnonzero(np.diff(bounds)):
        for at in range(bounds[bucket], bounds[bucket + 1], RUN):
            yield int(bucket), at, min(at + RUN, int(bounds[bucket + 1]))


def packed(values: np.ndarray) -> bytes:
    """How many 64-bit values, and their bytes: the lowest byte of all, then the next one, without high
    bytes that are 0 in all."""
    places = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T
    used = np.flatnonzero(places.any(axis=1))
    return np.int64(len(values)).tobytes() + places[: used[-1] + 1 if len(used) else 0].tobytes()


def unpacked(column: pa.ChunkedArray) -> list[np.ndarray]:
    made = []
    for value in column:
        held = np.frombuffer(value.as_buffer(), np.uint8)
        places = np.zeros((int(held[:8].view(np.int64)[0]), 8), np.uint8)
        used = (len(held) - 8) // max(1, len(places))
        places[:, :used] = held[8:].reshape(used, len(places)).T
        made.append(places.view(np.int64).ravel())
    return made


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys by their differences."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.cumsum(x.view(np.uint64), dtype=np.uint64) for x in unpacked(column)]


def joined(parts: list[np.ndarray], kind: type = np.int64) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *parts])


def binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def different(keys: np.ndarray) -> np.ndarray:
    """Ascending different keys. By sorting: `np.unique` is many times slower where it hashes."""
    keys = np.sort(keys)
    return keys[firsts(keys)]


def firsts(keys: np.ndarray) -> np.ndarray:
    """Where a new key begins in ascending keys."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new)


def add_up(keys: np.ndarray, counts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ascending different keys and the sums of their counts."""
    order = np.argsort(keys)
    keys = keys[order]
    first = firsts(keys)
    return keys[first], [np.add.reduceat(c[order], first) if len(first) else c for c in counts]


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """What is stored meanwhile leaves no shuffle files behind."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class Held:
    """Keys and counts that a task adds up; of keys of words all counts, of those of bigrams the first two."""

    def __init__(self, n: int) -> None:
        self.n = n
        self.clear()

    def clear(self) -> None:
        self.parts: list[tuple[np.ndarray, list[np.ndarray]]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: list[np.ndarray]) -> None:
        self.parts.append((keys, counts))
        self.size += len(keys)

    def added(self) -> tuple[np.ndarray, list[np.ndarray]]:
        keys = joined([k for k, _ in self.parts], np.uint64)
        keys, counts = add_up(keys, [joined([c[i] for _, c in self.parts]) for i in range(self.n)])
        self.parts, self.size = [(keys, counts)], len(keys)
        return keys, counts


PACKED = ", ".join(f"{c} binary" for c in COUNTED)
SUMS = ("n_bigrams", "n_words", *[f"words_{c}" for c in COUNTED])


def count(docs: DataFrame, in_target: str, *, text_col: str = "text") -> Counts:
    """Counts of all words and bigrams in all texts and in rows where `in_target` holds.

    Each task adds up runs of rows before anything is shuffled. NULL texts and flags count as empty
    and false.
    """
    spark = docs.sparkSession
    rows = docs.select(text_col, F.col(in_target).cast("boolean"))
    size = rows.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets, blocks = (max(1, size // most) for most in (BUCKET_BYTES, BLOCK_BYTES))

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Held(4), Held(2)]

        def given(keys: np.ndarray, counts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            counts = counts + [np.zeros(len(keys), np.int64)] * (len(COUNTED) - len(counts))
            for bucket, a, b in runs(keys, buckets):
                columns = [[packed_keys(keys[a:b])], *[[packed(c[a:b])] for c in counts]]
                yield pa.RecordBatch.from_arrays([pa.array([bucket]), *map(binary, columns)], names=["bucket", "keys", *COUNTED])

        for batch in batches:
            flags = batch.column(1).fill_null(False).to_numpy(zero_copy_only=False).astype(np.int64)
            for chunk in chunks(string_column(batch, text_col)):
                found = tokens(chunk)
                good = flags[chunk.first + found.rows]
                one, last = np.ones_like(good), found.last.astype(np.int64)
                held[0].add(*add_up(found.words, [one, good, last, last * good]))
                held[1].add(found.bigrams, [one, good])
                for own in held:
                    if own.size > HELD:
                        total = own.added()
                        if own.size > HELD // 2:
                            own.clear()
                            yield from given(*total)
        for own in held:
            yield from given(*own.added())

    def in_bucket(found: pa.Table) -> pa.Table:
        keys, counts = add_up(joined(unpacked_keys(found["keys"]), np.uint64), [joined(unpacked(found[c])) for c in COUNTED])
        word = (keys & WORD).astype(bool)
        sums = [(~word).sum(), word.sum(), *[c[word].sum() for c in counts]]
        kept = np.any([c != n for c, n in zip(counts, ONCE)], axis=0)
        keys, counts = keys[kept], [c[kept] for c in counts]
        made = []
        for at in range(0, max(1, len(keys)), RUN):
            columns = [[packed_keys(keys[at : at + RUN])], *[[packed(c[at : at + RUN])] for c in counts]]
            made.append([found["bucket"][0].as_py(), *[c[0] for c in columns], *[int(x) for x in sums]])
            sums = [0] * len(sums)
        kinds = [pa.int64(), *[pa.binary()] * 5, *[pa.int64()] * len(SUMS)]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), kinds)], ["bucket", "keys", *COUNTED, *SUMS])

    schema = f"bucket long, keys binary, {PACKED}"
    found = rows.mapInArrow(in_task, schema).groupBy("bucket").applyInArrow(in_bucket, f"{schema}, {', '.join(f'{c} long' for c in SUMS)}")
    with shuffles_deleted(spark):
        table = stored(found, "counts")
    n_bigrams, n_words, *sums = (n or 0 for n in table.agg(*[F.sum(c) for c in SUMS]).first())
    return Counts(table.select("bucket", "keys", *COUNTED), buckets, blocks, Totals(n_bigrams, n_words, tuple(sums[:2]), tuple(sums[2:])))


def least_frequent(model: DataFrame, most: int) -> int:
    """The smallest count `n` above which there are at most `most` `keys`."""
    sizes = model.groupBy("n").agg(F.sum("keys").alias("keys")).orderBy(F.desc("n")).limit(most + 1)
    have = 0
    for n, keys in sizes.collect():
        have += keys
        if have > most:
            return n
    return 0


def most_frequent(counts: Counts, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most `most` of the most frequent keys, ascending, and their counts (one row per kind)."""

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys = np.unique(joined(unpacked(batch.column(0))), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(keys)], names=["n", "keys"])

    bound = least_frequent(counts.table.select("background").mapInArrow(sizes, "n long, keys long"), most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [joined(unpacked_keys(batch.column(0)), np.uint64).view(np.int64)]
            columns += [joined(unpacked(c)) for c in batch.columns[1:]]
            frequent = columns[1] > bound
            yield pa.RecordBatch.from_arrays([pa.array(c[frequent]) for c in columns], names=["key", *COUNTED])

    found = counts.table.select("keys", *COUNTED).mapInArrow(run, ", ".join(f"{c} long" for c in ("key", *COUNTED))).toArrow()
    keys = found["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.stack([found[c].to_numpy()[order] for c in COUNTED])


def lookup(known: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of `asked` are in the ascending `known`, and where."""
    if not len(known):
        return np.zeros(len(asked), bool), np.zeros(len(asked), np.int64)
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return known[at] == asked, at


def losses(totals: Totals, found: Tokens, word: np.ndarray, bigram: np.ndarray) -> list[np.ndarray]:
    """Negative log probability of each word under the target's and the background's model, from the
    counts of its key and of its bigram's."""
    made = []
    uniform = 1 / max(1, totals.vocabulary)
    for kind in (1, 0):
        head = np.empty(len(found.rows), np.int64)
        head[1:] = word[kind, :-1] - word[2 + kind, :-1]
        head[found.first] = totals.texts[kind]
        pair = np.where(head > 0, bigram[kind] / np.maximum(head, 1), uniform)
        single = word[kind] / totals.words[kind] if totals.words[kind] else uniform
        made.append(-np.log(WEIGHTS[0] * pair + WEIGHTS[1] * single + (1 - sum(WEIGHTS)) * uniform))
    return made


def score(
    docs: DataFrame, counts: Counts, *, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT
) -> DataFrame:
    """Per row: `id_col`, `n_tokens` (words), mean `target_loss` and `background_loss` per word in nats
    and `difference` (target minus background: low for texts like the target's).

    `counts` are of a corpus that holds `docs`. The `frequent` most frequent words and bigrams go to every
    task. Texts are dealt out to blocks by their content; a block asks for the others once each, and gets
    their counts back in the order of their keys.
    A NULL text and one without words have 0 tokens and NULL losses.
    """
    known, values = most_frequent(counts, frequent)
    buckets, blocks, totals = counts.buckets, counts.blocks, counts.totals

    def unknown(keys: list[np.ndarray]) -> np.ndarray:
        """The different keys that not every task knows, ascending."""
        own = different(joined(keys, np.uint64))
        return own[~lookup(known, own)[0]]

    def ask(block: pa.Table) -> pa.Table:
        keys = unknown([different(np.concatenate([t.words, t.bigrams])) for t in map(tokens, chunks(block["text"]))])
        cut = list(runs(keys, buckets))
        columns = [pa.array([x[k] for x in cut], pa.int64()) for k in (0, 1)]
        asked = binary([packed_keys(keys[a:b]) for _, a, b in cut])
        return pa.Table.from_arrays([pa.repeat(block["_block"][0], len(cut)), *columns, asked], ["_block", "bucket", "start", "keys"])

    def answer(asks: pa.Table, table: pa.Table) -> pa.Table:
        have = joined(unpacked_keys(table["keys"]), np.uint64)
        order = np.argsort(have)
        have = have[order]
        got = [joined(unpacked(table[c]))[order] for c in COUNTED]
        columns: list[list[bytes]] = [[] for _ in COUNTED]
        for keys in unpacked_keys(asks["keys"]):
            found, at = lookup(have, keys)
            for column, n, once in zip(columns, got, ONCE):
                values = np.full(len(keys), once)
                values[found] = n[at[found]]
                column.append(packed(values))
        return pa.Table.from_arrays([asks["_block"], asks["start"], *map(binary, columns)], ["_block", "start", *COUNTED])

    def in_block(answers: pa.Table, block: pa.Table) -> pa.Table:
        parts, keys = [], []
        for chunk in chunks(block["text"]):
            found = tokens(chunk)
            own, back = np.unique(np.concatenate([found.words, found.bigrams]), return_inverse=True)
            words, bigrams = np.split(back.astype(np.int32), 2)
            parts.append((len(chunk.offsets) - 1, found._replace(rows=found.rows.astype(np.int32), words=words, bigrams=bigrams), own))
            keys.append(own)
        keys = unknown(keys)
        answers = answers.sort_by("start")
        got = [joined(unpacked(answers[c])) for c in COUNTED]
        if len(got[0]) != len(keys):
            raise ValueError("docs gave other texts when they were read again")
        n, sums = [], [np.zeros((2, 0))]
        for size, found, own in parts:
            here, at = lookup(known, own)
            rest = np.searchsorted(keys, own[~here])
            of = np.empty((len(COUNTED), len(own)), np.int64)
            of[:, here] = values[:, at[here]]
            of[:, ~here] = [g[rest] for g in got]
            lost = losses(totals, found, of[:, found.words], of[:, found.bigrams])
            n.append(np.bincount(found.rows, minlength=size))
            sums.append(np.stack([np.bincount(found.rows, x, size) for x in lost]))
        total, both = joined(n), np.concatenate(sums, axis=1)
        none = total == 0
        means = [pa.array(x / np.maximum(total, 1), mask=none) for x in (*both, both[0] - both[1])]
        return pa.Table.from_arrays([block["_id"], pa.array(total), *means], names)

    names = [id_col, "n_tokens", "target_loss", "background_loss", "difference"]
    block = F.pmod(F.xxhash64(id_col, text_col), F.lit(blocks)).alias("_block")
    blocks = docs.select(block, F.col(id_col).alias("_id"), F.col(text_col).alias("text")).groupBy("_block")
    asks = blocks.applyInArrow(ask, "_block long, bucket long, start long, keys binary")
    answers = asks.groupBy("bucket").cogroup(counts.table.groupBy("bucket")).applyInArrow(answer, f"_block long, start long, {PACKED}")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens long, target_loss double, background_loss double, difference double"
    return answers.groupBy("_block").cogroup(blocks).applyInArrow(in_block, schema)
