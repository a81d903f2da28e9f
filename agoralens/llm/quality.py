"""Quality rules: boosted trees over document statistics, with monotonic constraints.

Statistics are made in one pass over the texts. Trees are fitted on a bounded sample of labelled
rows, level by level on binned features: a split on a constrained feature must move the score the
allowed way, and later splits below it stay on their side of the middle. Fitted trees are flat numpy
arrays of nodes, through which whole batches of rows go down together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from agoralens.llm.batches import chunks, find_words, mix, string_column, windows
from agoralens.operators.lookups import lookup_join
from agoralens.sources.scratch import new_folder

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "word_length", "symbols_per_word", "dup_lines", "repeat_words", "upper", "digits",
    "shouts_per_word", "bars_per_word", "distinct_words", "line_words", "non_ascii",
)
#: -1: a higher value may only lower the score.
MONOTONE = {"symbols_per_word": -1, "dup_lines": -1, "repeat_words": -1, "shouts_per_word": -1, "bars_per_word": -1}


def _marks(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in chars]] = True
    return table


_SYMBOLS = _marks("#*$%&|<>")
_UPPER = _marks("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _marks("abcdefghijklmnopqrstuvwxyz")
_DIGITS = _marks("0123456789")
_SHOUTS = _marks("!?")
_BARS = _marks("|")
_BLANK = _marks(" \t\n\r\x0b\x0c")
_FIRST = (np.arange(256) & 0xC0) != 0x80
_HIGH = np.arange(256) >= 0xC0


def _repeated_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines), len(lines) - len(set(lines))


def chunk_statistics(chunk) -> tuple[np.ndarray, np.ndarray]:
    """`COUNTS` and `FEATURES` of each row of a chunk."""
    n = len(chunk.offsets) - 1
    words = find_words(chunk)

    def per_row(flags: np.ndarray, bounds: np.ndarray = chunk.offsets) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[bounds])

    data = chunk.data
    n_words = np.diff(words.bounds)
    word_chars = per_row(_FIRST[data] & ~_BLANK[data])
    symbols = per_row(_SYMBOLS[data])
    lines = np.zeros((n, 2), np.int64)
    for r in range(n):
        lines[r] = _repeated_lines(data[chunk.offsets[r] : chunk.offsets[r + 1]].tobytes())

    own = mix(words.rows.astype(np.uint64) + np.uint64(1))
    covered = np.zeros(len(words.rows) + 1, np.int64)
    if len(words.rows) >= 3:
        inside = np.flatnonzero(words.rows[2:] == words.rows[:-2])
        runs = windows(words.hashes, 3)[inside] ^ own[inside]
        _, back, times = np.unique(runs, return_inverse=True, return_counts=True)
        again = inside[times[back] > 1]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + 3, -1)
    repeats = per_row(np.cumsum(covered)[:-1] > 0, words.bounds)
    _, first = np.unique(words.hashes ^ own, return_index=True)
    seen = np.zeros(len(words.rows), bool)
    seen[first] = True
    distinct = per_row(seen, words.bounds)

    counts = np.stack([n_words, word_chars, symbols, lines[:, 1], repeats], axis=1)
    w, c = np.maximum(n_words, 1), np.maximum(word_chars, 1)
    upper, lower = per_row(_UPPER[data]), per_row(_LOWER[data])
    features = np.stack(
        [
            np.log1p(n_words), word_chars / w, symbols / w, lines[:, 1] / np.maximum(lines[:, 0], 1), repeats / w,
            upper / np.maximum(upper + lower, 1), per_row(_DIGITS[data]) / c, per_row(_SHOUTS[data]) / w,
            per_row(_BARS[data]) / w, distinct / np.sqrt(w), n_words / np.maximum(lines[:, 0], 1), per_row(_HIGH[data]) / c,
        ],
        axis=1,
    )
    return counts, features


def statistics(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: `id_col`, `COUNTS` and `features` (array). NULL is an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [chunk_statistics(chunk) for chunk in chunks(string_column(batch, text_col))]
            if found:
                counts, features = (np.concatenate(x) for x in zip(*found))
                columns = [pa.array(counts[:, i]) for i in range(len(COUNTS))]
                columns.append(pa.array(features.tolist(), pa.list_(pa.float64())))
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_col, *COUNTS, "features"])

    kind = docs.schema[id_col].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {counts}, features array<double>")


class Trees(NamedTuple):
    """All nodes of all trees: leaves have feature -1; `roots` are the first nodes."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    start: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row: every row goes down each tree, a level of all rows at a time."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                feature = self.feature[node]
                down = np.where(x[rows, np.maximum(feature, 0)] <= self.threshold[node], self.left[node], self.right[node])
                node = np.where(feature < 0, node, down)
            total += self.value[node]
        return total


def fit(
    x: np.ndarray, y: np.ndarray, signs: Sequence[int], *, trees: int = 40, depth: int = 3, rate: float = 0.2,
    bins: int = 48, ridge: float = 1.0, least: int = 10,
) -> Trees:
    """Boosted trees for log loss. `signs` has -1, 0 or 1 per feature. Without rows of both kinds
    there are no trees and every row scores for the kind that is there (kept without any row)."""
    nodes: list[list[float]] = []
    roots: list[int] = []
    share = np.clip(y.mean() if len(y) else 1.0, 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))

    def built() -> Trees:
        flat = np.array(nodes, float).reshape(-1, 5)
        whole = [flat[:, i].astype(np.int64) for i in (0, 2, 3)]
        return Trees(whole[0], flat[:, 1], whole[1], whole[2], flat[:, 4], np.array(roots, np.int64), start, depth)

    if not len(y) or y.min() == y.max():
        return built()
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(x.shape[1])], axis=1)
    total = np.full(len(y), start)

    def grow(rows: np.ndarray, level: int, low: float, high: float, g: np.ndarray, h: np.ndarray) -> int:
        here = len(nodes)
        value = float(np.clip(-g[rows].sum() / (h[rows].sum() + ridge), low, high))
        nodes.append([-1, 0.0, here, here, rate * value])
        if level == depth or len(rows) < 2 * least:
            total[rows] += rate * value
            return here
        best = (1e-6, -1, -1, 0.0, 0.0)
        parent = g[rows].sum() ** 2 / (h[rows].sum() + ridge)
        for f in range(x.shape[1]):
            size = len(cuts[f]) + 1
            gs, hs, ns = (np.cumsum(np.bincount(binned[rows, f], v, size))[:-1] for v in (g[rows], h[rows], np.ones(len(rows))))
            gr, hr, nr = g[rows].sum() - gs, h[rows].sum() - hs, len(rows) - ns
            lv, rv = np.clip(-gs / (hs + ridge), low, high), np.clip(-gr / (hr + ridge), low, high)
            gain = gs**2 / (hs + ridge) + gr**2 / (hr + ridge) - parent
            gain[(ns < least) | (nr < least) | (signs[f] * (rv - lv) < 0)] = 0
            if len(gain) and gain.max() > best[0]:
                k = int(gain.argmax())
                best = (float(gain[k]), f, k, float(lv[k]), float(rv[k]))
        _, f, k, lv, rv = best
        if f < 0:
            total[rows] += rate * value
            return here
        middle = (lv + rv) / 2
        left_of = (low, middle) if signs[f] > 0 else (middle, high) if signs[f] < 0 else (low, high)
        right_of = (middle, high) if signs[f] > 0 else (low, middle) if signs[f] < 0 else (low, high)
        down = binned[rows, f] <= k
        left = grow(rows[down], level + 1, *left_of, g, h)
        right = grow(rows[~down], level + 1, *right_of, g, h)
        nodes[here] = [f, float(cuts[f][k]), left, right, 0.0]
        return here

    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        roots.append(grow(np.arange(len(y)), 0, -4.0, 4.0, p - y, p * (1 - p)))
    return built()


def train(stats: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality", most: int = 20_000) -> Trees:
    """Trees for `label_col` = 1 from about `most` labelled rows: all, or a sample by id hash."""
    known = lookup_join(stats.select(id_col, "features"), labels.select(id_col, label_col).dropna().dropDuplicates([id_col]), [id_col])
    # Chosen row by row, so that no task sends more than its share of the sample.
    share = most / max(1, labels.count())
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = known.where(draw < share).select("features", label_col).toPandas()
    rows = rows.sort_values([label_col, "features"], key=lambda c: c if c.name == label_col else c.map(tuple))
    x = np.array(rows["features"].tolist(), float).reshape(-1, len(FEATURES))
    return fit(x, rows[label_col].to_numpy(float), [MONOTONE.get(f, 0) for f in FEATURES])


def judge(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    lowest: float = 0.5, most: int = 20_000,
) -> DataFrame:
    """One row per document: `id_col`, `COUNTS`, `base_failed`, `score` (probability of good
    quality) and `kept`.

    `base_failed`: fewer than 50 words, or over half of them inside repeated three-word runs.
    `kept`: not so, and a score of at least `lowest`. NULL texts are empty and fail. Labels of
    unknown ids or without a value are not used; an id labelled twice counts once. Statistics are
    stored in the shared folder, so texts are read once.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "statistics")
    statistics(docs, id_col=id_col, text_col=text_col).write.parquet(folder)
    stats = spark.read.parquet(folder)
    model = train(stats, labels, id_col=id_col, label_col=label_col, most=most)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            p = 1 / (1 + np.exp(-model.score(x)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p)], names=[id_col, *COUNTS, "score"])

    counts = ", ".join(f"{c} long" for c in COUNTS)
    scored = stats.mapInArrow(run, f"`{id_col}` {kind}, {counts}, score double")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= lowest))
