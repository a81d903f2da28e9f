"""Language identification with string kernels.

The kernel of two texts is the blended spectrum: for n = 1 to 3, the number of character n-grams
present in both, divided by the geometric mean of how many each has; the three are averaged. Each
text is described by its kernel values with a few hundred landmark texts (Nyström); one ridge
regression per language on those features gives the scores. All fitting is on a bounded sample.

Scores only tell learned languages apart: a text in another one is nearer to some of them than to the
rest. What gives it away are its 3-grams that no landmark has, so a text is taken for one of a learned
language if its share of known 3-grams could be as large as that of nearly all learned texts and its
best score is not lower than theirs.
Characters are folded to 64 symbols by a fixed rule: a-z, 37 classes of other letters, one for all
else.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from agoralens.llm.batches import chunks, map_rows, string_column

SYMBOLS = 64
GRAMS = (SYMBOLS, SYMBOLS**2, SYMBOLS**3)
BLOCK = 256


@lru_cache(maxsize=1)
def symbols() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        if 0xD800 <= code < 0xE000 or not chr(code).isalpha():
            continue
        low = ord(chr(code).lower()[0])
        table[code] = low - 96 if 97 <= low <= 122 else 27 + (low * 2654435761 >> 8) % 37
    return table


def grams(text: str) -> list[np.ndarray]:
    """The distinct 1-, 2- and 3-grams of a text as numbers; runs of other signs count as one."""
    codes = symbols()[np.frombuffer(text.encode("utf-32-le"), np.uint32)].astype(np.int64)
    if not codes.any():
        return [np.zeros(0, np.int64)] * 3
    codes = np.concatenate([[0], codes, [0]])
    codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]
    two = codes[:-1] * SYMBOLS + codes[1:]
    three = two[:-1] * SYMBOLS + codes[2:]
    return [np.flatnonzero(np.bincount(codes[codes > 0], minlength=SYMBOLS)), _distinct(two, 1), _distinct(three, 2)]


_last = [np.zeros(size, np.int32) for size in GRAMS]


def _distinct(codes: np.ndarray, k: int) -> np.ndarray:
    """Distinct codes without a sort: of each code the position written last remains."""
    place = np.arange(len(codes), dtype=np.int32)
    _last[k][codes] = place
    return codes[_last[k][codes] == place]


class Model(NamedTuple):
    """`columns[n]`: landmark column of each gram or -1; `present[n]`: grams by landmarks, already
    divided by the root of each landmark's number of grams; `weights`: landmarks by languages; `lowest`
    and `least`: bounds on the share of known 3-grams and on the best score of texts in a learned language."""

    languages: list[str]
    columns: list[np.ndarray]
    present: list[np.ndarray]
    weights: np.ndarray
    lowest: float = 0.0
    least: float = 0.0

    def known(self, own: list[np.ndarray]) -> tuple[int, int]:
        """How many of a text's 3-grams some landmark has, and how many it has."""
        return int((self.columns[2][own[2]] >= 0).sum()), len(own[2])

    def learned(self, own: list[np.ndarray]) -> bool:
        """Whether a text with these grams may be in a learned language: it has a letter, and the upper
        end of the (Wilson) interval of its share of known 3-grams reaches `lowest`."""
        if not len(own[0]) or not self.languages:
            return False
        known, n = self.known(own)
        return upper_share(known, n) >= self.lowest

    def scores(self, texts: list[list[np.ndarray]]) -> np.ndarray:
        """One score per text and language, by one matrix product per gram length."""
        kernel = np.zeros((len(texts), len(self.weights)), np.float32)
        for k in range(3):
            x = np.zeros((len(texts), max(1, len(self.present[k]))), np.float32)
            for r, own in enumerate(texts):
                at = self.columns[k][own[k]]
                x[r, at[at >= 0]] = 1 / np.sqrt(max(1, len(own[k])))
            if len(self.present[k]):
                kernel += x @ self.present[k]
        return (kernel / 3) @ self.weights


#: Standard errors that a text's share of known 3-grams may lie below the bound by chance.
SLACK = 2.5
#: The bound: this quantile of the shares of learned texts that are no landmarks, less the margin and,
#: as a quantile of few texts says little, less 1 / the root of their number.
QUANTILE, MARGIN = 0.001, 0.02
#: A best score that no text needs to pass, as scores are shared out among the languages.
LEAST_SCORE = 0.2


def upper_share(known: int, n: int) -> float:
    """The upper end of the Wilson interval of known / n at `SLACK` standard errors; 1 for n = 0."""
    if n == 0:
        return 1.0
    p, z = known / n, SLACK
    return (p + z * z / (2 * n) + z * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def _bound(values: Sequence[float]) -> float:
    """What learned texts with these values reach, but for very few."""
    return max(0.0, float(np.quantile(values, QUANTILE)) - MARGIN - len(values) ** -0.5) if len(values) else 0.0


def fit(samples: list[tuple[str, list[np.ndarray]]], landmarks: int = 160, ridge: float = 1e-3) -> Model:
    """`samples`: language and grams of each text. Landmarks are spread evenly over languages."""
    languages = sorted({lang for lang, _ in samples})
    samples = [s for s in samples if len(s[1][0])]
    by_language = {lang: [g for name, g in samples if name == lang] for lang in languages}
    each = -(-landmarks // max(1, len(languages)))
    marks = [g for lang in languages for g in by_language[lang][:each]]
    columns, present = [], []
    for k in range(3):
        known = np.unique(np.concatenate([g[k] for g in marks])) if marks else np.zeros(0, np.int64)
        column = np.full(GRAMS[k], -1, np.int32)
        column[known] = np.arange(len(known))
        matrix = np.zeros((len(known), len(marks)), np.float32)
        for m, g in enumerate(marks):
            matrix[column[g[k]], m] = 1 / np.sqrt(max(1, len(g[k])))
        columns.append(column)
        present.append(matrix)
    model = Model(languages, columns, present, np.eye(len(marks), dtype=np.float32))
    if not marks:
        return model._replace(weights=np.zeros((0, len(languages)), np.float32))
    between = model.scores(marks).astype(np.float64)
    values, vectors = np.linalg.eigh((between + between.T) / 2)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    kernel = np.concatenate([model.scores([g for _, g in samples[a : a + BLOCK]]) for a in range(0, len(samples), BLOCK)])
    z = kernel @ root
    y = np.array([[lang == own for lang in languages] for own, _ in samples], float)
    # Every language weighs the same, however many of the sample's texts are in it.
    weight = 1 / np.maximum(1, y.sum(axis=0))[y.argmax(axis=1)]
    solved = np.linalg.solve(z.T @ (z * weight[:, None]) + ridge * np.eye(z.shape[1]), z.T @ (y * weight[:, None]))
    others = [g for lang in languages for g in by_language[lang][each:]]
    shares = [model.known(g)[0] / max(1, len(g[2])) for g in others]
    seen, spare = dict.fromkeys(languages, 0), []
    for lang, _ in samples:
        spare.append(seen[lang] >= each)
        seen[lang] += 1
    best = (z @ solved).max(axis=1)[spare]
    least = min(LEAST_SCORE, _bound(best))
    return model._replace(weights=(root @ solved).astype(np.float32), lowest=_bound(shares), least=least)


def _grams_of(texts: pa.Array) -> Iterator[list[np.ndarray]]:
    for chunk in chunks(texts):
        for r in range(len(chunk.offsets) - 1):
            yield grams(chunk.data[chunk.offsets[r] : chunk.offsets[r + 1]].tobytes().decode())


def train(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = 600, most: int = 6_000, landmarks: int = 160,
) -> Model:
    """Learn from about `per_language` labelled texts of each language, `most` or so in all.

    The sample goes by a hash of id and text: of a language with n labelled rows each is taken with a
    probability that gives every language its share of `most`, and some more, of which those with the
    smallest hashes are kept. Every language that occurs is learned; more than `most` of them are refused,
    as a model of them would not be of bounded size. Rows without a language or text are left out, rows
    that repeat count once, whole texts are used. What reaches the driver are the sampled texts' grams.
    """
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = labelled.groupBy(lang_col).agg(F.count("*").alias("n")).limit(most + 1).collect()
    if len(sizes) > most:
        raise ValueError(f"more than {most} languages: raise `most`, or group the rare ones")
    if not sizes:
        return fit([])
    take = max(1, min(per_language, most // len(sizes)))
    wanted = take + 4 * take**0.5 + 4
    share = F.create_map(*[F.lit(v) for row in sizes for v in (row[lang_col], min(1.0, wanted / row["n"]))])
    draw = F.xxhash64(F.col(id_col), F.col(text_col), F.lit("sample"))
    unit = F.pmod(draw, F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = labelled.where(unit < F.element_at(share, F.col(lang_col)))
    picked = picked.select(draw.alias("draw"), F.col(lang_col).alias("lang"), text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[g.astype(np.int32).tobytes() for g in own] for own in _grams_of(string_column(batch, text_col))]
            columns = [pa.array([own[k] for own in found], pa.binary()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["draw", "lang", "g1", "g2", "g3"])

    rows = picked.mapInArrow(run, "draw long, lang string, g1 binary, g2 binary, g3 binary").dropDuplicates(["draw", "lang"]).collect()
    rows.sort(key=lambda r: (r["lang"], r["draw"] % (1 << 30), r["draw"]))
    kept, taken = [], dict.fromkeys((row[lang_col] for row in sizes), 0)
    for r in rows:
        taken[r["lang"]] += 1
        if taken[r["lang"]] <= take:
            kept.append((r["lang"], [np.frombuffer(r[g], np.int32).astype(np.int64) for g in ("g1", "g2", "g3")]))
    return fit(kept, landmarks)


def _judged(texts: pa.Array, model: Model) -> Iterator[tuple[list[np.ndarray], str, float]]:
    """Grams, predicted language and score of each text, in order."""

    def scored(block: list[list[np.ndarray]]) -> Iterator[tuple[list[np.ndarray], str, float]]:
        for own, v in zip(block, model.scores(block)):
            best = int(v.argmax()) if len(v) and len(own[0]) else -1
            yield (own, model.languages[best], float(min(1.0, max(0.0, v[best])))) if best >= 0 else (own, "und", 0.0)

    block: list[list[np.ndarray]] = []
    for own in _grams_of(texts):
        block.append(own)
        if len(block) == BLOCK:
            yield from scored(block)
            block = []
    if block:
        yield from scored(block)


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, `lang_pred` and `score` (0 to 1) of every whole text, one row per input row.

    Texts that are NULL or have no letter, and all texts if nothing was learned, get `und` and 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for _, name, score in _judged(string_column(batch, text_col), model):
                names.append(name)
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[id_col, "lang_pred", "score"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")


def only_learned(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose text is taken for one of a learned language, row by row and with all columns:
    the language and score that `predict` gives are found for every text, and a text stays if its score is
    not below `least` and its 3-grams may be those of a learned language. Texts that are NULL or have no
    letter go, and all if nothing was learned."""

    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _judged(batch.column(at), model)
            kept = [name != "und" and score >= model.least and model.learned(own) for own, name, score in found]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return map_rows(docs, run)


def held_out(id_col: str | Column) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
