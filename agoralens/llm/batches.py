"""Arrow batches of documents as flat numpy arrays of bytes and words.

A word is a longest run of bytes other than space and 0x09-0x0D, so words never depend on the
platform's idea of white space. Word hashes are 64-bit polynomial hashes of the word's bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

CHUNK_BYTES = 1 << 20
#: Rows of a column that are copied at a time.
SLICE_ROWS = 500

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every input bit reaches every output bit."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def streams(n: int, seed: int) -> np.ndarray:
    """`n` fixed pseudo-random odd 64-bit multipliers."""
    start = np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(start + steps) | np.uint64(1)


_BYTE = streams(256, 1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_BASE = np.uint64(0xD6E8FEB86659FD93)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first `n` powers of the hash base (modulo 2**64)."""
    global _powers
    if len(_powers) < n:
        steps = np.full(2 * n, _BASE)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers[:n]


class Chunk(NamedTuple):
    """Rows `first` to `first + len(offsets) - 1` of a batch: their bytes, one after the other."""

    first: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Words of a chunk in order: byte span, row within the chunk, hash; `bounds[row]` to
    `bounds[row + 1]` are the words of a row."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a string column into runs of whole rows of about `most` bytes (one row at least), so
    that temporary arrays stay small whatever the batch holds. A NULL is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    for first in range(0, len(texts), SLICE_ROWS):
        for chunk in _chunks(texts.slice(first, SLICE_ROWS), most):
            yield chunk._replace(first=first + chunk.first)


def _chunks(texts: pa.Array, most: int) -> Iterator[Chunk]:
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        part = offsets[first : last + 1]
        yield Chunk(first, data[part[0] : part[-1]], part - part[0])
        first = last


def find_words(chunk: Chunk, lower: bool = False) -> Words:
    """All words of a chunk. `lower` takes A-Z for a-z in the hashes."""
    data, offsets = chunk.data, chunk.offsets
    n = len(offsets) - 1
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(0, np.uint64), np.zeros(n + 1, np.int64))
    inside = ~_SPACE[data]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    edge = inside.copy()
    edge[1:] &= ~inside[:-1]
    edge[begins] = inside[begins]
    starts = np.flatnonzero(edge)
    edge = inside.copy()
    edge[:-1] &= ~inside[1:]
    lasts = begins[begins > 0] - 1
    edge[lasts] = inside[lasts]
    ends = np.flatnonzero(edge) + 1
    if not len(starts):
        return Words(starts, ends, starts, np.zeros(0, np.uint64), np.zeros(n + 1, np.int64))
    lengths = ends - starts
    at = np.cumsum(lengths) - lengths
    codes = data[inside]
    place = np.arange(len(codes)) - np.repeat(at, lengths)
    values = (_BYTE_LOWER if lower else _BYTE)[codes] * powers(int(lengths.max()))[place]
    hashes = mix(np.add.reduceat(values, at) + lengths.astype(np.uint64) * _BASE)
    bounds = np.searchsorted(starts, offsets)
    rows = np.repeat(np.arange(n), np.diff(bounds))
    return Words(starts, ends, rows, hashes, bounds)


def windows(hashes: np.ndarray, size: int, seed: int = 7) -> np.ndarray:
    """A hash of every run of `size` consecutive words (none if there are fewer)."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    factors = streams(size, seed)
    total = hashes[: len(hashes) - size + 1] * factors[0]
    for i in range(1, size):
        total += hashes[i : len(hashes) - size + 1 + i] * factors[i]
    return mix(total)


_kept: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps for the next task of the same work: only the object asked for last."""
    if key not in _kept:
        forget()
        _kept[key] = make()
    return _kept[key]


def forget() -> None:
    """Give back what this worker kept. Spark hands workers on from stage to stage, so without this the
    memory of one stage adds to that of all later ones."""
    if _kept:
        _kept.clear()
        pa.default_memory_pool().release_unused()


def map_rows(docs: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """`mapInArrow` over whole rows, whose columns may have any names: `run` gets and gives columns in
    the order of `docs`, under other names. The worker forgets what it kept for other work."""

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        yield from run(batches)

    names = [f"c{i}" for i in range(len(docs.columns))]
    schema = T.StructType([T.StructField(name, f.dataType) for name, f in zip(names, docs.schema.fields)])
    return docs.toDF(*names).mapInArrow(alone, schema).toDF(*docs.columns)


def string_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_unpowers = np.ones(1, np.uint64)


def rolling(hashes: np.ndarray, size: int, seed: int) -> np.ndarray:
    """As `windows`, for long windows: differences of running sums, at a cost free of `size`."""
    global _unpowers
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    if len(_unpowers) < n:
        steps = np.full(2 * n, _UNBASE)
        steps[0] = 1
        _unpowers = np.cumprod(steps, dtype=np.uint64)
    factor = streams(1, seed)[0]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(hashes + factor) * powers(n), out=sums[1:], dtype=np.uint64)
    return mix((sums[size:] - sums[:-size]) * _unpowers[: n - size + 1] + factor)
